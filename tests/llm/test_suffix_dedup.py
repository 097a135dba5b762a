import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rigwatch.llm import QUERIES, suffix_dedup
from tests.llm.odd import empty_docs, odd_docs, saved


def brute(texts: list[bytes], length=200):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        flags = bytes(gone)
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), len([x for x in flags.split(b"\x00") if x]), hashlib.sha256(kept).hexdigest()))
    return out


def check(rows, docs):
    want = brute([(d.text or "").encode() for d in docs])
    key = lambda d: (d is None, d or 0)
    assert sorted((key(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == sorted(
        (key(d.doc_id), *w) for d, w in zip(docs, want))


def test_op3_on_tables(spark):
    folder = "/root/testdata/sf0.001"
    check(QUERIES["op3_suffix_sort"](spark, folder).collect(), spark.read.parquet(f"{folder}/documents.parquet").collect())


def texts_with_repeats(rng: random.Random) -> list[str]:
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (40, 60, 120)]
    texts = []
    for i in range(60):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a, b = sorted(rng.sample(range(len(s)), 2))
            parts += [s[a:b] if rng.random() < 0.6 else s, prose(rng.randint(0, 20))]
        texts.append(" ".join(parts))
    base = prose(200)
    for _ in range(25):  # near copies
        w = base.split()
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    return texts + ["xy" * 300, "xy" * 200 + "z", "q" * 199, "q" * 200, "q" * 201, texts[0], texts[0], "é" * 150]


@pytest.mark.parametrize("node", [8192, 8])
def test_against_brute_force(spark, out, monkeypatch, node):
    monkeypatch.setattr(suffix_dedup, "NODE", node)  # 8: nearly all nodes are hot
    docs = spark.createDataFrame(list(enumerate(texts_with_repeats(random.Random(node)))), "doc_id long, text string")
    check(suffix_dedup.remove_repeats(docs.repartition(3)).collect(), docs.collect())


def test_odd_rows(spark, out):
    check(QUERIES["op3_suffix_sort"](spark, saved(odd_docs(spark).where("doc_id is null or doc_id != 5"), out)).collect(),
          odd_docs(spark).where("doc_id is null or doc_id != 5").collect())
    assert QUERIES["op3_suffix_sort"](spark, saved(empty_docs(spark), out + "/e")).count() == 0


def test_anchors_of_a_text_longer_than_a_buffer():
    rng = random.Random(3)
    text = bytes(rng.randrange(97, 123) for _ in range(suffix_dedup.BUFFER + 5000))
    _, place, _, lo, hi = suffix_dedup.anchors([text])
    owned = np.concatenate([np.arange(p - h, p - b + 1) for p, b, h in zip(place, lo, hi)])
    assert sorted(owned.tolist()) == list(range(len(text) - 199))


def test_suffix_sort_is_a_sort():
    rng = random.Random(5)
    spans = ["".join(rng.choice("ab") for _ in range(260)).encode() for _ in range(200)]
    hi = np.full(200, 60)
    node = np.sort(np.array([rng.randrange(20) for _ in spans]))
    s = suffix_dedup.Spans(spans, hi)
    assert s.sort(node, "right").tolist() == sorted(range(200), key=lambda i: (node[i], spans[i][60:]))
    assert s.sort(node, "left").tolist() == sorted(range(200), key=lambda i: (node[i], spans[i][:60][::-1]))


def test_collisions_are_found(monkeypatch):
    spans = [b"a" * 100 + bytes([97 + i]) + b"a" * 199 for i in range(4)]
    lo, hi, node = np.zeros(4, np.int64), np.full(4, 100), np.zeros(4, np.int64)
    want = suffix_dedup.repeated(node, spans, lo, hi)
    real = suffix_dedup.Spans.__init__

    def colliding(self, *a):
        real(self, *a)
        self.right = np.zeros_like(self.right)
        self.left = np.zeros_like(self.left)

    monkeypatch.setattr(suffix_dedup.Spans, "__init__", colliding)
    assert [x.tolist() for x in suffix_dedup.repeated(node, spans, lo, hi)] == [x.tolist() for x in want]
