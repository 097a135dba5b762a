import random

import numpy as np
import pytest
import xxhash

from rigwatch.llm import QUERIES, simhash_index
from tests.llm.odd import empty_docs, odd_docs, saved

SF = "/root/testdata/sf0.01"


def print_of(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(prints, ids, linked=None):
    """Component ids by comparing all pairs; ``linked(i)`` gives further links of a row."""
    a = np.array(prints, np.uint64)
    label = list(range(len(a)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(a)):
        for j in np.flatnonzero((np.bitwise_count(a ^ a[i]) <= 2) | (linked(i) if linked else False)):
            x, y = root(i), root(int(j))
            label[max(x, y)] = min(x, y)
    groups = {}
    for i in range(len(a)):
        groups.setdefault(root(i), []).append(ids[i])
    low = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return [low[root(i)] for i in range(len(a))]


def check(rows, docs):
    prints = [print_of(d.text) for d in docs]
    comps = smallest(prints, [d.doc_id for d in docs])
    key = lambda d: (d is None, d or 0)
    assert sorted((key(r.doc_id), r.fingerprint, key(r.component_id)) for r in rows) == sorted(
        (key(d.doc_id), f"{p:016x}", key(c)) for d, p, c in zip(docs, prints, comps))


def test_op4_on_tables(spark):
    check(QUERIES["op4_gray_index"](spark, SF).collect(), spark.read.parquet(f"{SF}/documents.parquet").collect())


def test_op4_on_odd_rows(spark, out):
    check(QUERIES["op4_gray_index"](spark, saved(odd_docs(spark), out)).collect(), odd_docs(spark).collect())
    assert QUERIES["op4_gray_index"](spark, saved(empty_docs(spark), out + "/e")).count() == 0


@pytest.mark.parametrize("full", [512, 4])
def test_links_against_all_pairs(spark, monkeypatch, full):
    monkeypatch.setattr(simhash_index, "FULL_NODE", full)
    rng = np.random.default_rng(full)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [int(s) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 4)))) for s in rng.choice(seeds, 400)]
    points = np.unique(np.array(near, np.uint64))
    df = spark.createDataFrame([(int(p), int(p)) for p in points.view(np.int64)], "id long, fp long")
    got = {(r.node, r.root) for r in simhash_index.components(simhash_index.links(df)).collect()}
    values = [int(v) for v in points.view(np.int64)]
    want = smallest(points, values)
    assert got == {(v, w) for v, w in zip(values, want) if v != w}


def test_gray_rank_and_pairs():
    n = np.arange(1000, dtype=np.uint64)
    assert (simhash_index.gray_rank(n ^ (n >> np.uint64(1))) == n).all()
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 1 << 12, 700, dtype=np.uint64))
    node = np.sort(rng.integers(0, 5, len(fp)))
    order = np.lexsort((simhash_index.gray_rank(fp), node))
    fp = fp[order]
    a, b = simhash_index.linked_pairs(node, fp)
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp))
            if node[i] == node[j] and int(fp[i] ^ fp[j]).bit_count() <= 2}
    assert set(zip(a.tolist(), b.tolist())) == want


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = "".join(rng.choice("abcdefghij") for _ in range(6))
    return " ".join(w)


@pytest.mark.parametrize("wide", [8192, 40])
def test_near_copies_go_and_others_stay(spark, monkeypatch, wide):
    monkeypatch.setattr(simhash_index, "WIDE_NODE", wide)  # 40: nodes are cut to blocks
    rng = random.Random(7)
    bases = [["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(250)] for _ in range(12)]
    texts = [" ".join(b) for b in bases] + [edited(rng, bases[0], rng.randint(0, 4)) for _ in range(60)] + [edited(rng, bases[1], 2)] * 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = sorted(r.doc_id for r in simhash_index.one_of_each(df).collect())
    assert kept == sorted(set(similar_groups(texts)[0])) and set(range(12)) <= set(kept)


def test_one_fingerprint_of_words_for_all(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.sample(words, 60)) for _ in range(100)]  # the same words in another order
    df = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash_index.one_of_each(df).collect()) == list(range(100))


def test_one_of_each(spark):
    docs = odd_docs(spark)
    kept = simhash_index.one_of_each(docs).collect()
    assert sorted(r.doc_id or -1 for r in kept) == [-1, 1, 2, 5, 6, 8, 9, 10] and set(kept[0].asDict()) == set(docs.columns)


def test_near_copies_come_through_the_index(spark, monkeypatch):
    """Candidates of the Gray-order index are verified: near copies are linked, other texts of the same fingerprint are not."""
    rng = random.Random(5)
    bases = [["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(900)] for _ in range(6)]
    texts = [t for b in bases for t in (" ".join(b), " ".join(b[1:]), " ".join(b + ["end"]))]
    monkeypatch.setattr(simhash_index, "_shared", lambda points, kept: kept.write(points.sparkSession.createDataFrame(
        [], "key long, id long, n long, pos long"), "no-nodes"))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in simhash_index.one_of_each(df).collect()) == list(range(0, 18, 3))
    monkeypatch.setattr(simhash_index, "majority", lambda parts: 5)
    texts = texts + [f"alone {i}" for i in range(4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in simhash_index.one_of_each(df).collect()}
    assert {*range(0, 18, 3), *range(18, 22)} <= kept


def sets_of(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    return out


def similar_groups(texts):
    """Smallest place of every text's group, by the similarity of all pairs of texts, and the number of similar pairs."""
    sets, label, pairs = sets_of(texts), list(range(len(texts))), 0

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = root(i), root(j)
                label[max(x, y)], pairs = min(x, y), pairs + 1
    return [root(i) for i in range(len(texts))], pairs


@pytest.mark.parametrize("wide, common, few", [(8192, 1000, 4), (4, 1000, 1000), (7, 3, 0), (8192, 5, 1)])
def test_groups_are_those_of_exact_similarity(spark, monkeypatch, wide, common, few):
    for name, value in (("WIDE_NODE", wide), ("COMMON", common), ("FEW", few), ("MANY", 3)):
        monkeypatch.setattr(simhash_index, name, value)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passage, texts = [word() for _ in range(60)], []
    for size in [5, 6, 9, 14, 40, 120, 300] * 4:
        base = [word() for _ in range(size)] + (passage if rng.random() < 0.5 else [])
        texts.append(" ".join(base))
        for share in (0.03, 0.08, 0.15, 0.2, 0.22, 0.25, 0.3):
            cut = int(len(base) * share)
            texts += [" ".join(base + [word() for _ in range(cut)]), " ".join(base[cut:]), edited(rng, base, int(len(base) * share / 5))]
    rng.shuffle(texts)
    want, pairs = similar_groups(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    kept = sorted(r.doc_id for r in simhash_index.one_of_each(df).collect())
    assert pairs > 500 and kept == sorted(set(want))


def test_copies_found_are_those_of_exact_search_on_tables(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want, _ = similar_groups([r.text for r in rows])
    kept = [r.doc_id for r in simhash_index.one_of_each(spark.createDataFrame(rows)).collect()]
    assert sorted(kept) == sorted(rows[i].doc_id for i in set(want))


def left_behind(spark, before=()):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    return sorted(n for n in __import__("os").listdir(folder) if n not in before)


def test_components_of_any_graph_leave_one_result(spark):
    rng = random.Random(12)
    pairs = [(i, i + 1) for i in range(40)] + [(1000, 100 + i) for i in range(50)] + [(200 + i, 2000) for i in range(5)] + [(7, 7), (300, 301), (301, 300)]
    pairs += [(rng.randrange(400, 600), rng.randrange(400, 600)) for _ in range(90)]
    label = {x: x for p in pairs for x in p}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    rng.shuffle(pairs)
    before = left_behind(spark)
    got = [tuple(r) for r in simhash_index.components(spark.createDataFrame(pairs * 2, "a long, b long").repartition(5)).collect()]
    assert sorted(got) == sorted((x, r) for x, r in label.items() if x != r)
    assert [n.rsplit("-", 1)[0] for n in left_behind(spark, before)] == ["small-star"]


def test_turns_that_link_nothing_end_and_results_go(spark, monkeypatch):
    """Texts of one passage that are no copies: one turn shows it, all pairs follow; only what the rows are read from stays."""
    rng = random.Random(13)
    passage = [f"p{i}" for i in range(30)]
    texts = [" ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(30)]) for _ in range(60)]
    texts += [t + " end" for t in texts[:9]]
    calls, verified, looks, counts = [], simhash_index._verified, [], simhash_index._with_counts
    monkeypatch.setattr(simhash_index, "FEW", 0)
    monkeypatch.setattr(simhash_index, "_common", lambda texts: bytes(1 << simhash_index.MARK_BITS - 3))
    monkeypatch.setattr(simhash_index, "_verified", lambda *a, **b: calls.append(b) or verified(*a, **b))
    monkeypatch.setattr(simhash_index, "_with_counts", lambda pairs, points, column: looks.append(column) or counts(pairs, points, column))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    before = left_behind(spark)
    kept = sorted(r.doc_id for r in simhash_index.one_of_each(df).collect())
    assert kept == sorted(set(similar_groups(texts)[0])) == list(range(60))
    assert sum(b.get("one", False) for b in calls) in (1, 2)
    assert looks.count("sketch") == len(calls) - 1  # the nodes' pairs have passed it
    assert [n.rsplit("-", 1)[0] for n in left_behind(spark, before)] == ["sim-docs", "sim-kept"]


def test_kept_ids_go_to_the_texts(spark, monkeypatch):
    """Texts are not dealt anew for the ids that stay, however small tables to broadcast must be; many ids meet them in a shuffle, with the same rows."""
    texts = [f"w{i} " * 3 + " ".join(f"x{i * j % 97}" for j in range(1, 30)) for i in range(40)] + ["", None]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts + texts[:7])], "doc_id long, text string").coalesce(1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = simhash_index.one_of_each(docs)
        assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
        rows = sorted(got.collect(), key=str)
        monkeypatch.setattr(simhash_index, "BROADCAST_IDS", 0)
        assert sorted(simhash_index.one_of_each(docs).collect(), key=str) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.doc_id)] == list(range(41))
