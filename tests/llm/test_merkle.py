import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rigwatch.llm import merkle
from rigwatch.llm.registry import QUERIES, SQL
from tests.llm.odd import empty_docs, odd_docs, saved
from tests.oracle import connect, differences

NAME = "op11_subtree_exchange"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Root and, for each leaf, the steps (side, sibling) to it."""
    paths, places, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for path, at in zip(paths, places):
            if at ^ 1 < len(level):
                path.append(("L" if at % 2 else "R", level[at ^ 1]))
            else:
                path.append(("", ""))
        places = [p // 2 for p in places]
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def fold(node, path):
    for side, other in path:
        node = h(other, node) if side == "L" else h(node, other)
    return node


def brute(rows):
    """The contract's rows; ``rows``: doc_id, text, lang, source, n_chars."""
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        own, more = (h(*map(field, (doc_id, source, lang, n, text))) for n in (n_chars, None if n_chars is None else n_chars + 1))
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        groups[lang].append((doc_id, own, more if tampered else own))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [tree([r[1] for r in groups[g]]) for g in langs]
    if not trees:
        return []
    root, above = tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), upper in zip(langs, trees, above):
        for (doc_id, own, shown), path in zip(groups[g], paths):
            folded = fold(shown, path + upper)
            out.append((doc_id, own, subroot, root, h(*[s for _, s in path + upper]), folded, folded == root))
    return out


def test_equals_its_sql(spark, out):
    for folder in ("/root/testdata/sf0.01", saved(odd_docs(spark), out), saved(empty_docs(spark), out + "/none")):
        con = connect("/root/testdata/sf0.001")
        path = f"{folder}/documents.parquet"
        con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{path if folder.startswith('/root') else path + '/*.parquet'}')")
        assert differences(QUERIES[NAME](spark, folder).toPandas(), con.execute(SQL[NAME]).df()) == []


def order(row):
    return tuple(str(v) for v in row)


@pytest.mark.parametrize("levels", [1, 2, 12])
def test_tiers_of_superblocks_equal_brute_force(spark, levels):
    rng = random.Random(levels)
    rows = [(i if rng.random() < 0.97 else None, rng.choice(["t", "", None, "é" * 3]), lang, "s", rng.choice([None, i]))
            for lang, n in ((None, 1), ("a", 37), ("b", 2), ("ä", 64), ("", 3), ("z", 1)) for i in range(n)]
    rows += rows[5:25]  # repeated rows
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    leaves = df.select("doc_id", "lang", merkle.leaf(F.col(c) for c in fields).alias("l"),
                       F.when(tampered, merkle.leaf((F.col(c) + 1 if c == "n_chars" else F.col(c)) for c in fields)).alias("p"))
    got = merkle.manifest(leaves, "lang", "doc_id", "l", "p", levels).collect()
    seen = [(r.id, r.leaf, r.subroot, r.root, h(*r.proof), r.folded_root, r.verified) for r in got]
    assert sorted(seen, key=order) == sorted(brute(rows), key=order)


def test_query_on_odd_rows(spark, out):
    docs = odd_docs(spark)
    want = brute([tuple(r)[:5] for r in docs.collect()])
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = [tuple(r) for r in QUERIES[NAME](spark, saved(docs, out)).select(*columns).collect()]
    assert sorted(got, key=order) == sorted(want, key=order)
    assert not all(r[-1] for r in got)
    assert QUERIES[NAME](spark, saved(empty_docs(spark), out + "/none")).count() == 0


def test_positions_are_gapless_with_one_hot_key(spark):
    rows = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    got = merkle.numbered(rows, ["k"], "at").collect()
    assert sorted(r["at"] for r in got) == list(range(5000))
    assert [r.k for r in sorted(got, key=lambda r: r["at"])] == sorted(r.k for r in got)
