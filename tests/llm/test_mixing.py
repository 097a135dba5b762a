import pytest

from rigwatch.llm import QUERIES, mixing
from tests.llm import brute
from tests.llm.odd import empty_docs, odd_docs, saved

SF = "/root/testdata/sf0.01"


def check(rows, docs):
    key = lambda d: (d is None, d or 0)
    assert sorted((key(r.doc_id), r.size) for r in rows) == sorted((key(d.doc_id), len(brute.words(d.text))) for d in docs)
    sizes = {s: sum(len(brute.words(t)) for t in ts) for s, ts in brute.groups((d.source, d.text) for d in docs).items()}
    targets = brute.targets(sizes)
    source = {(d.doc_id, len(brute.words(d.text))): d.source for d in docs}
    by = brute.groups((source[r.doc_id, r.size], r) for r in rows)
    for s, part in by.items():
        assert all(r.source_size == sizes[s] and abs(r.target - targets[s]) < 1e-6 * max(1, targets[s]) for r in part)
        assert abs(sum(r.taken for r in part) - targets[s]) <= max(r.size for r in part) * max(1, part[0].target / max(1, sizes[s]))
        assert all(r.taken <= 2 * r.size for r in part)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", SF])
def test_op9_on_tables(spark, folder):
    query = QUERIES["op9_water_filling"]
    rows = query(spark, folder).collect()
    check(rows, spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert sorted(rows) == sorted(query(spark, folder).collect())


def test_op9_on_odd_rows(spark, out):
    rows = QUERIES["op9_water_filling"](spark, saved(odd_docs(spark), out)).collect()
    docs = odd_docs(spark).collect()
    assert len(rows) == len(docs) and all(0 <= r.taken <= 2 * r.size for r in rows)
    sizes = {s: sum(len(brute.words(t)) for t in ts) for s, ts in brute.groups((d.source, d.text) for d in docs).items()}
    want = brute.targets(sizes)
    assert sorted({round(r.target, 6) for r in rows}) == sorted({round(t, 6) for t in want.values()})
    assert QUERIES["op9_water_filling"](spark, saved(empty_docs(spark), out + "/e")).count() == 0


@pytest.mark.parametrize("sizes,weights", [([100, 100, 100], [5, 2, 1]), ([10, 1000, 10], [5, 1, 5]), ([0, 50], [1, 1]), ([0, 0], [1, 2])])
def test_level(spark, sizes, weights):
    df = spark.createDataFrame(list(zip(sizes, weights)), "source_size long, weight int")
    level = mixing.water_level(df, 1.5 * sum(sizes), 2.0)
    got = sum(min(2 * s, level * w if w * level == w * level else 0) for s, w in zip(sizes, weights))
    assert abs(got - 1.5 * sum(sizes)) < 1e-6


def test_all_full(spark):
    assert mixing.water_level(spark.createDataFrame([(10, 1)], "source_size long, weight int"), 50.0, 2.0) == float("inf")
