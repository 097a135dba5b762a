import pytest

from rigwatch.llm import QUERIES, sharding
from tests.llm.brute import crc, groups
from tests.llm.odd import empty_docs, odd_docs, saved

SF = "/root/testdata/sf0.01"


def check(rows, docs, shards=8):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (d.doc_id is None, d.doc_id or 0, len((d.text or "").encode()) + 1, crc(d.text)) for d in docs)
    by = groups((r.shard, r) for r in rows)
    assert set(by) <= set(range(shards))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    total, most = sum(r.size for r in rows), max(r.size for r in rows)
    assert all(abs(sum(r.size for r in by.get(s, [])) - total / shards) <= most for s in range(shards))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", SF])
def test_op1_on_tables(spark, folder):
    check(QUERIES["op1_sampled_splitters"](spark, folder).collect(), spark.read.parquet(f"{folder}/documents.parquet").collect())


def test_op1_on_odd_rows(spark, out):
    folder = saved(odd_docs(spark), out)
    check(QUERIES["op1_sampled_splitters"](spark, folder).collect(), odd_docs(spark).collect())
    assert QUERIES["op1_sampled_splitters"](spark, saved(empty_docs(spark), out + "/e")).count() == 0


def test_one_key_for_all_rows_is_subdivided(spark):
    df = spark.range(20_000).selectExpr("'k' as key", "id", "id % 7 + 1 as size", "1 as shard_", "'x' as _other")
    placed = sharding.shard_by_bytes(df, ["key"], "size", 4).collect()
    sums = {s: sum(r.size for r in rows) for s, rows in groups((r.shard, r) for r in placed).items()}
    assert len(sums) == 4 and max(sums.values()) - min(sums.values()) <= 14
    assert set(placed[0].asDict()) == {"key", "id", "size", "shard_", "_other", "shard", "slot"}


def test_null_sizes_and_keys(spark):
    df = spark.createDataFrame([(None, None), ("a", 5), ("a", None), (None, 3)], "key string, size long")
    assert sharding.shard_by_bytes(df, ["key"], "size", 2).count() == 4
