"""The pipeline's stages against plain versions, each on its own input."""

from collections import Counter

import pytest

import corpus_pipeline as cp
from tests.llm import brute
from tests.llm.odd import empty_docs, odd_docs
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_simhash_index import similar_groups
from tests.llm.test_token_files import brute as token_rows

SF = "/root/testdata/sf0.001"


def text_key(rows):
    return sorted(((r.doc_id, r.text) for r in rows), key=str)


def after(spark, docs, name):
    stage = dict(cp.STAGES)[name]
    df = stage(spark, docs, SF)
    if name != "tokens":
        assert df.columns == cp.COLUMNS
    return df.collect()


def check_stages(spark, docs):
    kept = after(spark, docs, "quality")
    by = Counter(r.doc_id for r in kept)
    assert all(not brute.quality(d.text)["base_failed"] for d in docs.collect() if by[d.doc_id])
    assert all(r.n_chars == len(r.text) for r in kept)

    rows = docs.collect()
    comps, _ = similar_groups([r.text for r in rows])
    groups = brute.groups(zip(comps, rows))
    got = after(spark, docs, "near_dedup")
    assert len(got) == len(groups)
    want = [min((r.doc_id is None, r.doc_id or 0) for r in g) for g in groups.values()]
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted(want)

    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    bad = {d for d, _ in leaks(rows, items)}
    assert text_key(after(spark, docs, "decontamination")) == text_key([r for r in rows if r.doc_id not in bad])

    mixed = after(spark, docs, "mix")
    sizes = {s: sum(len(brute.words(t)) for t in ts) for s, ts in brute.groups((r.source, r.text) for r in rows).items()}
    targets = brute.targets(sizes)
    for s, ts in brute.groups((r.source, r.text) for r in mixed).items():
        most = max(len(brute.words(r.text)) for r in rows if r.source == s)
        same = max(Counter(r.doc_id for r in rows if r.source == s).values())
        assert abs(sum(len(brute.words(t)) for t in ts) - targets[s]) <= most * same

    tokens = after(spark, docs, "tokens")
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokens], key=str) == token_rows(rows)


def test_stages_on_tables(spark):
    check_stages(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_stages_on_odd_rows(spark):
    check_stages(spark, odd_docs(spark))


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_empty_table(spark, name):
    assert after(spark, empty_docs(spark), name) == []


def test_run_is_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    want = token_rows(docs.collect())
    assert sorted([(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in cp.run(spark, SF).collect()], key=str) == want
