import duckdb
import pytest
from pyspark.sql import functions as F

from rigwatch.llm import QUERIES, SQL, line_quality
from tests.llm import brute
from tests.llm.odd import empty_docs, odd_docs, saved
from tests.oracle import differences

SF = "/root/testdata/sf0.01"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check(rows, docs):
    key = lambda d: (d is None, d or 0)
    got = sorted((key(r.doc_id), *[r[c] for c in BASE]) for r in rows)
    assert got == sorted((key(d.doc_id), *[brute.quality(d.text)[c] for c in BASE]) for d in docs)
    assert not any(r.kept and r.base_failed for r in rows)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", SF])
def test_op8_on_tables(spark, folder):
    check(QUERIES["op8_line_quality"](spark, folder).collect(), spark.read.parquet(f"{folder}/documents.parquet").collect())


def test_op8_equals_its_sql(spark, out):
    for folder in (SF, saved(odd_docs(spark).coalesce(1), out)):
        con = duckdb.connect()
        source = f"{folder}/documents.parquet" + ("" if folder == SF else "/*.parquet")
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{source}')")
        got = QUERIES["op8_line_quality"](spark, folder).toPandas()
        assert differences(got, con.execute(SQL["op8_line_quality"]).df()) == []


def test_op8_on_odd_rows(spark, out):
    check(QUERIES["op8_line_quality"](spark, saved(odd_docs(spark), out)).collect(), odd_docs(spark).collect())
    assert QUERIES["op8_line_quality"](spark, saved(empty_docs(spark), out + "/e")).count() == 0


@pytest.mark.parametrize("line,fails", [
    ("Home | News | Sport | Weather | More | About us.", True), ("THIS!! IS!! ALL!! SHOUTED!! HERE!! NOW!!", True),
    ("of%%% thor*** thathath&&& thouonre&&& eranin$$$.", True), ("Menu", True), ("All rights reserved.", True),
    ("A plain sentence.", False), ("a longer line of running text that was cut before its full stop came", False),
    ("", False), ("   ", False), ("He said | and then left the house with 3 > 2 friends by car.", False),
])
def test_line_rules(spark, line, fails):
    got = spark.createDataFrame([(line,)], "line string").select(line_quality.line_fails(F.col("line")).alias("f")).first().f
    assert got == fails


@pytest.mark.parametrize("end", ["\n", "\r\n", " \t\r\n"])
def test_line_ends_do_not_matter(spark, end, out):
    """Short lines with a full stop stay, whatever white space follows it; the SQL agrees."""
    text = end.join(f"The {w} line is a sentence." for w in "first second third fourth fifth sixth seventh eighth ninth".split())
    docs = spark.createDataFrame([(1, text, "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    row = line_quality.judge(docs).first()
    assert row.kept and row.kept_share == 1.0 and row.cleaned == text
    folder = saved(docs.coalesce(1), out)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    assert differences(QUERIES["op8_line_quality"](spark, folder).toPandas(), con.execute(SQL["op8_line_quality"]).df()) == []


def test_cleaned_text_and_extra_columns(spark):
    df = spark.createDataFrame([("Good text stays here, it is fine.\nMenu\nMore good text, also fine here.", 3)], "body string, text int")
    row = line_quality.judge(df, "body").first()
    assert row.cleaned == "Good text stays here, it is fine.\nMore good text, also fine here." and row.text == 3


def test_good_labels_are_kept(spark):
    got = QUERIES["op8_line_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    by = {(r.quality, r.kept): r["count"] for r in got.where("not base_failed").groupBy("quality", "kept").count().collect()}
    assert by.get((1, False), 0) <= 0.01 * by[1, True] and by.get((0, True), 0) <= 0.2 * by.get((0, False), 1)
