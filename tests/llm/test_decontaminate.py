import re
from collections import Counter

from pyspark.sql import functions as F

from rigwatch.llm import QUERIES, decontaminate
from tests.llm.odd import empty_docs, odd_docs, saved

SF = "/root/testdata/sf0.01"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(w):
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or Counter([tuple(w)])


def brute(docs, items):
    """Best similarity over all windows of an item's size, for every document and item."""
    found = {}
    bags = [(i.item_id, len(words(i.text)), shingles(words(i.text))) for i in items if words(i.text)]
    for d in docs:
        w = words(d.text)
        have = set(shingles(w)) if w else set()
        for item, n, bag in bags:
            if n >= 5 and not have & set(bag):
                continue
            best = 0
            for s in range(max(1, len(w) - n + 1)):
                x = w[s:s + n]
                if x:
                    y = shingles(x)
                    best = max(best, sum((bag & y).values()) / sum((bag | y).values()))
            if best >= 0.8:
                found[d.doc_id, item] = round(best, 9)
    return found


def test_op6_on_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in QUERIES["op6_simhash_windows"](spark, SF).collect()}
    assert got == brute(docs, items) and got


def test_edited_short_and_odd_items(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen " * 2
    w = passage.split()
    docs = [(1, "x y " + passage + " z"), (2, " ".join(w[:20] + ["changed"] + w[21:])), (3, " ".join(w[:9])), (4, " ".join(w[:30])),
            (5, " ".join(w[:10] + ["added"] + w[10:]).upper()), (6, "alpha beta"), (7, "x alpha, beta gamma"), (None, passage), (8, None), (9, "")]
    items = [(1, passage), (2, "alpha beta"), (3, None), (4, ""), (5, passage)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("w", F.lit(1)).withColumn("hs", F.lit(2))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("k", F.lit(1))
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontaminate.contaminated(d, b).collect()}
    assert got == brute(d.collect(), b.collect())
    assert sorted(r.doc_id for r in decontaminate.clean_documents(d, b).collect()) == sorted(
        i for i, _ in docs if i is not None and not any(k[0] == i for k in got))


def test_odd_and_empty(spark, out):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.contaminated(odd_docs(spark), bench).count() == 0
    assert decontaminate.contaminated(empty_docs(spark), bench).count() == 0
    assert decontaminate.clean_documents(odd_docs(spark), bench.limit(0)).count() == odd_docs(spark).count()
