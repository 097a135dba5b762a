"""Benchmark decontamination with SimHash windows.

Words are the lower-cased runs of letters and digits; shingles are five of them (all, in an item of
fewer). A window of a document is as many words as the benchmark item it is held against. Windows
get a SimHash fingerprint; blocks of it are looked up in a multi-index of the items' fingerprints
that lists every block value within ``BLOCK_RADIUS`` bits, so no pair within ``RADIUS`` bits is
missed; candidates are then verified by the exact weighted similarity of their shingles (sum of
minimum counts over sum of maximum counts).

A window with a similarity of ``threshold`` shares at least that part of an item's shingles. Hence
only windows that begin at such a shingle and hold enough of them are formed; a window that begins
elsewhere can be moved to the next one without losing any. Every document is scanned whole.

Defined results: null and empty texts and items have no windows and no hits; equal items all hit;
repeated documents all hit; a document shorter than an item is one window; an empty table gives an
empty result; further columns of either table don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigwatch.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
BLOCKS = 8                 # of 8 bits
BLOCK_RADIUS = 2
RADIUS = (BLOCK_RADIUS + 1) * BLOCKS - 1   # 23: then some block differs in at most BLOCK_RADIUS bits
HASHES_PER_SCAN = 20_000   # shingle hashes of the benchmark looked for in one scan of the documents
SMALL_ROWS = 200_000       # rows of a benchmark table that may be broadcast, after counting

WORDS = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WORDS), lambda w: w != "")


def _shingles(words: Column, k: int) -> Column:
    """Hash of every run of ``k`` words. ``words`` must be cheap to read."""
    return F.when(F.size(words) >= k, F.transform(
        F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    ).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """Majority of the bits of the hashes, as a long."""
    ones = lambda b: F.aggregate(hashes, F.lit(0), lambda a, x: a + F.shiftrightunsigned(x, b).bitwiseAND(F.lit(1)).cast("int"))
    bit = lambda b: F.when(ones(b) * 2 > F.size(hashes), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    out = bit(0)
    for b in range(1, 64):
        out = out.bitwiseOR(bit(b))
    return out


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two bags of hashes."""
    count = lambda bag, x: F.size(F.filter(bag, lambda y: y == x))
    total = lambda f: F.aggregate(F.array_union(a, b), F.lit(0), lambda s, x: s + f(count(a, x), count(b, x)))
    return total(F.least) / total(F.greatest)


def _block(fp: Column, b: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * b).bitwiseAND(F.lit(255)).cast("int")


def _near_values(fp: Column, b: int) -> Column:
    """All values within ``BLOCK_RADIUS`` bits of a block, as ``block, value``."""
    near = F.filter(F.sequence(F.lit(0), F.lit(255)), lambda v: F.bit_count(v.bitwiseXOR(_block(fp, b))) <= BLOCK_RADIUS)
    return F.transform(near, lambda v: F.struct(F.lit(b).alias("block"), v.alias("value")))


def _if_small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows; otherwise the join is left to the optimiser."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def item_table(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, k, n, need, hashes, fp`` of the items with words; written once."""
    words = benchmark.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
    words = materialise(words, "bench-words")
    w = F.col("w")
    hashes = _shingles(w, SHINGLE)
    for k in range(SHINGLE - 1, 0, -1):
        hashes = F.when(F.size(w) == k, _shingles(w, k)).otherwise(hashes)
    items = materialise(words.select("item_id", F.least(F.size(w), F.lit(SHINGLE)).alias("k"), F.size(w).alias("n"),
                                     hashes.alias("hashes")), "bench-hashes")
    return materialise(items.withColumn("need", F.ceil(F.size("hashes") * F.lit(THRESHOLD) - 1e-9).cast("int"))
                       .withColumn("fp", simhash(F.col("hashes"))), "bench-items")


def _matches(docs: DataFrame, k: int, hashes: list[int]) -> DataFrame:
    """Rows of ``docs`` (``w`` from the text) that hold one of the hashes: ``hs`` of the row and the places found."""
    def scan(w: Column) -> Column:
        return F.transform(F.array(_shingles(w, k)), lambda hs: F.struct(
            hs.alias("hs"), F.filter(F.transform(hs, lambda h, i: F.when(h.isin(hashes), i)), lambda i: i.isNotNull()).alias("places")))

    found = F.flatten(F.transform(F.array(words_of(F.col("text"))), scan))
    return docs.select("doc_id", "text_hash", F.inline(F.filter(found, lambda x: F.size(x["places"]) > 0)))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, item_id, start_word, n_words, similarity``: the best window per document text and item."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    items = item_table(benchmark)
    shingles = items.select("k", F.explode("hashes").alias("hash")).distinct()
    found = None
    for k in range(1, SHINGLE + 1):
        wanted = [r.hash for r in shingles.where(F.col("k") == k).orderBy("hash").toLocalIterator()]  # the benchmark's, not the corpus's
        for i in range(0, len(wanted), HASHES_PER_SCAN):
            part = _matches(rows, k, wanted[i:i + HASHES_PER_SCAN]).withColumn("k", F.lit(k))
            found = part if found is None else found.union(part)
    if found is None:
        found = _matches(rows, SHINGLE, [0]).withColumn("k", F.lit(SHINGLE)).limit(0)
    matched = materialise(found.withColumn("row", F.monotonically_increasing_id()), "bench-matched")

    # Places of each item's shingles in a document, then the windows that hold enough of them.
    item_shingles = items.select("item_id", "k", "n", "need", F.explode(F.array_distinct("hashes")).alias("hash"))
    place = F.explode("places").alias("p")
    places = (matched.select("doc_id", "text_hash", "k", F.size("hs").alias("m_doc"), "row", "hs", place)
              .select("doc_id", "text_hash", "k", "m_doc", F.get("hs", F.col("p")).alias("hash"), "p")
              .join(_if_small(item_shingles), ["k", "hash"])
              .groupBy("doc_id", "text_hash", "m_doc", "item_id", "k", "n", "need").agg(F.sort_array(F.collect_set("p")).alias("ps")))
    m = F.col("n") - F.col("k") + 1  # shingles of a whole window
    enough = F.filter(F.sequence(F.lit(0), F.size("ps") - F.col("need")), lambda i:
                      F.get("ps", i + F.col("need") - 1) - F.get("ps", i) < m)
    starts = F.transform(enough, lambda i: F.greatest(F.lit(0), F.least(F.get("ps", i), F.col("m_doc") - m)))
    windows = (places.where(F.size("ps") >= F.col("need"))
               .select("doc_id", "text_hash", "k", "n", m.alias("m"), F.explode(F.array_distinct(starts)).alias("start")).distinct())
    texts = matched.groupBy("doc_id", "text_hash", "k").agg(F.min("row").alias("row")).join(matched.select("row", "hs"), "row").drop("row")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"]) & (a["k"] == b["k"])
    cut = windows.join(texts, same(windows, texts)).select(
        windows.doc_id, windows.text_hash, windows.k, "n", "start", F.slice("hs", F.col("start") + 1, F.col("m")).alias("bag"))
    prints = materialise(cut.withColumn("fp", simhash(F.col("bag"))), "bench-windows")

    # Multi-index over blocks of the items' fingerprints, then exact verification.
    index = items.select("item_id", "k", "n", F.explode(F.flatten(F.array(*[_near_values(F.col("fp"), b) for b in range(BLOCKS)]))).alias("e")
    ).select("item_id", "k", "n", "e.block", "e.value")
    probes = prints.select("doc_id", "text_hash", "k", "n", "start", F.explode(F.array(*[
        F.struct(F.lit(b).alias("block"), _block(F.col("fp"), b).alias("value")) for b in range(BLOCKS)])).alias("e")
    ).select("doc_id", "text_hash", "k", "n", "start", "e.block", "e.value")
    candidates = (probes.join(_if_small(index), ["k", "n", "block", "value"])
                  .select("doc_id", "text_hash", "k", "n", "start", "item_id").distinct())
    c, p = candidates.alias("c"), prints.alias("p")
    keys = ["text_hash", "k", "n", "start"]
    on = F.col("c.doc_id").eqNullSafe(F.col("p.doc_id"))
    for name in keys:
        on = on & (F.col(f"c.{name}") == F.col(f"p.{name}"))
    item = _if_small(items.select(F.col("item_id").alias("i_item"), F.col("hashes").alias("i_bag"), F.col("fp").alias("i_fp")))
    scored = (c.join(p, on).join(item, F.col("c.item_id").eqNullSafe(F.col("i_item")))
              .where(F.bit_count(F.col("p.fp").bitwiseXOR(F.col("i_fp"))) <= RADIUS)
              .select("c.doc_id", "c.text_hash", "c.item_id", "c.start", "c.n",
                      F.inline(F.array(F.struct(similarity(F.col("p.bag"), F.col("i_bag")).alias("similarity"))))))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n")).alias("best")
    return (scored.where(F.col("similarity") >= THRESHOLD).groupBy("doc_id", "text_hash", "item_id").agg(best)
            .select("doc_id", "text_hash", "item_id", (-F.col("best.before")).cast("long").alias("start_word"),
                    F.col("best.n").cast("long").alias("n_words"), F.col("best.similarity").alias("similarity")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    bad = materialise(contaminated(docs, benchmark, doc_id, text).select("doc_id", "text_hash").distinct(), "bench-hits")
    bad = bad.select(F.col("doc_id").alias("_bench_id"), F.col("text_hash").alias("_bench_hash"))
    return docs.join(bad, F.col(doc_id).eqNullSafe(F.col("_bench_id")) & (F.xxhash64(text) == F.col("_bench_hash")), "left_anti")
