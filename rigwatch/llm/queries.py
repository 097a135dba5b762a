"""Registered queries of the operators, over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigwatch.llm import (
    byte_bpe, conversation_repair, decontaminate, html_text, licences, line_quality, merkle, mixing, sharding,
    simhash_index, suffix_dedup, token_files, url_rules,
)
from rigwatch.llm.registry import query, table
from rigwatch.session import materialise, scratch_path


def vocabulary() -> str:
    """Place of the public vocabulary file that the contract names."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


MANIFEST_SQL = """
WITH RECURSIVE coded AS (
  SELECT doc_id, lang, source, text, n_chars,
    doc_id IS NOT NULL AND xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
        lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) % 7 = 0 AS tampered
  FROM documents),
hashed AS (
  SELECT doc_id, lang, tampered, sha256(head || chars || body) AS leaf, sha256(head || more || body) AS shown
  FROM (SELECT doc_id, lang, tampered,
          coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') AS head,
          coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars,
          coalesce(strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1), '-') AS more,
          coalesce(strlen(text) || ':' || text, '-') AS body FROM coded)),
leaves AS (
  SELECT doc_id, leaf, CASE WHEN tampered THEN shown ELSE leaf END AS shown,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
nodes AS (
  SELECT tree, 0 AS lvl, pos, leaf AS h, n FROM leaves
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 2),
tops AS (
  SELECT 0 AS lvl, tree AS pos, h, count(*) OVER () AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY lvl, pos // 2),
climb AS (
  SELECT doc_id, leaf, tree, 0 AS lvl, pos, n, shown AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT c.doc_id, c.leaf, c.tree, c.lvl + 1, c.pos // 2, (c.n + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN c.folded WHEN c.pos % 2 = 0 THEN c.folded || s.h ELSE s.h || c.folded END),
    c.proof || coalesce(s.h, '')
  FROM climb c LEFT JOIN nodes s ON s.tree = c.tree AND s.lvl = c.lvl AND s.pos = xor(c.pos, 1) WHERE c.n > 1),
climb_tops AS (
  SELECT doc_id, leaf, tree, 0 AS lvl, tree AS pos, (SELECT count(*) FROM nodes WHERE n = 1) AS n, folded, proof FROM climb WHERE n = 1
  UNION ALL
  SELECT c.doc_id, c.leaf, c.tree, c.lvl + 1, c.pos // 2, (c.n + 1) // 2,
    sha256(CASE WHEN s.h IS NULL THEN c.folded WHEN c.pos % 2 = 0 THEN c.folded || s.h ELSE s.h || c.folded END),
    c.proof || coalesce(s.h, '')
  FROM climb_tops c LEFT JOIN tops s ON s.lvl = c.lvl AND s.pos = xor(c.pos, 1) WHERE c.n > 1)
SELECT c.doc_id, c.leaf, t.h AS subroot, r.h AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = r.h AS verified
FROM climb_tops c JOIN nodes t ON t.tree = c.tree AND t.n = 1 JOIN tops r ON r.n = 1 WHERE c.n = 1
"""


@query("op1_sampled_splitters")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Shards of near equal bytes in order of source and document."""
    text = F.coalesce("text", F.lit(""))
    records = table(spark, folder, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return (sharding.shard_by_bytes(records, ["source", "doc_id", "text_crc32"], "size")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


@query("op2_plane_blocks")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids written as plane-shuffled blocks and read back."""
    path = scratch_path(spark, "token-blocks")
    token_files.write_ids(table(spark, folder, "documents"), path, vocabulary())
    return token_files.documents_of(token_files.read_blocks(spark, path))


@query("op3_suffix_sort")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without the stretches of 200 bytes that occur elsewhere."""
    return suffix_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))


@query("op4_gray_index")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash_index.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


@query("op5_association_rules")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict per page; a page's label is that of the document whose number ends its path."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    labels = table(spark, folder, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    number = F.regexp_extract(url_rules.path_of(F.col("url")), "/([0-9]{1,18})[^/]*/?$", 1)
    labelled = pages.select("url", F.when(number != "", number).cast("long").alias("number"))
    labelled = labelled.join(labels, F.col("number") == F.col("doc_id")).select("url", "bad")
    return url_rules.judge(pages, url_rules.mine_rules(labelled)).select("page_id", "host", "path", "rule", "verdict", "confidence")


@query("op6_simhash_windows")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, with the place of the best window."""
    hits = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return hits.select("doc_id", "item_id", "start_word", "n_words", "similarity")


@query("op7_licence_scan")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and expressions of every document."""
    return licences.scan_documents(table(spark, folder, "documents"))


@query("op8_line_quality", line_quality.sql())
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Quality counts and verdict per document."""
    return line_quality.judge(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op9_water_filling")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes from every document."""
    docs = mixing.materialise(table(spark, folder, "documents").select(
        "doc_id", "source", line_quality.word_count(F.col("text")).alias("size"),
        mixing.draw(["doc_id", F.crc32("text")]).alias("draw")), "mix-input")
    plan = mixing.mix_plan(docs, mixing.cyclic_weights(docs))
    return mixing.repetitions(docs, plan).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


@query("op10_block_rules")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract_pages(table(spark, folder, "pages"))


@query("op11_subtree_exchange", MANIFEST_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of all documents by language; where 7 divides the id's checksum, a tampered leaf is shown for the check."""
    docs = table(spark, folder, "documents")
    one_more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 0
    leaves = docs.select("doc_id", "lang", merkle.leaf(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")).alias("leaf"),
                         F.when(tampered, merkle.leaf([F.col("doc_id"), F.col("source"), F.col("lang"), one_more, F.col("text")])).alias("shown"))
    return merkle.manifest(leaves, "lang", "doc_id", "leaf", "shown").select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        "folded_root", "verified")


@query("op12_piece_model")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document by the serialised model, and what they decode to."""
    import public_tokenizers
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encode, decode = byte_bpe.encoder(ranks, public_tokenizers.PATTERN), byte_bpe.decoder(ranks)
    ids = table(spark, folder, "documents").select("doc_id", encode("text").alias("ids"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2(decode("ids"), 256).alias("decoded_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the damage that the contract deals out by checksum."""
    kind = F.pmod(F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", "role", text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


@query("op13_target_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, audit and digest of the repaired form of every conversation after damage."""
    given = table(spark, folder, "conversations")
    turns = damaged(given)
    audits = materialise(conversation_repair.audits(turns), "audits")
    lines = (conversation_repair.repaired(turns, audits).where("edit <> 'D'")
             .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("step", F.concat_ws(":", "role", "text").alias("line")))).alias("lines")))
    # One row per conversation from each part, put together by one grouping, which also matches null ids.
    parts = (given.select("conv_id").distinct().unionByName(audits, allowMissingColumns=True)
             .unionByName(lines.select("conv_id", F.sha2(F.array_join("lines.line", "\n"), 256).alias("hash")), allowMissingColumns=True))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("hash"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
