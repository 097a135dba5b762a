"""Line-first quality rules.

Every line of a text is judged on its own: punctuation, navigation and boilerplate rules. Lines
that fail are removed; a document that loses too much of its text is rejected. Document-wide base
counts (length, symbols, repeated lines, repeated eight-word windows) reject on their own.

Defined results: a null text counts as empty and gives zero counts; an empty text fails the base
rules; repeated rows are judged alike; nothing depends on other rows; further columns are kept.
All of it is Spark SQL expressions, evaluated row by row without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the base rules.
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"  # the same, as characters
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Line rules.
TERMINAL = r"""[.!?:;…。"'”’»)\]]\z"""
SHORT_LINE = 8             # words; a shorter line needs a terminal mark
MARK_WORD = r"(!!|\?\?|[#*$%&|<>]{2,})"     # shouting and symbol runs
SEPARATOR = r"(^|\x20)[|>»›•·/\\-](\x20|\z)"  # menu separators standing alone
MAX_MARK_SHARE = 0.3       # of the words of a line
MAX_SEPARATOR_SHARE = 0.2
BOILERPLATE = [            # phrases of notices; only lines of fewer than BOILERPLATE_WORDS words
    "all rights reserved", "privacy policy", "cookie policy", "terms of use", "terms of service", "accept cookies",
    "enable javascript", "lorem ipsum", "click here", "sign up", "log in", "subscribe", "share this", "read more",
]
BOILERPLATE_WORDS = 12
MIN_KEPT_SHARE = 0.5       # of a text's non-space characters


def words_of(text: Column) -> Column:
    """Words of a text; empty for null and for white space alone."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _with_struct(docs: DataFrame, fields: list[Column]) -> DataFrame:
    """``docs`` with further columns from one generator row, so that later filters don't compute them again."""
    return docs.select("*", F.inline(F.array(F.struct(*fields))))


def _repeated_places(hashes: Column) -> Column:
    """Ascending places of the values that occur more than once; values are sorted only if there are some."""
    def places(s: Column) -> Column:
        same = lambda j, k: F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
        return F.sort_array(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: same(j, j - 1) | same(j, j + 1)), lambda j: F.get(s, j)["i"]))

    none = F.array().cast("array<int>")
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _let(
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), places)).otherwise(none))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words found more than once; ``words`` is used many times."""
    hashes = F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    return _let(_repeated_places(hashes), lambda p: F.when(F.size(p) == 0, 0).otherwise(F.aggregate(
        F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1),
                   lambda a, b: F.least(F.lit(WINDOW), b - a)), F.lit(WINDOW), lambda a, x: a + x))).cast("long")


def with_base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(WORD))
    counts = _let(words_of(F.col(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    counted = _with_struct(docs, [
        counts.alias("_q"), F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")])
    failed = (F.col("_q.n_words") < MIN_WORDS) | (100 * F.col("_q.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_q.n_words"))
    return counted.select(*docs.columns, "_q.n_words", "_q.word_chars", "n_symbols", "n_dup_lines", "_q.n_repeat_words",
                          failed.alias("base_failed"))


def line_fails(line: Column) -> Column:
    """The line rules: whether one line goes. Lines without a word stay."""
    return _let(F.regexp_count(line, F.lit(WORD)), lambda n: _line_fails(line, n))


def _line_fails(line: Column, n: Column) -> Column:
    bare = (n < SHORT_LINE) & ~F.rtrim(line, F.lit(SPACES)).rlike(TERMINAL)
    shouting = F.regexp_count(line, F.lit(MARK_WORD)) > n * MAX_MARK_SHARE
    menu = F.regexp_count(line, F.lit(SEPARATOR)) > n * MAX_SEPARATOR_SHARE
    notice = (n < BOILERPLATE_WORDS) & F.lower(line).rlike("|".join(BOILERPLATE))
    return (n > 0) & (bare | shouting | menu | notice)


def with_cleaned(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``cleaned`` (the lines that pass), ``kept_share`` of non-space characters, and ``line_kept``."""
    t = F.coalesce(F.col(text), F.lit(""))
    chars = lambda c: F.char_length(F.regexp_replace(c, SPACE + "+", ""))
    cleaned = F.array_join(F.filter(F.split(t, "\n"), lambda line: ~line_fails(line)), "\n")
    return (_with_struct(docs, [cleaned.alias("cleaned")])
            .withColumn("kept_share", F.when(F.col("cleaned") == t, F.lit(1.0))
                        .when(chars(t) > 0, chars(F.col("cleaned")) / chars(t)).otherwise(0.0))
            .withColumn("line_kept", F.col("kept_share") >= MIN_KEPT_SHARE))


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with base counts, ``cleaned`` text, ``kept_share`` and ``kept`` (both kinds of rules pass)."""
    return (with_cleaned(with_base_counts(docs, text), text)
            .withColumn("kept", ~F.col("base_failed") & F.col("line_kept")).drop("line_kept"))


def sql(documents: str = "documents") -> str:
    """The base counts and the verdict as SQL, for comparison."""
    lit = lambda x: "'" + x.replace("'", "''") + "'"
    count = lambda x, p: f"len(regexp_extract_all({x}, {lit(p)}))"
    chars = lambda x: f"length(regexp_replace({x}, {lit(SPACE + '+')}, '', 'g'))"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM {documents}),
w AS MATERIALIZED (SELECT rn, list_filter(regexp_split_to_array(t, {lit(SPACE + '+')}), lambda x: x <> '') AS ws FROM d),
windows AS (
  SELECT rn, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k
  FROM (SELECT rn, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
repeated AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, k) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT rn, sum(least({WINDOW}, coalesce(later - i, {WINDOW}))) AS c
  FROM (SELECT rn, i, lead(i) OVER (PARTITION BY rn ORDER BY i) AS later FROM repeated) GROUP BY rn),
lines AS (SELECT rn, line, {count('line', WORD)} AS n FROM (SELECT rn, unnest(string_split(t, chr(10))) AS line FROM d)),
judged AS (
  SELECT *, n > 0 AND ((n < {SHORT_LINE} AND NOT regexp_matches(rtrim(line, {lit(SPACES)}), {lit(TERMINAL)}))
    OR {count('line', MARK_WORD)} > n * {MAX_MARK_SHARE} OR {count('line', SEPARATOR)} > n * {MAX_SEPARATOR_SHARE}
    OR (n < {BOILERPLATE_WORDS} AND regexp_matches(lower(line), {lit('|'.join(BOILERPLATE))}))) AS fails
  FROM lines),
by_line AS (
  SELECT rn, count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0) AS dups,
         coalesce(sum({chars('line')}) FILTER (WHERE NOT fails), 0) AS left_, sum({chars('line')}) AS all_
  FROM judged GROUP BY rn),
counted AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         {count('t', SYMBOLS)} AS n_symbols, dups AS n_dup_lines, coalesce(c, 0) AS n_repeat_words,
         CASE WHEN all_ > 0 THEN left_ / all_ ELSE 0 END AS share
  FROM d JOIN w USING (rn) JOIN by_line USING (rn) LEFT JOIN covered USING (rn))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND share >= {MIN_KEPT_SHARE} AS kept
FROM counted"""
