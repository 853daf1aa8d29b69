"""Line-first quality rules on DataFrame functions alone.

Every line of a text is judged by itself:

* punctuation: more than 30 % of its characters are punctuation or symbols;
* navigation: three or more separators stand between spaces, or the line has at most three
  words, one of them a usual menu entry, and no sentence ends;
* boilerplate: it holds a phrase of licences, cookie notices or page furniture.

Lines that fail are removed. A document is rejected if it fails the base measures (too short,
or mostly made of repeated word triples) or if the lines removed hold more than half of the
characters of its words.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_PUNCTUATION_PERCENT = 30
MIN_SEPARATORS = 3
MAX_LOST_PERCENT = 50

# Fixed values, in the syntax that Java's regular expressions and RE2 share.
SPACE = r"[ \t\n\x0B\f\r]"
SPACES = SPACE + "+"
SYMBOL = "[#*$%&|<>]"
# At most three words.
FEW_WORDS = r"^[ \t\n\x0B\f\r]*([^ \t\n\x0B\f\r]+([ \t\n\x0B\f\r]+[^ \t\n\x0B\f\r]+){0,2})?[ \t\n\x0B\f\r]*$"
SEPARATOR = r" [|»›·•] "
SENTENCE_END = r"[.!?…]"
MENU = r"(?i)(^|[^\p{L}])(home|menu|login|log in|sign in|sign up|next|previous|contact|about|search|back|top)([^\p{L}]|$)"
PHRASES = (
    "all rights reserved", "copyright", "licensed under", "released under the", "privacy policy",
    "terms of use", "terms of service", "cookie", "enable javascript", "lorem ipsum", "powered by",
    "subscribe to",
)
BOILERPLATE = "(?i)" + "|".join(PHRASES)


def _chars(value: Column) -> Column:
    """Code points other than white space."""
    return F.length(value) - F.regexp_count(value, F.lit(SPACE))


def line_passes(line: Column, furnished: Column) -> Column:
    """Whether a line stays; ``furnished``: whether its text has a boilerplate phrase at all."""
    odd = F.regexp_count(line, F.lit(r"[\p{P}\p{S}]"))
    menu = line.rlike(FEW_WORDS) & line.rlike(MENU) & ~line.rlike(SENTENCE_END)
    return ~(
        (100 * odd > MAX_PUNCTUATION_PERCENT * _chars(line))
        | (F.regexp_count(line, F.lit(SEPARATOR)) >= MIN_SEPARATORS)
        | menu
        | (furnished & line.rlike(BOILERPLATE))
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures and the verdict of every row, and the text that is left of it.

    Returns id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    lines_removed and clean_text. Null and empty texts have no words and fail the base measures.
    Repeated rows and ids give a row each; other columns are left out, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select(
        "*",
        F.transform(F.array_remove(F.split("text", SPACES), ""), lambda w: F.xxhash64(w)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\x0b\f\r", "    "))) > 0).alias("lines"),
        reduce(or_, (F.lower("text").contains(p) for p in PHRASES)).alias("furnished"),
    )
    # Triples of words as hashes: they are compared within one text only.
    rows = rows.select(
        "*",
        F.expr(
            "transform(slice(words, 1, greatest(size(words) - 2, 0)),"
            " (w, i) -> xxhash64(w, words[i + 1], words[i + 2]))"
        ).alias("triples"),
        F.filter("lines", lambda x: line_passes(x, F.col("furnished"))).alias("good"),
    )
    rows = rows.select(
        "*",
        F.expr(
            "if(size(array_distinct(triples)) < size(triples),"
            " sort_array(transform(triples, (h, i) -> struct(h AS h, i AS i))),"
            " CAST(array() AS array<struct<h: bigint, i: int>>))"
        ).alias("sorted"),
    )
    repeated = F.expr(
        "size(array_distinct(flatten(transform(filter(sorted, (x, k) ->"
        " (k > 0 AND x.h = sorted[greatest(k - 1, 0)].h)"
        " OR (k < size(sorted) - 1 AND x.h = sorted[least(k + 1, size(sorted) - 1)].h)),"
        " x -> array(x.i, x.i + 1, x.i + 2)))))"
    )
    rows = rows.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        _chars(F.col("text")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        (F.size("lines") - F.size("good")).cast("long").alias("lines_removed"),
        F.array_join("good", "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    lost = F.col("word_chars") - _chars(F.col("clean_text"))
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (100 * lost <= MAX_LOST_PERCENT * F.col("word_chars"))).alias("kept"),
        "lines_removed",
        "clean_text",
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_SQL_SPACES = _sql_text(r"[ \t\n\x0B\f\r]+")

ORACLE_SQL = f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), {_SQL_SPACES}), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS lines,
         row_number() OVER () AS row
  FROM documents
),
triple AS (
  SELECT row, unnest(range(1, len(words) - 1)) AS i, words FROM base WHERE len(words) >= 3
),
spelled AS (SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS t FROM triple),
counted AS (SELECT row, i, count(*) OVER (PARTITION BY row, t) AS n FROM spelled),
covered AS (
  SELECT row, count(DISTINCT p) AS n
  FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE n > 1) GROUP BY row
),
good AS (
  SELECT *, list_filter(lines, lambda x: NOT (
    100 * length(regexp_replace(x, '[^\\p{{P}}\\p{{S}}]', '', 'g'))
      > {MAX_PUNCTUATION_PERCENT} * length(regexp_replace(x, {_SQL_SPACES}, '', 'g'))
    OR len(regexp_extract_all(x, {_sql_text(SEPARATOR)})) >= {MIN_SEPARATORS}
    OR (regexp_matches(x, {_sql_text(FEW_WORDS)})
        AND regexp_matches(x, {_sql_text(MENU)}) AND NOT regexp_matches(x, {_sql_text(SENTENCE_END)}))
    OR regexp_matches(x, {_sql_text(BOILERPLATE)}))) AS good
  FROM base
),
measured AS (
  SELECT doc_id, len(words) AS n_words,
         length(regexp_replace(text, {_SQL_SPACES}, '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, {_sql_text(SYMBOL)}, '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         len(lines) - len(good) AS lines_removed,
         length(regexp_replace(array_to_string(good, chr(10)), {_SQL_SPACES}, '', 'g')) AS left_chars
  FROM good LEFT JOIN covered USING (row)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words) AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words)
         AND 100 * (word_chars - left_chars) <= {MAX_LOST_PERCENT} * word_chars AS kept,
       CAST(lines_removed AS BIGINT) AS lines_removed
FROM measured
"""
