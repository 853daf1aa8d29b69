"""The same results in DuckDB's SQL, for the operators that SQL can express.

A window has 50 words or bytes.
"""

from __future__ import annotations

from tidemark.llm import quality

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"
_BYTES = "regexp_extract_all(hex(encode(coalesce(text, ''))), '..')"


def _removed(units: str, joined_by: str) -> str:
    return f"""
WITH doc AS (SELECT row_number() OVER () AS row, doc_id, {units} AS units FROM documents),
unit AS (
  SELECT row, doc_id, len(units) AS n, unnest(units) AS unit, unnest(range(1, len(units) + 1)) AS p
  FROM doc
),
window_ AS (
  SELECT *, CASE WHEN p + 49 <= n THEN string_agg(unit, '{joined_by}') OVER (
              PARTITION BY row ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) END AS s
  FROM unit
),
earliest AS (SELECT s, min(doc_id) AS first_id FROM window_ WHERE s IS NOT NULL GROUP BY s),
marked AS (
  SELECT w.*, coalesce(w.doc_id > e.first_id, FALSE) AS late
  FROM window_ w LEFT JOIN earliest e ON w.s = e.s
),
covered AS (
  SELECT row, p, unit, bool_or(late) OVER (
           PARTITION BY row ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM marked
),
span AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY row ORDER BY p), FALSE) AS begins
  FROM covered
),
text_ AS (
  SELECT row, count(*) AS n, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
         coalesce(string_agg(unit, '{joined_by}' ORDER BY p) FILTER (NOT gone), '') AS kept
  FROM span GROUP BY row
)"""


ORACLE_SQL = {
    "op1_quality_rules": quality.ORACLE_SQL,
    "op6_phrases": _removed(_WORDS, " ")
    + """
SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN text_ USING (row)""",
    "op7_suffixes": _removed(_BYTES, "")
    + """
SELECT doc_id, coalesce(n, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(from_hex(coalesce(kept, ''))) AS kept_sha256
FROM doc LEFT JOIN text_ USING (row)""",
}
