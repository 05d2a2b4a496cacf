"""Line dedup: lines that many documents share stay in one of them only.

Lines are exploded as 16-byte hashes of their keys, so that text moves once, at
the end. Documents are counted per hash with partial sums in each task, and the
join of the lines with the repeated hashes has one row per hash on one side,
which lets Spark split a hot hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import BLANKS, ascii_lower, digest16, packed, whole_text
from lettermill.storage import stored

MIN_CHARS, MIN_DOCS = 40, 5


def line_key(line: Column) -> Column:
    """What makes two lines the same: no blanks at the ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """id, body (digest of the whole text), pos, line (hash of the key) of the lines that count."""
    text = whole_text()
    exploded = docs.select(
        F.col("doc_id").alias("id"),
        digest16(text).alias("body"),
        F.posexplode(F.split(text, "\n")).alias("pos", "raw"),
    )
    # trimming first: most lines are too short for a hash
    trimmed = exploded.filter(F.length(F.btrim("raw", F.lit(BLANKS))) >= min_chars)
    return trimmed.select("id", "body", "pos", digest16(line_key(F.col("raw"))).alias("line"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Drop the lines whose key has `min_chars` code points and is found in `min_docs`
    documents, except in the document with the largest doc_id that holds it.

    Returns a row per input row: row (struct of all input columns), n_lines, n_dropped,
    kept (the other lines, joined by line feeds).

    A null text is one empty line. Rows of one doc_id are one document when documents
    are counted; each row still gives its own result, so a repeated row gives equal
    rows. Rows without doc_id are together one document, smaller than any other. An
    empty table gives an empty table; columns besides doc_id and text are carried only.
    """
    lines = stored(long_lines(docs, min_chars), "lines")
    repeated = (
        lines.groupBy("line", "id")
        .agg(F.lit(1).alias("one"))
        .groupBy("line")
        .agg(F.count("one").alias("n_docs"), F.max("id").alias("last"))
        .filter(F.col("n_docs") >= min_docs)
        .select("line", "last")
    )
    dropped = (
        lines.join(repeated, "line")
        .filter(~F.col("id").eqNullSafe(F.col("last")))
        .groupBy("id", "body")
        .agg(F.collect_set("pos").alias("drop"))  # of one document: no more than its lines
        .withColumnRenamed("body", "of")
    )
    text = whole_text()
    whole = docs.select(packed(docs), F.col("doc_id").alias("doc"), text.alias("whole"), digest16(text).alias("body"))
    joined = whole.join(dropped, F.col("doc").eqNullSafe(F.col("id")) & (F.col("body") == F.col("of")), "left")

    def rest(parts: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("drop"))
        return F.array_join(F.transform(stay, lambda p: parts[p]), "\n")

    # the array of one element binds the split lines once, not once per line
    kept = F.transform(F.array(F.split("whole", "\n")), rest)[0]
    return joined.select(
        "row",
        (F.length("whole") - F.length(F.replace("whole", F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("whole")).otherwise(kept).alias("kept"),
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


_KEY = (
    "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)


def kept_lines_sql(table: str, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> str:
    """CTEs over `table` (doc_id, text): line_table, line_drop, line_kept (doc_id, n_lines, n_dropped, kept)."""
    return f"""line_parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {table}),
line_table AS (
  SELECT doc_id, pos, line, {_KEY} AS line_key FROM (
    SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM line_parts)),
line_drop AS (
  SELECT line_key, max(doc_id) AS last FROM line_table WHERE length(line_key) >= {min_chars}
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= {min_docs}),
line_kept AS (
  SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
    CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM (SELECT t.*, d.last IS NOT NULL AND t.doc_id <> d.last AS gone
        FROM line_table t LEFT JOIN line_drop d ON t.line_key = d.line_key)
  GROUP BY doc_id)"""


OP1_SQL = f"""WITH {kept_lines_sql('documents')}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM line_kept"""
