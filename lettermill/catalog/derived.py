"""A bucket derived from `documents`, the same way in Spark and in SQL.

Every document is one bucket file. Tenants are the sources; dates, folders and
suffixes follow from the document number. The text gets the framing that the
canonical form must undo: byte order marks, separator lines, other line ends
and trailing blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.functions import identity, paths
from lettermill.operators.unpack import leaf_key

SUFFIXES = [".eml", ".html", ".htm", ".EML", ".msg", ".pst", ".png", ".eml", ".Html", ".eml"]
FOLDERS = ["", "in/", "in/box/"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(options: list[str], at: Column) -> Column:
    return F.array(*[F.lit(o) for o in options])[at.cast("int")]


def framed_text(text: str = "text", doc_id: str = "doc_id") -> Column:
    t, k = F.col(text), F.col(doc_id) % 6
    return (
        F.when(k == 1, F.concat(F.lit("\ufeff"), t))
        .when(k == 2, F.concat(F.lit("From mailer@example.com Mon Jul 15 10:00:00 2024\n"), t))
        .when(k == 3, F.replace(t, F.lit("\n"), F.lit("\r\n")))
        .when(k == 4, F.concat(t, F.lit(" \t\r\n")))
        .when(k == 5, F.replace(t, F.lit("\n"), F.lit("\r")))
        .otherwise(t)
    )


def bucket_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, namespace, partition, relpath, raw, size_bytes, mtime_ns."""
    d = table(spark, sf_dir, "documents")
    raw = framed_text().cast("binary")
    return d.select(
        "doc_id",
        F.col("source").alias("namespace"),
        F.concat(
            F.lit("timestamp=2024-07-"), F.lpad((F.col("doc_id") % 7 + 15).cast("string"), 2, "0")
        ).alias("partition"),
        F.concat(
            _choose(FOLDERS, F.col("doc_id") % 3),
            F.col("doc_id").cast("string"),
            _choose(SUFFIXES, F.col("doc_id") % 10),
        ).alias("relpath"),
        raw.alias("raw"),
        "lang",
        F.col("n_chars").alias("size_bytes"),
        (F.col("doc_id") * 1_000_000_000).alias("mtime_ns"),
    )


def as_items(files: DataFrame) -> DataFrame:
    """Bucket files as unpack items at depth 0."""
    return files.withColumns(
        {
            "source_id": identity.source_id("namespace", "partition", "relpath"),
            "internal_path": F.col("relpath"),
            "container_depth": F.lit(0),
            "pos": F.array().cast("array<int>"),
        }
    )


def leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mail files of the derived bucket as leaves."""
    return mail_leaves(bucket_files(spark, sf_dir))


def mail_leaves(files: DataFrame) -> DataFrame:
    kind = paths.classify_item("relpath")
    return (
        as_items(files)
        .withColumn("format", kind)
        .filter(F.col("format").isin("eml", "html"))
        .withColumns(
            {
                "msg_idx": F.lit(None).cast("int"),
                "email_id": identity.email_id("namespace", "raw"),
                "content_sha256": identity.content_sha256("raw"),
                "size_bytes": F.octet_length("raw").cast("bigint"),
            }
        )
        .withColumn("leaf_key", leaf_key())
    )


# --- the same in SQL --------------------------------------------------------

FRAMED_SQL = """CASE doc_id % 6
  WHEN 1 THEN chr(65279) || text
  WHEN 2 THEN 'From mailer@example.com Mon Jul 15 10:00:00 2024' || chr(10) || text
  WHEN 3 THEN replace(text, chr(10), chr(13) || chr(10))
  WHEN 4 THEN text || ' ' || chr(9) || chr(13) || chr(10)
  WHEN 5 THEN replace(text, chr(10), chr(13))
  ELSE text END"""


def canonical_sql(text: str) -> str:
    """Canonical form of a text value."""
    no_bom = f"CASE WHEN starts_with({text}, chr(65279)) THEN substr({text}, 2) ELSE {text} END"
    no_from = f"regexp_replace({no_bom}, '^From [^\\r\\n]*\\r?\\n', '')"
    lf = f"replace(replace({no_from}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return f"rtrim({lf}, chr(13) || chr(10) || chr(9) || ' ')"


def email_id_sql(namespace: str, text: str) -> str:
    return f"sha256(concat({namespace}, chr(0), {canonical_sql(text)}))"


def source_id_sql(namespace: str = "namespace", partition: str = "partition", relpath: str = "relpath") -> str:
    return f"sha256(concat({namespace}, chr(0), {partition}, chr(0), {relpath}))"


def kind_sql(name: str) -> str:
    low = f"lower({name})"
    return f"""CASE WHEN ends_with({low}, '.eml') THEN 'eml'
      WHEN ends_with({low}, '.html') OR ends_with({low}, '.htm') THEN 'html'
      WHEN ends_with({low}, '.mbox') THEN 'mbox'
      WHEN ends_with({low}, '.zip') THEN 'zip'
      WHEN ends_with({low}, '.msg') OR ends_with({low}, '.pst') THEN 'unsupported'
      ELSE 'noise' END"""


ORDER_KEY_SQL = (
    "list_transform(string_split(relpath, '/'), lambda p, i: "
    "{'is_dir': i < len(string_split(relpath, '/')), 'name': p})"
)


def _list(options: list[str]) -> str:
    return "[" + ", ".join(f"'{o}'" for o in options) + "]"


FILES_CTE = f"""files AS (
  SELECT doc_id, lang, source AS namespace,
    'timestamp=2024-07-' || lpad(CAST(doc_id % 7 + 15 AS VARCHAR), 2, '0') AS partition,
    {_list(FOLDERS)}[CAST(doc_id % 3 AS INTEGER) + 1] || doc_id
      || {_list(SUFFIXES)}[CAST(doc_id % 10 AS INTEGER) + 1] AS relpath,
    {FRAMED_SQL} AS body, n_chars AS size_bytes, doc_id * 1000000000 AS mtime_ns
  FROM documents)"""

LEAVES_CTE = f"""{FILES_CTE}, leaves AS (
  SELECT doc_id, lang, namespace, partition, relpath, {kind_sql('relpath')} AS format, body,
    {email_id_sql('namespace', 'body')} AS email_id,
    sha256(body) AS content_sha256,
    CAST(octet_length(encode(body)) AS BIGINT) AS size_bytes,
    {source_id_sql()} AS source_id,
    {ORDER_KEY_SQL} AS path_key
  FROM files WHERE {kind_sql('relpath')} IN ('eml', 'html'))"""
