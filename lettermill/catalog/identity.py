"""Identity, names and scan order."""

from __future__ import annotations

from pyspark.sql import functions as F

from lettermill.catalog import query
from lettermill.catalog.derived import (
    FILES_CTE,
    FRAMED_SQL,
    LEAVES_CTE,
    ORDER_KEY_SQL,
    bucket_files,
    email_id_sql,
    framed_text,
    kind_sql,
    leaves,
    table,
)
from lettermill.functions import identity, paths
from lettermill.operators.order import scan_rank
from lettermill.storage import new_work_dir


@query(
    "canonical_email_ids",
    f"""WITH framed AS (SELECT doc_id, source AS namespace, {FRAMED_SQL} AS body FROM documents),
    ids AS (SELECT doc_id, namespace, {email_id_sql('namespace', 'body')} AS email_id FROM framed)
    SELECT namespace, email_id, count(*) AS copies, min(doc_id) AS first_doc_id
    FROM ids GROUP BY namespace, email_id""",
)
def canonical_email_ids(spark, sf_dir):
    """Tenant-scoped identity of every document, reduced to distinct emails."""
    framed = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("namespace"), framed_text().cast("binary").alias("raw")
    )
    ids = framed.select("doc_id", "namespace", identity.email_id("namespace", "raw").alias("email_id"))
    return ids.groupBy("namespace", "email_id").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first_doc_id")
    )


@query(
    "content_hash",
    f"""WITH framed AS (SELECT doc_id, {FRAMED_SQL} AS body FROM documents)
    SELECT doc_id, sha256(body) AS content_sha256,
      CAST(octet_length(encode(body)) AS BIGINT) AS size_bytes FROM framed""",
)
def content_hash(spark, sf_dir):
    raw = framed_text().cast("binary")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        identity.content_sha256(raw).alias("content_sha256"),
        F.octet_length(raw).cast("bigint").alias("size_bytes"),
    )


_NASTY = ["a\\b/", "./x//", "/top/", "//net/", "x/./y/", ""]


@query(
    "source_ids",
    r"""WITH p AS (SELECT doc_id, source AS namespace,
      'timestamp=2024-07-' || lpad(CAST(doc_id % 7 + 15 AS VARCHAR), 2, '0') AS partition,
      ['a\b/', './x//', '/top/', '//net/', 'x/./y/', ''][CAST(doc_id % 6 AS INTEGER) + 1]
        || doc_id || '.eml' AS relpath FROM documents),
    n AS (SELECT *, ['a/b/', 'x/', '/top/', '//net/', 'x/y/', ''][CAST(doc_id % 6 AS INTEGER) + 1]
        || doc_id || '.eml' AS posix_relpath FROM p)
    SELECT doc_id, relpath, posix_relpath,
      sha256(concat(namespace, chr(0), partition, chr(0), posix_relpath)) AS source_id FROM n""",
)
def source_ids(spark, sf_dir):
    """Location ids of paths that need normalizing."""
    prefix = F.array(*[F.lit(p) for p in _NASTY])[(F.col("doc_id") % 6).cast("int")]
    rows = bucket_files(spark, sf_dir).select(
        "doc_id", "namespace", "partition",
        F.concat(prefix, F.col("doc_id").cast("string"), F.lit(".eml")).alias("relpath"),
    )
    return rows.select(
        "doc_id", "relpath",
        identity.posix_relpath("relpath").alias("posix_relpath"),
        identity.source_id("namespace", "partition", "relpath").alias("source_id"),
    )


@query(
    "pool_paths",
    f"""WITH {LEAVES_CTE}
    SELECT doc_id, format, CASE WHEN format = 'html' THEN '.html' ELSE '.eml' END AS ext,
      'emails/' || substr(email_id, 1, 2) || '/' || email_id ||
      CASE WHEN format = 'html' THEN '.html' ELSE '.eml' END AS pool_path FROM leaves""",
)
def pool_paths(spark, sf_dir):
    return leaves(spark, sf_dir).select(
        "doc_id", "format",
        identity.leaf_suffix("format").alias("ext"),
        identity.pool_path("email_id", "format").alias("pool_path"),
    )


_PLACES = ["", "batch.zip!", "batch.zip!in/deep.zip!", "box.mbox#", "a#b/"]


@query(
    "basename_classify",
    f"""WITH {FILES_CTE}, p AS (SELECT doc_id,
      ['', 'batch.zip!', 'batch.zip!in/deep.zip!', 'box.mbox#', 'a#b/'][CAST(doc_id % 5 AS INTEGER) + 1]
        || relpath AS internal_path FROM files),
    b AS (SELECT doc_id, internal_path,
      list_last(string_split(list_last(string_split(string_split(internal_path, '#')[1], '!')), '/'))
        AS basename FROM p),
    k AS (SELECT *, {kind_sql('basename')} AS kind FROM b)
    SELECT *, CASE kind WHEN 'unsupported' THEN 'unsupported_format_deferred'
      WHEN 'noise' THEN 'not_an_email' END AS reason FROM k""",
)
def basename_classify(spark, sf_dir):
    """Names inside containers, their kind and the skip they lead to."""
    place = F.array(*[F.lit(p) for p in _PLACES])[(F.col("doc_id") % 5).cast("int")]
    rows = bucket_files(spark, sf_dir).select(
        "doc_id", F.concat(place, F.col("relpath")).alias("internal_path")
    )
    rows = rows.withColumns(
        {"basename": paths.basename_of("internal_path"), "kind": paths.classify_item("internal_path")}
    )
    return rows.withColumn(
        "reason",
        F.when(F.col("kind") == "unsupported", "unsupported_format_deferred")
        .when(F.col("kind") == "noise", "not_an_email"),
    )


_MEMBERS = ["", "/", "\\", "../", "a/../", "a\\..\\", "..a/", "a../"]


@query(
    "unsafe_members",
    r"""WITH m AS (SELECT doc_id, ['', '/', '\', '../', 'a/../', 'a\..\', '..a/', 'a../']
      [CAST(doc_id % 8 AS INTEGER) + 1] || doc_id || '.eml' AS member FROM documents)
    SELECT doc_id, member, doc_id % 8 IN (1, 2, 3, 4, 5) AS unsafe FROM m""",
)
def unsafe_members(spark, sf_dir):
    prefix = F.array(*[F.lit(p) for p in _MEMBERS])[(F.col("doc_id") % 8).cast("int")]
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(prefix, F.col("doc_id").cast("string"), F.lit(".eml")).alias("member")
    )
    return rows.withColumn("unsafe", paths.is_unsafe_member("member"))


_DIRS = ["timestamp=2024-07-15", "timestamp=2024-99-99", "timestamp=bad", "_metadata",
         "timestamp=2024-7-15", "xtimestamp=2024-07-15"]


@query(
    "scan_partition_filter",
    """WITH d AS (SELECT doc_id, ['timestamp=2024-07-15', 'timestamp=2024-99-99', 'timestamp=bad',
      '_metadata', 'timestamp=2024-7-15', 'xtimestamp=2024-07-15'][CAST(doc_id % 6 AS INTEGER) + 1] AS dir
      FROM documents)
    SELECT doc_id, dir, TRY_CAST(substr(dir, 11, 10) AS DATE) AS day FROM d
    WHERE regexp_full_match(dir, 'timestamp=[0-9]{4}-[0-9]{2}-[0-9]{2}')""",
)
def scan_partition_filter(spark, sf_dir):
    """Date directories by name; the digits need not be a date."""
    pick = F.array(*[F.lit(p) for p in _DIRS])[(F.col("doc_id") % 6).cast("int")]
    rows = table(spark, sf_dir, "documents").select("doc_id", pick.alias("dir"))
    return rows.filter(paths.is_partition_dir("dir")).withColumn("day", paths.partition_date("dir"))


@query(
    "scan_order",
    f"""WITH {FILES_CTE}
    SELECT doc_id, namespace, partition, relpath, row_number() OVER (
      ORDER BY namespace, partition, {ORDER_KEY_SQL}) AS rank FROM files""",
)
def scan_order(spark, sf_dir):
    """Position of every file in the order a scan reports them."""
    files = bucket_files(spark, sf_dir).select("doc_id", "namespace", "partition", "relpath")
    return scan_rank(files, new_work_dir(spark, "scan-order"))


@query(
    "page_email_ids",
    f"""WITH p AS (SELECT page_id, regexp_extract(url, '://([^/]+)', 1) AS namespace, html FROM pages),
    ids AS (SELECT page_id, namespace, {email_id_sql('namespace', 'html')} AS email_id FROM p)
    SELECT namespace, email_id, count(*) AS copies, min(page_id) AS first_page_id,
      'emails/' || substr(email_id, 1, 2) || '/' || email_id || '.html' AS pool_path
    FROM ids GROUP BY namespace, email_id""",
)
def page_email_ids(spark, sf_dir):
    """HTML leaves; the host of a page is its tenant, and one host may hold most."""
    ids = table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("url", "://([^/]+)", 1).alias("namespace"),
        F.col("html").cast("binary").alias("raw"),
    ).select("page_id", "namespace", identity.email_id("namespace", "raw").alias("email_id"))
    return (
        ids.groupBy("namespace", "email_id")
        .agg(F.count("*").alias("copies"), F.min("page_id").alias("first_page_id"))
        .withColumn("pool_path", identity.pool_path("email_id", F.lit("html")))
    )


@query(
    "tenant_isolation",
    f"""WITH {LEAVES_CTE}, t AS (SELECT lang AS tenant, {email_id_sql('lang', 'body')} AS email_id FROM leaves
      UNION ALL SELECT 'archive', {email_id_sql("'archive'", 'body')} FROM leaves)
    SELECT tenant, count(*) AS files, count(DISTINCT email_id) AS emails FROM t GROUP BY tenant""",
)
def tenant_isolation(spark, sf_dir):
    """The same mail under two tenants is two emails."""
    mail = leaves(spark, sf_dir)
    both = mail.select(
        F.explode(F.array("lang", F.lit("archive"))).alias("tenant"),
        identity.canonicalize("raw").alias("canonical"),
    )
    ids = both.select("tenant", identity.email_id_of_canonical("tenant", F.col("canonical")).alias("email_id"))
    files = ids.groupBy("tenant").agg(F.count("*").alias("files"))
    emails = ids.distinct().groupBy("tenant").agg(F.count("*").alias("emails"))
    return files.join(emails, "tenant")
