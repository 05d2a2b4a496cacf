"""Mailboxes, archives, nesting and skips."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from lettermill.catalog import query
from lettermill.catalog.builders import (
    damage,
    mailbox,
    mailbox_sql,
    make_zip,
    mark_encrypted,
    members,
    messages_cte,
    pack_zip,
)
from lettermill.catalog.derived import (
    FRAMED_SQL,
    as_items,
    email_id_sql,
    framed_text,
    table,
)
from lettermill.functions import identity, paths
from lettermill.operators import dedup
from lettermill.operators.archive import explode_zip
from lettermill.operators.mbox import explode_mbox
from lettermill.operators.unpack import UnpackLimits, unpack
from lettermill.storage import new_work_dir

_SIZE_SQL = "CAST(octet_length(encode(body)) AS BIGINT)"


def _described(messages, *keys):
    return messages.select(
        *keys, "msg_idx",
        identity.content_sha256("raw").alias("content_sha256"),
        F.octet_length("raw").cast("bigint").alias("size_bytes"),
    )


_TURN = ("'X-Role: ' || role || chr(10) || chr(10) || text", "text", "''")


@query(
    "mbox_split",
    f"""WITH boxes AS (SELECT conv_id, turn, {mailbox_sql(*_TURN)} AS box FROM conversations),
    {messages_cte('boxes', 'conv_id, turn')}
    SELECT conv_id, turn, msg_idx, sha256(body) AS content_sha256, {_SIZE_SQL} AS size_bytes,
      conv_id || '-' || turn || '.mbox#' || msg_idx AS internal_path FROM messages""",
)
def mbox_split(spark, sf_dir):
    """Mailboxes of three messages, one mailbox per conversation turn."""
    text = F.col("text")
    headed = F.concat(F.lit("X-Role: "), F.col("role"), F.lit("\n\n"), text)
    boxes = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", mailbox(headed, text, F.lit("")).cast("binary").alias("raw")
    )
    name = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"), F.lit(".mbox"))
    return _described(explode_mbox(boxes), "conv_id", "turn").withColumn(
        "internal_path", paths.mbox_hop(name, "msg_idx")
    )


_BODY = ("text", "'Subject: ' || lang || chr(10) || text || chr(10)")


@query(
    "mbox_from_in_body",
    f"""WITH boxes AS (SELECT doc_id, 'preamble' || chr(10) || {mailbox_sql(*_BODY)} AS box FROM documents),
    {messages_cte('boxes', 'doc_id')}
    SELECT doc_id, msg_idx, sha256(body) AS content_sha256, {_SIZE_SQL} AS size_bytes FROM messages""",
)
def mbox_from_in_body(spark, sf_dir):
    """Whole documents as messages: a body line that starts like a separator
    splits its message, and text before the first separator is lost."""
    text = F.col("text")
    subject = F.concat(F.lit("Subject: "), F.col("lang"), F.lit("\n"), text, F.lit("\n"))
    boxes = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("preamble\n"), mailbox(text, subject)).cast("binary").alias("raw")
    )
    return _described(explode_mbox(boxes), "doc_id")


def _archives(frame, name="relpath"):
    """Rows with doc_id and raw as unpack items of one tenant."""
    located = frame.select(
        "doc_id", F.lit("tenant").alias("namespace"), F.lit("timestamp=2024-07-15").alias("partition"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".zip")).alias("relpath") if name == "relpath"
        else F.col(name).alias("relpath"),
        "raw",
    )
    return as_items(located)


def _spread_documents(spark, sf_dir):
    """Documents spread evenly however the table is cut into files."""
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang").repartition("doc_id")


@query(
    "zip_roundtrip",
    f"""WITH m AS (
      SELECT doc_id, doc_id || '.zip!a/plain.eml' AS internal_path, text AS body FROM documents
      UNION ALL SELECT doc_id, doc_id || '.zip!b.html', {FRAMED_SQL} FROM documents
      UNION ALL SELECT doc_id, doc_id || '.zip!z.txt', lang FROM documents)
    SELECT internal_path, 1 AS container_depth,
      list_position(['a/plain.eml', 'b.html', 'z.txt'], split_part(internal_path, '!', 2)) - 1 AS position,
      sha256(body) AS content_sha256, {_SIZE_SQL} AS size_bytes FROM m""",
)
def zip_roundtrip(spark, sf_dir):
    """Documents packed and unpacked; directories and unsafe names vanish."""
    packed = pack_zip(
        _spread_documents(spark, sf_dir).select(
            "doc_id",
            members(
                ("z.txt", F.col("lang")), ("b.html", framed_text()), ("a/", F.lit("")),
                ("a/plain.eml", F.col("text")), ("../up.eml", F.col("lang")), ("/top.eml", F.col("lang")),
            ).alias("members"),
        ),
        "members", "raw",
    )
    return explode_zip(_archives(packed)).select(
        "internal_path", "container_depth", F.col("pos")[0].alias("position"),
        identity.content_sha256("raw").alias("content_sha256"),
        F.octet_length("raw").cast("bigint").alias("size_bytes"),
    )


def nested(spark, sf_dir):
    """<id>.zip holding inner.zip (mail.mbox of two messages, page.html),
    note.txt and top.eml, unpacked."""
    text = F.col("text")
    inner = pack_zip(
        _spread_documents(spark, sf_dir).select(
            "doc_id", "text", "lang",
            members(("mail.mbox", mailbox(text, F.concat(F.col("lang"), F.lit(" "), text))),
                    ("page.html", framed_text())).alias("members"),
        ),
        "members", "inner",
    )
    outer = pack_zip(
        inner.select(
            "doc_id",
            members(("top.eml", text), ("inner.zip", F.col("inner")), ("note.txt", F.col("lang"))).alias("members"),
        ),
        "members", "raw",
    )
    return unpack(_archives(outer), new_work_dir(spark, "nested"))


NESTED_CTE = f"""boxes AS (SELECT doc_id, {mailbox_sql('text', "lang || ' ' || text")} AS box FROM documents),
    {messages_cte('boxes', 'doc_id')},
    found AS (
      SELECT doc_id || '.zip!inner.zip!mail.mbox#' || msg_idx AS internal_path, 3 AS container_depth,
        'eml' AS format, 2 AS hops, '0.0' AS pos, msg_idx, body FROM messages
      UNION ALL SELECT doc_id || '.zip!inner.zip!page.html', 2, 'html', 2, '0.1', -1, {FRAMED_SQL} FROM documents
      UNION ALL SELECT doc_id || '.zip!top.eml', 1, 'eml', 1, '2', -1, text FROM documents)"""


@query(
    "nested_lineage",
    f"""WITH {NESTED_CTE} SELECT internal_path, container_depth, format,
      {email_id_sql("'tenant'", 'body')} AS email_id, sha256(body) AS content_sha256,
      {_SIZE_SQL} AS size_bytes FROM found""",
)
def nested_lineage(spark, sf_dir):
    """Leaves of archives in archives with their path and depth."""
    return nested(spark, sf_dir).leaves.select(
        "internal_path", "container_depth", "format", "email_id", "content_sha256", "size_bytes"
    )


@query(
    "nested_first_seen",
    f"""WITH {NESTED_CTE}, ranked AS (SELECT *, {email_id_sql("'tenant'", 'body')} AS email_id FROM found),
    rn AS (SELECT *, row_number() OVER (PARTITION BY email_id ORDER BY split_part(internal_path, '!', 1),
        hops, pos, msg_idx) AS rn, count(*) OVER (PARTITION BY email_id) AS copies FROM ranked)
    SELECT email_id, copies, format, pos || CASE WHEN msg_idx >= 0 THEN '#' || msg_idx ELSE '' END AS leaf_key,
      sha256(body) AS content_sha256 FROM rn WHERE rn = 1""",
)
def nested_first_seen(spark, sf_dir):
    """Breadth-first order inside an archive decides which copy counts."""
    ids = nested(spark, sf_dir).leaves.drop("raw")
    return dedup.email_winners(dedup.blob_winners(ids)).select(
        "email_id", "copies", "format", "leaf_key", "content_sha256"
    )


_LIMITS = UnpackLimits(max_depth=2, max_member_bytes=2000)
_NAMES = ["cut.zip", "locked.zip", "empty.zip", "empty.mbox", "mail.msg", "store.pst", "noise.png",
          "damaged.zip", "large.zip", "deep.zip"]


def bad_containers(spark, sf_dir):
    """One broken, empty, foreign, oversized or too deep file per document."""

    def build(kind: int, text: bytes, lang: bytes) -> bytes:
        small = [("x.eml", lang * 50)]
        if kind == 0:
            return make_zip(small)[:32]
        if kind == 1:
            return mark_encrypted(make_zip(small))
        if kind == 2:
            return make_zip([])
        if kind == 3:
            return b""
        if kind in (4, 5, 6):
            return text
        if kind == 7:
            return damage(make_zip(small))
        if kind == 8:
            return make_zip([("a.eml", lang), ("big.eml", text)])
        return make_zip([("mid.zip", make_zip([("low.zip", make_zip(small))]))])

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            raw = [build(r["doc_id"] % 10, r["text"].encode(), r["lang"].encode()) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(raw, pa.binary())], names=["doc_id", "raw"]
            )

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    built = docs.mapInArrow(run, "doc_id bigint, raw binary")
    name = F.array(*[F.lit(n) for n in _NAMES])[(F.col("doc_id") % 10).cast("int")]
    named = built.withColumn("name", F.concat(F.col("doc_id").cast("string"), F.lit("-"), name))
    return unpack(_archives(named, "name"), new_work_dir(spark, "skips"), _LIMITS)


@query(
    "skip_reasons",
    """WITH k AS (SELECT doc_id, doc_id % 10 AS kind, octet_length(encode(text)) AS n,
      doc_id || '-' || ['cut.zip', 'locked.zip', 'empty.zip', 'empty.mbox', 'mail.msg', 'store.pst',
        'noise.png', 'damaged.zip', 'large.zip', 'deep.zip'][CAST(doc_id % 10 AS INTEGER) + 1] AS name
      FROM documents)
    SELECT CASE WHEN kind = 9 THEN name || '!mid.zip!low.zip' ELSE name END AS internal_path,
      CASE WHEN kind IN (0, 7, 8) THEN 'corrupt_archive' WHEN kind = 1 THEN 'password_protected'
        WHEN kind IN (2, 3) THEN 'empty_container' WHEN kind IN (4, 5) THEN 'unsupported_format_deferred'
        WHEN kind = 6 THEN 'not_an_email' ELSE 'depth_limit_exceeded' END AS reason,
      CASE WHEN kind IN (4, 5) THEN 'format not yet implemented: ' || name
        WHEN kind = 8 THEN 'member too large: member ''big.eml'' declares ' || n || ' bytes'
        WHEN kind = 9 THEN 'depth 3 > 2'
        WHEN kind IN (2, 3, 6) THEN '' ELSE 'decoder text' END AS details
    FROM k WHERE kind <> 8 OR n > 2000""",
)
def skip_reasons(spark, sf_dir):
    """Every way a file can be skipped. The decoder's own wording is left out."""
    skips = bad_containers(spark, sf_dir).skips
    own = F.col("reason").isin("corrupt_archive", "password_protected") & ~F.startswith(
        F.col("details"), F.lit("member too large")
    )
    return skips.select(
        "internal_path", "reason", F.when(own, "decoder text").otherwise(F.col("details")).alias("details")
    )


@query(
    "archive_all_or_nothing",
    f"""SELECT doc_id || '-large.zip!' || member AS internal_path,
      sha256(body) AS content_sha256
    FROM (SELECT doc_id, text, 'a.eml' AS member, lang AS body FROM documents
      UNION ALL SELECT doc_id, text, 'big.eml', text FROM documents)
    WHERE doc_id % 10 = 8 AND octet_length(encode(text)) <= 2000""",
)
def archive_all_or_nothing(spark, sf_dir):
    """Leaves out of the same files: an archive with one bad member gives none."""
    return bad_containers(spark, sf_dir).leaves.select("internal_path", "content_sha256")
