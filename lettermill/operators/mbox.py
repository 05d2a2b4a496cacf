"""MBOX containers: messages between separator lines, split natively."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed: a separator is a whole line that starts with "From "; only LF ends a
# line. The one blank line before the next separator (or at the end) is framing.
# With an LF put before the text, every separator follows one.
SEPARATOR = "\nFrom [^\n]*"

# More messages than a row can hold; start + length must stay an int.
_ALL = 1 << 30


def message_parts(raw: Column) -> Column:
    """array<string> of what lies between separators, as ISO-8859-1 text; the
    text before the first one is lost."""
    text = F.concat(F.lit("\n"), F.decode(raw, "ISO-8859-1"))
    return F.slice(F.split(text, SEPARATOR), 2, _ALL)


def message_bytes(part: Column, is_last: Column) -> Column:
    """Raw bytes of one message from its part.

    A part starts with the LF that ends its separator line. The LF before the
    next separator was taken by the split: it is framing if it was a blank line
    of its own, else it ends the message. The last part ends where the file does.
    """
    # Line break and separator follow each other: no message text at all.
    body = F.substring(part, F.lit(2), F.length(part))
    framing = F.endswith(part, F.lit("\n"))
    whole = F.when(framing, body).otherwise(F.concat(body, F.lit("\n")))
    # For the last part `part` still holds the separator's LF in front.
    blank = F.endswith(part, F.lit("\n\n"))
    last = F.when(blank, F.substring(part, F.lit(2), F.length(part) - 2)).otherwise(body)
    text = F.when(part == "", "").when(is_last, last).otherwise(whole)
    return F.encode(text, "ISO-8859-1")


def split_messages(raw: Column | str) -> Column:
    """array<binary> of raw messages."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    parts = message_parts(raw)
    count = F.size(parts)
    return F.transform(parts, lambda part, i: message_bytes(part, i == count - 1))


def explode_mbox(containers: DataFrame, raw: str = "raw") -> DataFrame:
    """One row per message with `msg_idx` and the message in `raw`; a container
    without messages gives one row with NULL in both."""
    others = [c for c in containers.columns if c != raw]
    parts = containers.select(*others, message_parts(F.col(raw)).alias("parts"))
    rows = parts.select(
        *others, F.size("parts").alias("n"), F.posexplode_outer("parts").alias("msg_idx", raw)
    )
    body = message_bytes(F.col(raw), F.col("msg_idx") == F.col("n") - 1)
    return rows.withColumn(raw, body).drop("n")


def _written_back(body: bytes) -> bytes:
    import email

    return email.message_from_bytes(body).as_bytes()


def rewrite_bodies(mailboxes: DataFrame, bodies: str, only: str) -> DataFrame:
    """Messages as the Python email package writes them back.

    Long headers are folded and line ends become LF, so the bytes (and with
    them the ids) can differ from the file's. `bodies` is an array of messages
    per row; rows where `only` is false stay as they are. The first message that
    cannot be written back ends its mailbox: a NULL takes its place, the ones
    after it are dropped, and `rewrite_error` tells why.
    """
    at, gate = mailboxes.columns.index(bodies), mailboxes.columns.index(only)

    def rewrite(messages: list[bytes]) -> tuple[list, str | None]:
        done: list = []
        for message in messages:
            try:
                done.append(_written_back(message))
            except Exception as failure:  # the parser raises many kinds
                return [*done, None], f"mbox: {failure}"
        return done, None

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, errors = [], []
            for i in range(batch.num_rows):
                messages, error = batch.column(at)[i].as_py(), None
                if batch.column(gate)[i].as_py() and messages is not None:
                    messages, error = rewrite(messages)
                out.append(messages)
                errors.append(error)
            arrays = list(batch.columns)
            arrays[at] = pa.array(out, pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(errors, pa.string())],
                names=[*batch.schema.names, "rewrite_error"],
            )

    schema = T.StructType(
        [*mailboxes.schema.fields, T.StructField("rewrite_error", T.StringType())]
    )
    return mailboxes.mapInArrow(run, schema)


def rewrite_rows(messages: DataFrame) -> DataFrame:
    """The same for messages that are rows already (source_id, msg_idx, raw).

    Adds `rewrite_error`; of each source only the rows up to its first error
    stay. The list of first errors is tiny next to the messages.
    """
    one = messages.select(
        *[c for c in messages.columns if c != "raw"],
        F.array("raw").alias("bodies"),
        F.col("raw").isNotNull().alias("present"),
    )
    done = rewrite_bodies(one, "bodies", "present").select(
        *[c for c in messages.columns if c != "raw"],
        F.col("bodies")[0].alias("raw"),
        "rewrite_error",
    )
    stops = (
        done.filter(F.col("rewrite_error").isNotNull())
        .groupBy("source_id")
        .agg(F.min("msg_idx").alias("stop"))
    )
    return (
        done.join(stops, "source_id", "left")
        .filter(F.col("stop").isNull() | (F.col("msg_idx") <= F.col("stop")))
        .drop("stop")
    )
