"""Column helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bytes that separate words.
BLANKS = " \t\n\x0b\x0c\r"


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, other letters left alone. Text of ASCII only takes the fast way."""
    slow = F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(slow)


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def digest16(c: Column) -> Column:
    """16 bytes that stand for a string: equal by chance for no two strings of any corpus."""
    return F.unhex(F.md5(c.cast("binary")))


def packed(docs: DataFrame, name: str = "row") -> Column:
    """All columns of a table in one struct, so that added columns can't clash with them."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(name)


def unpacked(frame: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of `docs` out of the struct again, some of them replaced."""
    return frame.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def text_batches(spark: SparkSession) -> None:
    """Hand texts to Python a few MB at a time, unless the session says otherwise: a worker holds a batch in
    several forms at once, and several workers share an executor."""
    for name, value in {
        "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
