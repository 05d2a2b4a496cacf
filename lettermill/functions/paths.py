"""Names, suffix classification, lineage paths and scan order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed: suffix -> kind, first match wins, compared without case.
SUFFIX_KINDS = (
    (".eml", "eml"),
    (".html", "html"),
    (".htm", "html"),
    (".mbox", "mbox"),
    (".zip", "zip"),
    (".msg", "unsupported"),
    (".pst", "unsupported"),
)
NOISE = "noise"

PARTITION_PATTERN = r"^timestamp=\d{4}-\d{2}-\d{2}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basename_of(internal_path: Column | str, cut_hash: bool = True) -> Column:
    """Last segment of a lineage path.

    By default everything from the first `#` on is cut, so a file name that
    holds a `#` loses its suffix. `cut_hash=False` keeps such names whole.
    """
    p = _col(internal_path)
    if cut_hash:
        p = F.substring_index(p, "#", 1)
    return F.substring_index(F.substring_index(p, "!", -1), "/", -1)


def has_suffix(name: Column | str, *suffixes: str) -> Column:
    lowered = F.lower(_col(name))
    test = F.endswith(lowered, F.lit(suffixes[0]))
    for s in suffixes[1:]:
        test = test | F.endswith(lowered, F.lit(s))
    return test


def is_kind(name: Column | str, kind: str) -> Column:
    return has_suffix(name, *[s for s, k in SUFFIX_KINDS if k == kind])


def is_eml(name: Column | str) -> Column:
    return is_kind(name, "eml")


def is_html(name: Column | str) -> Column:
    return is_kind(name, "html")


def is_mbox(name: Column | str) -> Column:
    return is_kind(name, "mbox")


def is_zip(name: Column | str) -> Column:
    return is_kind(name, "zip")


def is_unsupported(name: Column | str) -> Column:
    return is_kind(name, "unsupported")


def classify_item(internal_path: Column | str, cut_hash: bool = True) -> Column:
    """eml, html, mbox, zip, unsupported or noise."""
    lowered = F.lower(basename_of(internal_path, cut_hash))
    kind = F.lit(NOISE)
    for suffix, name in reversed(SUFFIX_KINDS):
        kind = F.when(F.endswith(lowered, F.lit(suffix)), name).otherwise(kind)
    return kind


def is_unsafe_member(name: Column | str) -> Column:
    """Absolute member names and names with a `..` segment."""
    slashed = F.replace(_col(name), F.lit("\\"), F.lit("/"))
    return F.startswith(slashed, F.lit("/")) | F.array_contains(F.split(slashed, "/"), "..")


def zip_hop(container: Column | str, member: Column | str) -> Column:
    return F.concat(_col(container), F.lit("!"), _col(member))


def mbox_hop(container: Column | str, index: Column | str) -> Column:
    return F.concat(_col(container), F.lit("#"), _col(index).cast("string"))


def hops(internal_path: Column | str) -> Column:
    """Container chain of a lineage path, bucket file first."""
    return F.split(_col(internal_path), "[!#]")


def is_partition_dir(name: Column | str) -> Column:
    return _col(name).rlike(PARTITION_PATTERN)


def partition_date(partition: Column | str) -> Column:
    """Date of a partition name, NULL where the digits are no date."""
    return F.try_to_date(F.substring(_col(partition), 11, 10), "yyyy-MM-dd")


def scan_order_key(relpath: Column | str) -> Column:
    """Sort key of a file in its partition: the files of a directory come
    before its sub-directories, each by name."""
    parts = F.split(_col(relpath), "/")
    return F.transform(
        parts,
        lambda part, i: F.struct((i < F.size(parts) - 1).alias("is_dir"), part.alias("name")),
    )
