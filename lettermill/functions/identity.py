"""Content and location identity as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the canonical form. FRAMING is a byte order mark (its three
# bytes as ISO-8859-1) and one separator line; CLOSING the trailing blanks.
BOM = "\ufeff"
FROM_PREFIX = "From "
FRAMING = r"\A(?:\u00EF\u00BB\u00BF)?(?:From [^\r\n]*\r?\n)?"
CLOSING = r"(?<![\r\n\t ])[\r\n\t ]++\z"
BLANKS = "\r\n\t "

# Trailing blanks are looked for in this many last bytes first.
_TAIL = 32


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lf(text: Column) -> Column:
    return F.replace(
        F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")
    )


def _end(raw: Column) -> Column:
    """Length without trailing blanks. As ISO-8859-1 a character is a byte."""
    size = F.octet_length(raw)
    tail = F.decode(F.substring(raw, F.greatest(size - _TAIL, F.lit(0)) + 1, F.lit(_TAIL)), "ISO-8859-1")
    blanks = F.least(size, F.lit(_TAIL)) - F.length(F.rtrim(tail, F.lit(BLANKS)))
    whole = F.length(F.regexp_replace(F.decode(raw, "ISO-8859-1"), CLOSING, ""))
    return F.when(blanks < _TAIL, size - blanks).otherwise(whole)


def canonicalize(raw: Column | str) -> Column:
    """Canonical bytes of an email.

    Mails without framing in front are cut at their end and, if they hold a CR,
    get LF line ends; both work on the bytes as they are. The few others take
    the same steps as ISO-8859-1 text, which maps every byte to one character
    and back. Either way text in any or no encoding keeps its bytes.
    """
    raw = _col(raw)
    text = raw.cast("string")
    framed = F.startswith(text, F.lit(BOM)) | F.startswith(text, F.lit(FROM_PREFIX))
    unframed = _lf(F.regexp_replace(F.decode(raw, "ISO-8859-1"), FRAMING, ""))
    # A run of trailing blanks is one before and after CR becomes LF.
    part = F.substring(raw, F.lit(1), _end(raw))
    return (
        F.when(framed, F.encode(F.regexp_replace(unframed, CLOSING, ""), "ISO-8859-1"))
        .when(F.contains(text, F.lit("\r")), _lf(part.cast("string")).cast("binary"))
        .otherwise(part)
    )


def content_sha256(raw: Column | str) -> Column:
    return F.sha2(_col(raw), 256)


def _required(value: Column, name: str) -> Column:
    return F.when(value.isNull() | (value == ""), F.raise_error(F.lit(f"{name} must be non-empty"))).otherwise(value)


def email_id(namespace: Column | str, raw: Column | str) -> Column:
    """Tenant-scoped id: sha256(namespace, NUL, canonical bytes)."""
    return email_id_of_canonical(namespace, canonicalize(raw))


def email_id_of_canonical(namespace: Column | str, canonical: Column) -> Column:
    ns = _required(_col(namespace), "namespace")
    return F.sha2(F.concat(ns.cast("binary"), F.lit(b"\x00"), canonical), 256)


def posix_relpath(path: Column | str) -> Column:
    """Backslashes to slashes; empty and `.` segments removed.

    A leading slash is kept (exactly two leading slashes stay two), and a path
    with no segment left is `.`.
    """
    p = F.replace(_col(path), F.lit("\\"), F.lit("/"))
    root = (
        F.when(p.rlike("^//(?!/)"), "//").when(F.startswith(p, F.lit("/")), "/").otherwise("")
    )
    body = F.array_join(F.filter(F.split(p, "/"), lambda s: ~s.isin("", ".")), "/")
    joined = F.concat(root, body)
    return F.when(joined == "", ".").otherwise(joined)


def source_id(namespace: Column | str, partition: Column | str, relpath: Column | str) -> Column:
    """Location id: sha256 over namespace, partition and path, NUL between them."""
    return F.sha2(
        F.concat_ws(
            "\x00",
            _required(_col(namespace), "namespace"),
            _required(_col(partition), "partition"),
            posix_relpath(_required(_col(relpath), "relpath")),
        ),
        256,
    )


def leaf_suffix(fmt: Column | str) -> Column:
    return F.when(_col(fmt) == "html", ".html").otherwise(".eml")


def shard(email: Column | str) -> Column:
    return F.substring(_col(email), 1, 2)


def pool_relpath(email: Column | str, suffix: Column | str = ".eml") -> Column:
    """`<first two hex digits>/<id><suffix>`."""
    email = _col(email)
    suffix = F.lit(suffix) if isinstance(suffix, str) else suffix
    return F.when(
        F.length(email) < 3, F.raise_error(F.lit("email_id is too short to shard"))
    ).otherwise(F.concat(shard(email), F.lit("/"), email, suffix))


def pool_path(email: Column | str, fmt: Column | str) -> Column:
    """Path as the emails table and the manifest store it."""
    return F.concat(F.lit("emails/"), pool_relpath(email, leaf_suffix(fmt)))


def render_utc(ts: Column | str) -> Column:
    """Second-precision ISO text with a Z; the session time zone must be UTC."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")
