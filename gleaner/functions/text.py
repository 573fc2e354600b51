"""Text functions: Column -> Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed by a Unicode-aware strip.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    A sub-expression captured by a lambda is evaluated for every element; binding
    it as a lambda variable avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def present(c: Column) -> Column:
    """The empty string counts as missing."""
    return F.nullif(c, F.lit(""))


def first_present(*cols: Column) -> Column:
    return F.coalesce(*[present(c) for c in cols])


def strip_text(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def truncate(c: Column, cap: int | None, marker: str = "") -> Column:
    """First ``cap`` characters plus ``marker`` when the text is longer; no cap keeps all."""
    if cap is None:
        return c
    return F.when(F.length(c) > cap, F.concat(F.left(c, F.lit(cap)), F.lit(marker))).otherwise(c)


def truncate_ellipsis(c: Column, cap: int | None) -> Column:
    return truncate(c, cap, "...")


def truncate_marker(c: Column, cap: int | None) -> Column:
    return truncate(c, cap, "\n[Context truncated]")


def truncate_hard(c: Column, cap: int | None) -> Column:
    return truncate(c, cap, "")


def fixed_3(x: Column) -> Column:
    """Three decimals, rounded on the exact binary value (ties to even).

    ``format_string`` rounds the shortest decimal form half up, which differs at
    ties. The value is split into a 24-bit part and its exact remainder, so both
    products with 1000 are exact and the sign of their sum tells the side.
    """

    def rounded(p: Column) -> Column:
        high = p.cast("float").cast("double")
        whole = F.floor(p * 1000.0).cast("double")
        side = (high * 1000.0 - whole - 0.5) + (p - high) * 1000.0
        up = (side > 0) | ((side == 0) & (whole % 2.0 == 1.0))
        return F.format_string("%.3f", (whole + F.when(up, 1.0).otherwise(0.0)) / 1000.0)

    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, let(F.abs(x), rounded))


def line_count(c: Column) -> Column:
    return (F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1).cast("bigint")


def page_join(parts: Column) -> Column:
    return F.array_join(parts, "\n--- Page Break ---\n")


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """True when any word occurs in the text; false for an empty list."""
    return F.exists(F.array(*[F.lit(w) for w in words]).cast("array<string>"), lambda w: F.contains(c, w))


def to_base64(content: Column) -> Column:
    """Base64 on one line, whatever the session says about line breaks."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def encoding_rule(enc: Column) -> Column:
    return F.when(F.contains(enc, F.lit("ascii")), F.lit("utf-8")).otherwise(enc)


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def size_mb(n_bytes: Column) -> Column:
    """Mebibytes to two decimals, ties to even; integer arithmetic, so exact."""
    unit = 1048576
    hundredths = n_bytes.cast("bigint") * 100
    whole = F.floor(hundredths / F.lit(unit)).cast("bigint")
    rest = hundredths - whole * unit
    up = (rest * 2 > unit) | ((rest * 2 == unit) & (whole % 2 == 1))
    return (whole + F.when(up, 1).otherwise(0)) / F.lit(100.0)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_extension(path: Column) -> Column:
    """Lower-case suffix of the last path part; a leading dot alone is no suffix."""
    return F.lower(F.regexp_extract(base_name(path), r"^.+(\.[^.]+)$", 1))


def import_name(line: Column) -> Column:
    """Module named by an unindented import line, else NULL."""
    word = r"[\p{L}\p{N}_]+"
    return present(F.regexp_extract(line, rf"^(?:from|import)\s+({word}(?:\.{word})*)", 1))


def response_text(plain: Column, blocks: Column) -> Column:
    """Reply text: the plain string, or the text blocks joined by newline."""
    texts = F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: b["text"])
    return first_present(plain, F.array_join(texts, "\n"))
