"""HTML to title, text and links with built-in string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, present, strip_text

# Named entities decoded besides the ampersand, which comes last.
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ",
    "&copy;": "©", "&reg;": "®", "&trade;": "™", "&middot;": "·",
    "&bull;": "•", "&hellip;": "…", "&ndash;": "–", "&mdash;": "—",
    "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”",
    "&laquo;": "«", "&raquo;": "»", "&euro;": "€", "&pound;": "£",
}

_HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
_BODY = r"(?is)<body\b[^>]*>(.*?)(?:</body\s*>|\z)"
_TAG = r"<[a-zA-Z/!?][^>]*>"


def _character(code: Column) -> Column:
    """The character of a code point, NULL when there is none."""
    valid = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def _numeric(text: Column) -> Column:
    """Decode ``&#39;`` and ``&#x27;`` forms."""

    def decoded(piece: Column, i: Column) -> Column:
        digits = F.regexp_extract(piece, r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?", 1)
        code = F.when(
            F.lower(F.left(digits, F.lit(1))) == "x", F.conv(F.substring(digits, 2, 6), 16, 10)
        ).otherwise(digits)
        char = _character(F.when(digits != "", code).try_cast("bigint"))
        rest = F.regexp_replace(piece, r"^(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?", "")
        return F.when(i == 0, piece).otherwise(
            F.coalesce(F.concat(char, rest), F.concat(F.lit("&#"), piece))
        )

    return F.when(
        F.contains(text, F.lit("&#")), F.array_join(F.transform(F.split(text, "&#"), decoded), "")
    ).otherwise(text)


def decode_entities(text: Column) -> Column:
    out = _numeric(text)
    for name, char in ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(char))
    return F.regexp_replace(out, "&amp;?", "&")


def page_title(html: Column) -> Column:
    title = F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    return F.coalesce(present(decode_entities(title)), F.lit("No title found"))


def page_text(html: Column) -> Column:
    """Visible body text: stripped fragments joined without separator, blank lines dropped."""
    body = F.regexp_extract(html, _BODY, 1)
    pieces = F.split(F.regexp_replace(body, _HIDDEN, "<x>"), _TAG)
    kept = F.filter(F.transform(pieces, lambda p: strip_text(decode_entities(p))), lambda p: p != "")
    lines = F.transform(F.split(F.array_join(kept, ""), "\n"), strip_text)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def page_hrefs(html: Column) -> Column:
    """href of every anchor in document order; anchors without one are left out."""
    anchors = F.regexp_extract_all(F.regexp_replace(html, _HIDDEN, ""), F.lit(r"(?is)<a\s[^>]*>"), F.lit(0))

    def href(tag: Column) -> Column:
        quoted = [r'(?is)\shref\s*=\s*"([^"]*)"', r"(?is)\shref\s*=\s*'([^']*)'", r"""(?is)\shref\s*=\s*([^\s"'>]+)"""]
        return decode_entities(F.coalesce(*[present(F.regexp_extract(tag, q, 1)) for q in quoted]))

    return nonempty_links(F.transform(anchors, href))


def nonempty_links(links: Column) -> Column:
    return F.filter(links, lambda x: x.isNotNull() & (x != ""))


def page_contents(title: Column, text: Column) -> Column:
    return F.concat(
        F.lit("Webpage Title:\n"), title, F.lit("\nWebpage Contents:\n"), text, F.lit("\n\n")
    )


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` segments of an absolute path taken out."""
    segments = F.split(F.regexp_replace(path, r"(/\.{1,2})$", "$1/"), "/")
    nothing = F.array().cast("array<string>")
    walked = F.aggregate(
        segments,
        nothing,
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    return F.when(F.contains(path, F.lit("/.")), F.array_join(walked, "/")).otherwise(path)


def clean_url(url: Column, base: Column) -> Column:
    """Spaces and fragments removed; a relative link is completed from the folder of the page's own URL."""
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    below = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(/(?:[^?#]*/)?)", 1)
    folder = F.when(below == "", F.lit("/")).otherwise(below)

    def complete(u: Column) -> Column:
        path, query = F.regexp_extract(u, r"^([^?]*)", 1), F.regexp_extract(u, r"(\?[\s\S]*)$", 1)
        return (
            F.when(u.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), u)
            .when(u == "", F.regexp_extract(base, r"^([^#]*)", 1))
            .when(F.startswith(u, F.lit("?")), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), u))
            .when(F.startswith(u, F.lit("//")), F.concat(scheme, u))
            .when(F.startswith(u, F.lit("/")), F.concat(origin, _without_dots(path), query))
            .otherwise(F.concat(origin, _without_dots(F.concat(folder, path)), query))
        )

    return let(F.regexp_extract(F.replace(url, F.lit(" "), F.lit("")), r"^([^#]*)", 1), complete)


def company_name(url: Column) -> Column:
    name = F.split_part(F.split_part(url, F.lit("//"), F.lit(2)), F.lit("."), F.lit(1))
    return F.concat(F.upper(F.left(name, F.lit(1))), F.lower(F.substring(name, 2, 2147483647)))
