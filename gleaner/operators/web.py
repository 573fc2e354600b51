"""Pages, their relevant links and the contents behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.html import clean_url, page_contents, page_hrefs, page_text, page_title
from ..functions.rows import unnest_rows
from ..functions.text import present
from ..session import materialise
from .ordinals import PAGE_BYTES, THIN_KEYS, join_hot, key_counts, paged_text

# Words that mark a link as worth following or not, and its kind.
LINK_KINDS = {
    "about page": "about",
    "careers page": "career|jobs?\\b",
    "company page": "company|team|contact",
}
LINK_DROP = "terms|privacy|mailto:"


def parse_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, title, text, links`` from ``page_id, url, html``."""
    html = F.col("html")
    return pages.select(
        "page_id", "url", page_title(html).alias("title"), page_text(html).alias("text"), page_hrefs(html).alias("links")
    )


def parse_once(pages: DataFrame) -> DataFrame:
    """Parsed pages as a written table, for jobs that use titles, texts and links several times."""
    return materialise(parse_pages(pages), "parsed-pages")


def with_contents(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("contents", page_contents(F.col("title"), F.col("text")))


def link_kind(link: Column, kinds: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for kind, words in reversed(list(kinds.items())):
        out = F.when(link.rlike(f"(?i){words}"), F.lit(kind)).otherwise(out)
    return out


def relevant_links(
    parsed: DataFrame, kinds: dict[str, str] = LINK_KINDS, drop: str = LINK_DROP
) -> DataFrame:
    """One row per link to follow: ``page_id, link_pos, type, url``; rules are parameters."""
    rows = unnest_rows(parsed, "links", "link_pos", "link", "page_id", F.col("url").alias("base"))
    kind = link_kind(F.col("link"), kinds)
    kept = rows.where(kind.isNotNull() & ~F.col("link").rlike(f"(?i){drop}"))
    return kept.select(
        "page_id", "link_pos", kind.alias("type"),
        clean_url(F.col("link"), F.col("base")).alias("url"),
    )


def links_json(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Link rows from JSON replies ``page_id, reply``, and the replies that do not parse.

    A link without a type becomes ``other``.
    """
    schema = "links ARRAY<STRUCT<type: STRING, url: STRING>>"
    parsed = replies.withColumn("links", F.from_json("reply", schema)["links"])
    rows = unnest_rows(parsed, "links", "link_pos", "link", "page_id")
    good = rows.select(
        "page_id", "link_pos",
        F.coalesce(present(F.col("link.type")), F.lit("other")).alias("type"), F.col("link.url").alias("url"),
    )
    return good, parsed.where("links IS NULL").select("page_id", "reply")


def one_page_per_url(parsed: DataFrame) -> DataFrame:
    """Copies of a URL count once, so that a link never multiplies."""
    first = F.min_by(F.struct("title", "text"), F.col("page_id")).alias("page")
    return parsed.groupBy("url").agg(first).select("url", "page.title", "page.text")


def linked_pages(links: DataFrame, parsed: DataFrame) -> DataFrame:
    """Each link with the contents of its page; an unknown page leaves NULL, the link stays.

    A URL that a large share of all links points to is spread over tasks; the thin
    link table is written once, as it is counted and then joined. While the wanted
    URLs are few, other pages are left out before anything is shuffled.
    """
    links = materialise(links, "links")
    wanted = key_counts(links, ["url"])
    if wanted.count() <= THIN_KEYS:
        parsed = parsed.join(F.broadcast(wanted.select("url")), "url", "left_semi")
    target = with_contents(one_page_per_url(parsed)).select("url", "contents")
    return join_hot(links, target, ["url"], ["page_id", "link_pos"], counts=wanted)


def link_section(type_: Column, url: Column, contents: Column) -> Column:
    """Heading of a link and, when its page is known, the contents."""
    heading = F.concat(F.lit("\n"), type_, F.lit("\n"))
    body = F.concat(
        F.lit("Link "), url, F.lit(" is of type: '"), type_, F.lit("', and its content is as follows: "),
        contents, F.lit(" \n"),
    )
    return F.concat(heading, F.coalesce(body, F.lit("")))


def landing_section(url: Column, contents: Column) -> Column:
    return F.concat(
        F.lit("Content for Landing Page URL: "), url, F.lit(" is: "), contents, F.lit("\n\nContent from embedded links:\n")
    )


def _sections(pages: DataFrame, linked: DataFrame) -> DataFrame:
    """``page_id, section_pos, section``: the landing page first, then the links in order."""
    landing = pages.select(
        "page_id", F.lit(-1).cast("bigint").alias("section_pos"),
        landing_section(F.col("url"), F.col("contents")).alias("section"),
    )
    links = linked.select(
        "page_id", F.col("link_pos").alias("section_pos"),
        link_section(F.col("type"), F.col("url"), F.col("contents")).alias("section"),
    )
    return landing.unionByName(links)


def linked_content(pages: DataFrame, linked: DataFrame, page_size: int = 200, page_bytes: int = PAGE_BYTES) -> DataFrame:
    """Landing page and link contents as text, in parts of at most ``page_size`` sections and ``page_bytes`` bytes.

    ``part`` 0 holds everything for a page within both; the whole text of a page is the concatenation of its
    parts, in their order. Only a single section above the bound makes a part above it.
    """
    parts = paged_text(
        _sections(pages, linked), ["page_id"], ["section_pos"], F.col("section"), "content", "", page_size, page_bytes=page_bytes
    )
    return parts.withColumnRenamed("page", "part")


def linked_content_head(pages: DataFrame, linked: DataFrame, cap: int) -> DataFrame:
    """The first ``cap`` characters of :func:`linked_content`, without building the rest.

    Sections that start behind the cap cannot be seen in the cut text, so they are
    left out before grouping; a group then stays within a few times the cap.
    """
    order = Window.partitionBy("page_id").orderBy("section_pos").rowsBetween(Window.unboundedPreceding, -1)
    sized = _sections(pages, linked).withColumn("section", F.left("section", F.lit(cap)))
    starts = sized.withColumn("start", F.coalesce(F.sum(F.length("section")).over(order), F.lit(0)))
    entry = F.struct("section_pos", "section")
    return (
        starts.where(F.col("start") < cap)
        .groupBy("page_id")
        .agg(F.sort_array(F.collect_list(entry)).alias("s"))
        .select("page_id", F.left(F.array_join(F.transform("s", lambda e: e["section"]), ""), F.lit(cap)).alias("content"))
    )
