"""Web pages, links, brochures and the module inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import html as ht
from gleaner.functions import text as tx
from gleaner.functions.rows import unnest_rows
from gleaner.operators import modules as mo
from gleaner.operators import prompts as pr
from gleaner.operators import web as wb
from gleaner.plans import pages as pg

from . import adapters as ad
from .registry import query
from .scans import EXCLUDED


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


@query("page_title", f"WITH {ad.PAGES_SQL} SELECT page_id, title FROM parsed")
def page_title(spark, sf):
    return ad.table(spark, sf, "pages").select("page_id", ht.page_title(F.col("html")).alias("title"))


@query("page_text", f"WITH {ad.PAGES_SQL} SELECT page_id, text FROM parsed")
def page_text(spark, sf):
    return ad.table(spark, sf, "pages").select("page_id", ht.page_text(F.col("html")).alias("text"))


@query("page_contents", f"WITH {ad.PAGES_SQL} SELECT page_id, contents FROM contents")
def page_contents(spark, sf):
    return wb.with_contents(ad.pages(spark, sf)).select("page_id", "contents")


LINKS_SQL = f"""WITH {ad.PAGES_SQL} SELECT page_id, generate_subscripts(links, 1) - 1 AS pos, unnest(links) AS link FROM parsed"""


@query("page_hrefs", LINKS_SQL)
def page_hrefs(spark, sf):
    return unnest_rows(ad.table(spark, sf, "pages"), ht.page_hrefs(F.col("html")), "pos", "link", "page_id")


@query("page_links", f"WITH {ad.PAGES_SQL} SELECT page_id, array_to_string(links, chr(10)) AS links, len(links) AS n FROM parsed")
def page_links(spark, sf):
    links = F.col("links")
    return ad.pages(spark, sf).select(
        "page_id", F.array_join(links, "\n").alias("links"), F.size(links).cast("bigint").alias("n")
    )


@query(
    "nonempty_links",
    f"""WITH {ad.PAGES_SQL} SELECT page_id, unnest(list_filter(list_transform(links,
    lambda x: CASE WHEN contains(x, 'e') THEN '' ELSE x END), lambda x: x <> '')) AS link FROM parsed""",
)
def nonempty_links(spark, sf):
    """Links holding an ``e`` are blanked first, so that there is something to drop."""
    blanked = F.transform("links", lambda x: F.when(F.contains(x, F.lit("e")), F.lit("")).otherwise(x))
    return unnest_rows(ad.pages(spark, sf), ht.nonempty_links(blanked), "pos", "link", "page_id").drop("pos")


KINDS = {"about page": "th|der", "careers page": "en|le"}
DROP = "ing|ou"


@query(
    "relevant_links",
    f"""WITH {ad.PAGES_SQL}, l AS (SELECT page_id, url AS base, unnest(links) AS link,
      generate_subscripts(links, 1) - 1 AS link_pos FROM parsed)
    SELECT page_id, link_pos, CASE WHEN regexp_matches(link, '(?i)th|der') THEN 'about page' ELSE 'careers page' END AS type,
      regexp_extract(base, '^([a-z]+://[^/?#]+)', 1) || replace(link, ' ', '') AS url
    FROM l WHERE regexp_matches(link, '(?i)th|der|en|le') AND NOT regexp_matches(link, '(?i)ing|ou')""",
)
def relevant_links(spark, sf):
    return wb.relevant_links(ad.pages(spark, sf), KINDS, DROP)


@query(
    "clean_url",
    f"""WITH {ad.PAGES_SQL}, l AS (SELECT page_id, url AS base, unnest(links) AS link FROM parsed)
    SELECT page_id, link, regexp_extract(base, '^([a-z]+://[^/?#]+)', 1) || '/x' || replace(link, '/', '') AS url FROM l""",
)
def clean_url(spark, sf):
    rows = unnest_rows(ad.pages(spark, sf), "links", "pos", "link", "page_id", "url")
    spaced = F.concat(F.lit(" /x "), F.replace("link", F.lit("/"), F.lit(" ")))
    return rows.select("page_id", "link", ht.clean_url(spaced, F.col("url")).alias("url"))


@query(
    "company_name",
    """SELECT page_id, upper(left(n, 1)) || lower(substring(n, 2)) AS company
    FROM (SELECT page_id, split_part(split_part(url, '//', 2), '.', 1) AS n FROM pages)""",
)
def company_name(spark, sf):
    return ad.table(spark, sf, "pages").select("page_id", ht.company_name(F.col("url")).alias("company"))


@query(
    "links_json_scan",
    f"""WITH {ad.PAGES_SQL}, l AS (SELECT page_id, url, unnest(links) AS link,
       generate_subscripts(links, 1) - 1 AS link_pos, len(text) > 2000 AS broken FROM parsed)
    SELECT page_id, link_pos, 'other' AS type, link AS url FROM l WHERE NOT broken
    UNION ALL SELECT page_id, NULL, '_error', url FROM parsed WHERE len(text) > 2000""",
)
def links_json_scan(spark, sf):
    """Replies of long pages are cut short, so they do not parse."""
    link = F.transform("links", lambda x: F.struct(F.lit(None).cast("string").alias("type"), x.alias("url")))
    whole = F.to_json(F.struct(link.alias("links")))
    reply = F.when(F.length("text") > 2000, F.concat(F.lit("{"), whole)).otherwise(whole)
    parsed = ad.pages(spark, sf)
    good, bad = wb.links_json(parsed.select("page_id", reply.alias("reply")))
    errors = bad.join(parsed.select("page_id", "url"), "page_id")
    return good.unionByName(
        errors.select("page_id", F.lit(None).cast("bigint").alias("link_pos"), F.lit("_error").alias("type"), "url")
    )


@query(
    "linked_pages",
    f"""WITH {ad.FOLLOWED_SQL} SELECT l.page_id, l.link_pos, l.type, l.url, c.contents
    FROM links l LEFT JOIN contents c ON c.url = l.url""",
)
def linked_pages(spark, sf):
    parsed = ad.parsed_pages(spark, sf)
    return wb.linked_pages(ad.followed_links(parsed), parsed).select(
        "page_id", "link_pos", "type", "url", "contents"
    )


@query("linked_content", f"WITH {ad.FOLLOWED_SQL} SELECT page_id, CAST(0 AS BIGINT) AS part, content FROM linked")
def linked_content(spark, sf):
    parsed = ad.parsed_pages(spark, sf)
    linked = wb.linked_pages(ad.followed_links(parsed), parsed)
    return wb.linked_content(wb.with_contents(parsed), linked, page_size=1000)


@query(
    "prompt_summary",
    f"""WITH {ad.PAGES_SQL} SELECT page_id, 'You are looking at a website titled ' || title || chr(10) ||
      'The contents of this website is as follows; please provide a short summary of this website in markdown. If it '
      || 'includes news or announcements, then summarize these too.' || chr(10) || ' Respond in Markdown' || chr(10) ||
      chr(10) || contents AS prompt FROM contents""",
)
def prompt_summary(spark, sf):
    return wb.with_contents(ad.pages(spark, sf)).select(
        "page_id", pr.prompt_summary(F.col("title"), F.col("contents")).alias("prompt")
    )


@query(
    "prompt_links",
    f"""WITH {ad.PAGES_SQL} SELECT page_id, 'Here is the list of links on the website of ' || url || '.' || chr(10) ||
      'Please decide which of these are relevant web links for a brochure about the company, respond with the full '
      || 'https URL in JSON format. Do not include Terms of Service, Privacy, email links.' || chr(10) ||
      'Links (some might be relative links):' || chr(10) || array_to_string(links, chr(10)) AS prompt FROM parsed""",
)
def prompt_links(spark, sf):
    return ad.pages(spark, sf).select("page_id", pr.prompt_links(F.col("url"), F.col("links")).alias("prompt"))


BROCHURE_SQL = f"""WITH {ad.FOLLOWED_SQL}, names AS (SELECT page_id, split_part(split_part(url, '//', 2), '.', 1) AS n FROM pages)
  SELECT page_id, left('You are looking at a company called: ' || upper(left(n, 1)) || lower(substring(n, 2)) || chr(10)
    || 'Here are the contents of its landing page and other relevant pages; use this information to build a short '
    || 'brochure of the company in markdown.' || chr(10) || content, {{cap}}) AS prompt
  FROM linked JOIN names USING (page_id)"""


@query("prompt_brochure", BROCHURE_SQL.format(cap=3000))
def prompt_brochure(spark, sf):
    """A tight cap, so that the cut is seen on these pages."""
    parsed = ad.parsed_pages(spark, sf)
    return pg.brochure_prompts(parsed, ad.followed_links(parsed), 3000)


SYSTEM_BROCHURE_SQL = quoted(pr.SYSTEM_BROCHURE)


@query(
    "brochure",
    f"SELECT page_id, {SYSTEM_BROCHURE_SQL} AS system, prompt FROM ({BROCHURE_SQL.format(cap=pr.BROCHURE_CAP)})",
)
def brochure(spark, sf):
    return pg.brochure(ad.table(spark, sf, "pages"), ad.followed_links).select("page_id", "system", "prompt")


@query(
    "message_pair",
    f"""WITH {ad.PAGES_SQL} SELECT page_id, CAST(to_json([{{'role': 'system', 'content': {quoted(pr.SYSTEM_SUMMARY)}}},
      {{'role': 'user', 'content': title}}]) AS VARCHAR) AS messages FROM parsed""",
)
def message_pair(spark, sf):
    pair = pr.message_pair(pr.SYSTEM_SUMMARY, F.col("title"))
    return ad.pages(spark, sf).select("page_id", F.to_json(pair).alias("messages"))


@query(
    "site_summary",
    f"""WITH {ad.PAGES_SQL} SELECT page_id, {quoted(pr.SYSTEM_SUMMARY)} AS system, 'You are looking at a website titled '
      || title || chr(10) || 'The contents of this website is as follows; please provide a short summary of this website '
      || 'in markdown. If it includes news or announcements, then summarize these too.' || chr(10) ||
      ' Respond in Markdown' || chr(10) || chr(10) || contents AS prompt FROM contents""",
)
def site_summary(spark, sf):
    return pg.site_summary(ad.table(spark, sf, "pages")).select("page_id", "system", "prompt")


# Modules

WORD = "[\\p{L}\\p{N}_]+"
MODULE_SQL = f"nullif(regexp_extract(line, '^(?:from|import)\\s+({WORD}(?:\\.{WORD})*)', 1), '')"
SKIPPED_SQL = "(contains(path, 'src1') OR contains(path, 'src7/'))"


@query(
    "import_name",
    f"WITH {ad.LINES_SQL} SELECT path, line, {MODULE_SQL} AS module FROM lines WHERE {MODULE_SQL} IS NOT NULL",
)
def import_name(spark, sf):
    rows = ad.lines(spark, sf).withColumn("module", tx.import_name(F.col("line")))
    return rows.where("module IS NOT NULL").select("path", "line", "module")


@query(
    "distinct_modules",
    f"WITH {ad.LINES_SQL} SELECT DISTINCT {MODULE_SQL} AS module FROM lines WHERE {MODULE_SQL} IS NOT NULL",
)
def distinct_modules(spark, sf):
    return mo.distinct_modules(ad.lines(spark, sf), ())


@query("excluded_paths", f"WITH {ad.LINES_SQL} SELECT DISTINCT path FROM lines WHERE NOT {SKIPPED_SQL}")
def excluded_paths(spark, sf):
    paths = ad.lines(spark, sf).select("path").distinct()
    return paths.where(~mo.excluded(F.col("path"), EXCLUDED))


@query(
    "contains_any",
    "SELECT doc_id, contains(text, 'ning') OR contains(text, 'keit') OR contains(text, 'eau') AS hit FROM documents",
)
def contains_any(spark, sf):
    hit = tx.contains_any(F.col("text"), ["ning", "keit", "eau"])
    return ad.table(spark, sf, "documents").select("doc_id", hit.alias("hit"))


@query(
    "processed_and_skipped",
    f"""WITH {ad.LINES_SQL} SELECT DISTINCT path, CASE WHEN {SKIPPED_SQL} THEN 'skipped' ELSE 'processed' END AS status
    FROM lines""",
)
def processed_and_skipped(spark, sf):
    return mo.processed_and_skipped(ad.lines(spark, sf).select("path").distinct(), EXCLUDED)


@query(
    "module_inventory",
    f"""WITH {ad.LINES_SQL}
    SELECT DISTINCT 'module' AS kind, {MODULE_SQL} AS name FROM lines WHERE {MODULE_SQL} IS NOT NULL AND NOT {SKIPPED_SQL}
    UNION ALL SELECT DISTINCT CASE WHEN {SKIPPED_SQL} THEN 'skipped' ELSE 'processed' END, path FROM lines""",
)
def module_inventory(spark, sf):
    return pg.module_inventory(ad.lines(spark, sf), EXCLUDED)
