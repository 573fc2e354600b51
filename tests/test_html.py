from pyspark.sql import functions as F

from gleaner.functions import html as ht
from gleaner.operators import web as wb


def one(spark, html, fn):
    return spark.createDataFrame([(html,)], "h STRING").select(fn(F.col("h")).alias("v")).first().v


def test_title(spark):
    assert one(spark, "<html><title>A &amp; B</title></html>", ht.page_title) == "A & B"
    assert one(spark, "<html></html>", ht.page_title) == "No title found"
    assert one(spark, "<title></title>", ht.page_title) == "No title found"


def test_text(spark):
    page = "<body>a<b> b </b><script>x<1</script>c<!-- <p>no</p> -->d<style>p{}</style><img src='q'>e\n \n f</body>tail"
    assert one(spark, page, ht.page_text) == "abcde\nf"
    assert one(spark, "<p>no body</p>", ht.page_text) == ""
    assert one(spark, "<body>open <p>end", ht.page_text) == "openend"
    assert one(spark, "<body>1 < 2 &amp &quot;q&quot;</body>", ht.page_text) == '1 < 2 & "q"'


def test_entities(spark):
    text = "&#39;&#x27;&lt;b&gt;&amp;lt;&#233;&#128512;&#99999999;&#;"
    assert one(spark, text, ht.decode_entities) == "''<b>&lt;é😀&#99999999;&#;"
    assert one(spark, "x&nbsp;y&copy;&middot;", ht.decode_entities) == "x\xa0y©·"


def test_hrefs(spark):
    page = (
        "<a href=\"/a?x=1&amp;y=2\">1</a><a class='c' href='/b'>2</a><a href=/c>3</a><a name=n>4</a><a href=\"\">5</a>"
        "<abbr href='/no'>x</abbr><a data-href='/no'>6</a><!-- <a href='/hid'>7</a> --><A\nHREF=\"/d\">8</A>"
    )
    assert one(spark, page, ht.page_hrefs) == ["/a?x=1&y=2", "/b", "/c", "/d"]


def test_urls(spark):
    base = "https://www.acme.example.com/en/1?x"
    links = ["/ab out", "http://x.org/q", "//cdn.x/y", "jobs", "mailto:a@b.c"]
    df = spark.createDataFrame([(x,) for x in links], "u STRING")
    got = [r.v for r in df.select(ht.clean_url(F.col("u"), F.lit(base)).alias("v")).collect()]
    assert got == [
        "https://www.acme.example.com/about", "http://x.org/q", "https://cdn.x/y",
        "https://www.acme.example.com/en/jobs", "mailto:a@b.c",
    ]
    assert one(spark, "https://aCME-x.example.com", ht.company_name) == "Acme-x"


def test_relative_urls(spark):
    cases = [
        ("c.html", "https://h/a/b.html", "https://h/a/c.html"), ("../x", "https://h/a/b/c", "https://h/a/x"),
        ("../../../x", "https://h/a/b", "https://h/x"), ("./x/./y/..", "https://h/a/b", "https://h/a/x/"),
        ("?q=/../1", "https://h/a/b?p#f", "https://h/a/b?q=/../1"), ("#top", "https://h/a?p#f", "https://h/a?p"),
        ("/x#top", "https://h/a", "https://h/x"), ("x", "https://h", "https://h/x"), ("/a/../b?u=/..", "https://h", "https://h/b?u=/.."),
        (None, "https://h", None), ("x", None, None),
    ]
    df = spark.createDataFrame([(i, u, b) for i, (u, b, _) in enumerate(cases)], "i INT, u STRING, b STRING")
    got = df.select("i", ht.clean_url(F.col("u"), F.col("b")).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == [want for _, _, want in cases]


def test_relevant_links_and_json(spark):
    pages = spark.createDataFrame(
        [(1, "https://x.org/", ["/about", "/jobs", "/terms-about", "mailto:jobs@x.org", "/news", "/Careers"])],
        "page_id BIGINT, url STRING, links ARRAY<STRING>",
    )
    got = [(r.link_pos, r.type, r.url) for r in wb.relevant_links(pages).orderBy("link_pos").collect()]
    assert got == [
        (0, "about page", "https://x.org/about"), (1, "careers page", "https://x.org/jobs"),
        (5, "careers page", "https://x.org/Careers"),
    ]
    replies = spark.createDataFrame(
        [(1, '{"links":[{"type":"about page","url":"u1"},{"url":"u2"}]}'), (2, '{"links": broken'), (3, '{"links":[]}')],
        "page_id BIGINT, reply STRING",
    )
    good, bad = wb.links_json(replies)
    assert sorted(tuple(r) for r in good.collect()) == [(1, 0, "about page", "u1"), (1, 1, "other", "u2")]
    assert [r.page_id for r in bad.collect()] == [2]


def parsed(spark):
    return spark.createDataFrame(
        [(1, "https://a/", "A", "ta", []), (2, "https://b/", "B", "tb", []), (3, "https://b/", "copy", "tc", [])],
        "page_id BIGINT, url STRING, title STRING, text STRING, links ARRAY<STRING>",
    )


def test_linked_content_keeps_headings_and_one_page_per_url(spark):
    links = spark.createDataFrame(
        [(1, 0, "about page", "https://b/"), (1, 1, "jobs", "https://none/")],
        "page_id BIGINT, link_pos BIGINT, type STRING, url STRING",
    )
    pages = wb.with_contents(parsed(spark))
    linked = wb.linked_pages(links, parsed(spark))
    whole = wb.linked_content(pages, linked).where("page_id = 1").first().content
    b = "Webpage Title:\nB\nWebpage Contents:\ntb\n\n"
    assert whole == (
        "Content for Landing Page URL: https://a/ is: Webpage Title:\nA\nWebpage Contents:\nta\n\n\n"
        "\nContent from embedded links:\n"
        f"\nabout page\nLink https://b/ is of type: 'about page', and its content is as follows: {b} \n"
        "\njobs\n"
    )
    parts = wb.linked_content(pages, linked, page_size=1).where("page_id = 1").orderBy("part").collect()
    assert "".join(r.content for r in parts) == whole and len(parts) == 3
    for cap in (10, 90, 150, len(whole) - 1, len(whole), len(whole) + 5):
        head = wb.linked_content_head(pages, linked, cap).where("page_id = 1").first().content
        assert head == whole[:cap]
