"""What the physical plans must look like."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_html_runs_without_python(spark):
    for name in ("page_text", "page_title", "page_hrefs", "site_summary", "prompt_links"):
        assert "Python" not in plan(spark, name) and "ArrowEval" not in plan(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "corpus_scan")
    assert "EqualTo(lang,en)" in p
    assert "ReadSchema: struct<doc_id:bigint" in plan(spark, "ingest_hard_cap")
    assert "html" not in plan(spark, "company_name")


def test_no_cross_joins(spark):
    for name in ("rag_base", "topk_cosine", "linked_content", "attachable_files", "file_intake", "provider_route"):
        p = plan(spark, name)
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_limit_comes_before_unnesting(spark):
    from gleaner.operators.passages import passages_base
    from gleaner.sources.corpus import ingest_limit
    from suite.adapters import samples

    p = passages_base(ingest_limit(samples(spark, SF), 10, ["id"]))._jdf.queryExecution().executedPlan().toString()
    # a plan names what comes last first
    assert p.index("Generate") < p.rindex("Filter (") and "TakeOrderedAndProject" not in p and "Sort" not in p
