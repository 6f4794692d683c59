"""Plan shape: no Python evaluation on data paths, map-side limits before the
dedup shuffles, filters at the scan."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_headline_plans(spark):
    q = E.queries()
    for name in ["unified_companies", "raw_dim_companies", "describe_numeric", "kde_grid", "corr_matrix",
                 "validate_marts", "apply_edits", "parse_json_responses", "enrich_missing", "export_statistics"]:
        plan = executed(q[name](spark, SF))
        assert not any(n in plan for n in PY_NODES), name


def test_dedup_limits_rows_before_the_shuffle(spark):
    q = E.queries()
    for name in ["raw_fct_company_metrics", "bronze_dim_founder", "dedup_dim_primary"]:
        plan = executed(q[name](spark, SF))
        # a partial WindowGroupLimit sits under the hash exchange of the dedup window
        assert re.search(r"Exchange hashpartitioning[^\n]*\n(?:[^\n]*\n){0,3}?[^\n]*WindowGroupLimit", plan), plan


def test_dimension_reads_each_source_once(spark):
    plan = executed(E.queries()["raw_dim_companies"](spark, SF))
    final = plan.split("== Initial Plan ==")[0]
    # two scans, each reduced by a partial aggregate before its one exchange, and one full join
    assert len(re.findall(r"FileScan parquet", final)) == 2, final
    assert len(re.findall(r"Exchange hashpartitioning", final)) == 2, final
    assert len(re.findall(r"partial_min_by", final)) >= 2 and "FullOuter" in final, final


def test_search_filters_reach_the_scan(spark):
    df = E.queries()["search_companies"](spark, SF)
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(employee_count,1000)" in text and "LessThanOrEqual(revenue,5.0E9)" in text


def test_quality_report_reads_a_table_once_for_row_checks_and_once_per_key(spark):
    plan = executed(E.queries()["quality_report"](spark, SF)).split("== Initial Plan ==")[0]
    # 6 tables with row checks and 9 keys
    assert len(re.findall("FileScan parquet", plan)) <= 15, plan


def test_profiling_does_not_shuffle_the_long_form(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ["iqr_outliers", "box_stats", "histogram50", "kde_grid", "corr_matrix"]:
            plan = executed(E.queries()[name](spark, SF))
            # what a join needs by column name alone, or by row number, would be the long form itself
            assert "SortMergeJoin [column_name#" not in plan or "BroadcastHashJoin" in plan, name
            assert not re.search(r"hashpartitioning\(_rn", plan), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
