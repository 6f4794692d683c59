import __spark_entry__ as E

from firmo import catalog


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["company_id", "company_name"]


def test_every_query_of_the_catalog_has_sql(spark):
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_some_queries_against_duckdb(spark):
    from oracle_harness import compare, duck
    con = duck("/root/testdata/sf0.001")
    q, s = E.queries(), E.oracle_sql()
    for name in ["unified_companies", "raw_dim_companies", "export_statistics", "describe_numeric",
                 "apply_edits", "validate_marts"]:
        r = compare(q[name](spark, "/root/testdata/sf0.001"), con, s[name])
        assert r["cols_ok"] and r["hash_ok"], (name, r)
