"""Data-quality checks (O-DQ-*).

Two styles: dbt-style checks return the violating rows (empty = pass);
expectation-style checks return one result row per expectation:
``check, column, evaluated, unexpected, ratio, mostly, success``.  All
column expectations of a suite fold into a single ``agg`` pass; each
uniqueness check adds one grouped pass.  Denominators follow the public
Great Expectations rules: nulls are skipped except by the not-null check.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from firmo.functions.numeric import coerce_numeric

RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType()), T.StructField("column", T.StringType()),
    T.StructField("evaluated", T.LongType()), T.StructField("unexpected", T.LongType()),
    T.StructField("ratio", T.DoubleType()), T.StructField("mostly", T.DoubleType()),
    T.StructField("success", T.BooleanType()),
])


# ------------------------------------------------------------------ dbt-style violations
def dq_not_null(df: DataFrame, col: str) -> DataFrame:
    """O-DQ-01: rows where ``col`` is null."""
    return df.filter(F.col(col).isNull())


def dq_unique(df: DataFrame, col: str) -> DataFrame:
    """O-DQ-02: values of ``col`` that occur more than once, with their count."""
    return dq_unique_combination(df, [col])


def dq_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """O-DQ-03: non-null values outside [lo, hi]."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).between(lo, hi))


def dq_unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """O-DQ-04: column combinations that occur more than once (partial counts map-side)."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("duplicate_count"))
              .filter(F.col("duplicate_count") > 1))


# ------------------------------------------------------------------ expectations
@dataclass(frozen=True)
class Expectation:
    check: str                  # exists | not_null | unique | between | type
    column: str
    mostly: float = 1.0
    min_value: float | None = None
    max_value: float | None = None
    type_name: str | None = None
    optional: bool = False      # only evaluated if the column exists


def expect_column_exists(col: str) -> Expectation:
    return Expectation("exists", col)


def expect_not_null(col: str, mostly: float = 1.0, optional: bool = False) -> Expectation:
    return Expectation("not_null", col, mostly, optional=optional)


def expect_unique(col: str, mostly: float = 1.0) -> Expectation:
    return Expectation("unique", col, mostly)


def expect_between(col: str, min_value=None, max_value=None, mostly: float = 1.0,
                   optional: bool = False) -> Expectation:
    return Expectation("between", col, mostly, min_value, max_value, optional=optional)


def expect_type(col: str, type_name: str, mostly: float = 1.0) -> Expectation:
    return Expectation("type", col, mostly, type_name=type_name)


_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TYPE_NAMES = {"int64": _INT_TYPES, "int": _INT_TYPES, "float64": (T.DoubleType, T.FloatType),
               "str": (T.StringType,), "string": (T.StringType,)}


def _type_cast(type_name: str) -> str:
    return {"int64": "bigint", "int": "bigint", "float64": "double"}.get(type_name, "string")


def _agg_exprs(df: DataFrame, i: int, e: Expectation) -> list[Column]:
    c = F.col(e.column)
    nn = c.isNotNull()
    if e.check == "not_null":
        return [F.count(F.lit(1)).alias(f"e{i}"), F.count_if(~nn).alias(f"u{i}")]
    if e.check == "between":
        ok = F.lit(True)
        if e.min_value is not None:
            ok = ok & (c >= F.lit(e.min_value))
        if e.max_value is not None:
            ok = ok & (c <= F.lit(e.max_value))
        return [F.count(c).alias(f"e{i}"), F.count_if(nn & ~ok).alias(f"u{i}")]
    if e.check == "type":
        dtype = df.schema[e.column].dataType
        if isinstance(dtype, _TYPE_NAMES.get(e.type_name, ())):
            return [F.count(c).alias(f"e{i}"), F.lit(0).cast("long").alias(f"u{i}")]
        if isinstance(dtype, T.StringType):
            cast = _type_cast(e.type_name)
            bad = nn & (F.lit(False) if cast == "string" else coerce_numeric(e.column, cast).isNull())
            return [F.count(c).alias(f"e{i}"), F.count_if(bad).alias(f"u{i}")]
        return [F.count(c).alias(f"e{i}"), F.count(c).alias(f"u{i}")]
    raise ValueError(e.check)


def validate(spark: SparkSession, df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """O-DQ-05..10: evaluate a suite; one row per evaluated expectation."""
    cols = set(df.columns)
    todo = [e for e in expectations if not (e.optional and e.column not in cols)]
    static_rows, agg_parts, uniq_parts = [], [], []
    for i, e in enumerate(todo):
        if e.check == "exists":
            ok = e.column in cols
            static_rows.append((e.check, e.column, 1, 0 if ok else 1, 0.0 if ok else 1.0, 1.0, ok))
        elif e.column not in cols:
            static_rows.append((e.check, e.column, 0, 0, None, e.mostly, False))
        elif e.check == "unique":
            # every member of a duplicated group counts as unexpected
            g = df.filter(F.col(e.column).isNotNull()).groupBy(e.column).agg(F.count(F.lit(1)).alias("n"))
            uniq_parts.append(g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("evaluated"),
                                    F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
                                    .cast("long").alias("unexpected"))
                              .select(F.lit(e.check).alias("check"), F.lit(e.column).alias("column"),
                                      "evaluated", "unexpected", F.lit(e.mostly).alias("mostly")))
        else:
            agg_parts.append((i, e))
    frames: list[DataFrame] = []
    if agg_parts:
        one = df.agg(*[x for i, e in agg_parts for x in _agg_exprs(df, i, e)])
        stack = ", ".join(f"'{e.check}', '{e.column}', CAST(e{i} AS BIGINT), CAST(u{i} AS BIGINT), "
                          f"CAST({e.mostly!r} AS DOUBLE)" for i, e in agg_parts)
        frames.append(one.selectExpr(
            f"stack({len(agg_parts)}, {stack}) AS (check, column, evaluated, unexpected, mostly)"))
    frames.extend(uniq_parts)
    out = None
    if frames:
        out = reduce(lambda a, b: a.unionByName(b), frames)
        ratio = F.when(F.col("evaluated") > 0, F.col("unexpected") / F.col("evaluated")).otherwise(F.lit(0.0))
        out = out.select("check", "column", "evaluated", "unexpected", F.round(ratio, 6).alias("ratio"),
                         "mostly", ((F.lit(1.0) - ratio) >= F.col("mostly") - F.lit(1e-12)).alias("success"))
    if static_rows:
        st = spark.createDataFrame(static_rows, RESULT_SCHEMA)
        out = st if out is None else out.unionByName(st)
    return out


# ------------------------------------------------------------------ suites (fixed values)
def unified_suite() -> list[Expectation]:
    return [expect_column_exists("company_name"), expect_not_null("company_name"),
            expect_column_exists("domain"), expect_column_exists("source_system"),
            expect_not_null("source_system"), expect_unique("company_id", 0.99),
            expect_type("employee_count", "int64", 0.95), expect_type("founded_year", "int64", 0.95),
            expect_between("founded_year", 1800, 2030, 0.95), expect_between("employee_count", 0, None, 0.95)]


def raw_dim_suite() -> list[Expectation]:
    return [expect_column_exists("company_id"), expect_not_null("company_id", 0.99),
            expect_column_exists("company_name"), expect_not_null("company_name", 0.99),
            expect_column_exists("source_system"), expect_not_null("source_system", 0.95),
            expect_between("founded_year", 1800, 2030, 0.90, optional=True)]


def raw_fct_suite() -> list[Expectation]:
    return [expect_column_exists("company_id"), expect_not_null("company_id", 0.99),
            expect_column_exists("company_name"), expect_not_null("company_name", 0.99),
            expect_column_exists("metric_date"), expect_not_null("metric_date", 0.95),
            expect_column_exists("source_system"), expect_not_null("source_system", 0.95),
            expect_between("fortune_rank", 1, 1000, 0.90, optional=True)]


def bronze_dim_suite() -> list[Expectation]:
    return [expect_column_exists("company_id"), expect_not_null("company_id", 0.99),
            expect_unique("company_id", 0.99), expect_column_exists("company_name"),
            expect_not_null("company_name", 0.99), expect_unique("company_name", 0.99),
            expect_column_exists("source_system"), expect_not_null("source_system", 0.95),
            expect_between("founded_year", 1800, 2030, 0.90, optional=True)]


def bronze_fct_suite() -> list[Expectation]:
    return [expect_column_exists("company_id"), expect_not_null("company_id", 0.99),
            expect_column_exists("company_name"), expect_not_null("company_name", 0.99),
            expect_column_exists("metric_date"), expect_not_null("metric_date", 0.95),
            expect_column_exists("source_system"), expect_not_null("source_system", 0.95),
            expect_between("fortune_rank", 1, 1000, 0.90, optional=True),
            expect_between("employee_count", 0, None, 0.90, optional=True)]


def marts_suite() -> list[Expectation]:
    return [expect_column_exists("company_id"), expect_not_null("company_id", 0.99),
            expect_unique("company_id", 0.99), expect_column_exists("company_name"),
            expect_not_null("company_name", 0.99), expect_unique("company_name", 0.99),
            expect_column_exists("source_system"), expect_not_null("source_system", 0.95),
            expect_not_null("country", 0.90, optional=True),
            expect_between("founded_year", 1800, 2030, 0.90, optional=True),
            expect_between("fortune_rank", 1, 1000, 0.90, optional=True),
            expect_between("employee_count", 0, None, 0.90, optional=True)]


# Limits of the tabular editor.
MAX_COLUMNS, MAX_ROWS = 100, 100_000


def dataset_limits(df: DataFrame, max_columns: int = MAX_COLUMNS, max_rows: int = MAX_ROWS) -> DataFrame:
    """O-DQ-11: header names non-blank, at most ``max_columns`` columns, 1..``max_rows`` rows.

    All rows are counted; the limit is only compared with the count."""
    header_ok = all(c is not None and c.strip() != "" for c in df.columns)
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return n.select(F.lit(len(df.columns)).alias("n_columns"), F.lit(header_ok).alias("header_ok"), "n_rows",
                    (F.lit(header_ok) & F.lit(len(df.columns) <= max_columns)
                     & (F.col("n_rows") >= 1) & (F.col("n_rows") <= max_rows)).alias("success"))


def check_report(tables: dict[str, DataFrame], tests: dict[str, tuple], suites: dict[str, tuple[str, list[Expectation]]]) -> DataFrame:
    """One row per check of a run: violating rows (or key values) of each dbt-style
    test, failed expectations of each suite.  As in the reference's schedule,
    failures are reported, not raised.

    ``tests``: name -> (table, "not_null" | "range" | "unique", columns, low, high);
    ``suites``: name -> (table, expectations).  All row-wise checks of a table share
    one scan and one aggregate; each distinct key of a table is grouped once."""
    parts: list[DataFrame] = []
    for name, df in tables.items():
        cols = set(df.columns)
        rowwise: dict[str, Column] = {}
        lines: list[tuple[str, str, str]] = []           # check, kind, SQL of its violations
        keys: dict[tuple[str, ...], list[tuple[str, str, str]]] = {}
        for check, (table, what, on, *bounds) in tests.items():
            if table != name:
                continue
            if what == "unique":
                keys.setdefault(tuple(on), []).append((check, "test", "groups"))
                continue
            c = F.col(on[0])
            bad = c.isNull() if what == "not_null" else c.isNotNull() & ~c.between(*bounds)
            rowwise[f"t{len(rowwise)}"] = F.count_if(bad)
            lines.append((check, "test", list(rowwise)[-1]))
        for check, (table, expectations) in suites.items():
            if table != name:
                continue
            lines.append((check, "suite", "0"))
            for e in expectations:
                if e.column not in cols:
                    if not e.optional:
                        lines.append((check, "suite", "1"))
                elif e.check == "unique":
                    keys.setdefault((e.column,), []).append((check, "suite", _failed("evaluated", "unexpected", e.mostly)))
                elif e.check != "exists":
                    i = len(rowwise)
                    evaluated, unexpected = _agg_exprs(df, i, e)
                    rowwise[f"e{i}"], rowwise[f"u{i}"] = evaluated, unexpected
                    lines.append((check, "suite", _failed(f"e{i}", f"u{i}", e.mostly)))
        if lines:
            one = df.agg(F.count(F.lit(1)).alias("_rows"), *[x.alias(n) for n, x in rowwise.items()])
            parts.append(_lines(one, lines))
        for key, own in keys.items():
            n = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            whole = F.col(key[0]).isNotNull()
            g = n.agg(F.count_if(F.col("n") > 1).alias("groups"), F.coalesce(F.sum(F.when(whole, F.col("n"))), F.lit(0)).alias("evaluated"),
                      F.coalesce(F.sum(F.when(whole & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("unexpected"))
            parts.append(_lines(g, own))
    out = reduce(lambda a, b: a.unionByName(b), parts).groupBy("check_name", "kind").agg(F.sum("violations").alias("violations"))
    return out.withColumn("passed", F.col("violations") == 0)


def _failed(evaluated: str, unexpected: str, mostly: float) -> str:
    return (f"CASE WHEN 1 - CASE WHEN {evaluated} > 0 THEN CAST({unexpected} AS DOUBLE) / {evaluated} ELSE 0 END "
            f">= CAST({mostly!r} AS DOUBLE) - CAST(1e-12 AS DOUBLE) THEN 0 ELSE 1 END")


def _lines(one: DataFrame, lines: list[tuple[str, str, str]]) -> DataFrame:
    rows = ", ".join(f"'{check}', '{kind}', CAST({expr} AS BIGINT)" for check, kind, expr in lines)
    return one.selectExpr(f"stack({len(lines)}, {rows}) AS (check_name, kind, violations)")
