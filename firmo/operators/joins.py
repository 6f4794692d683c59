"""Joins of the layers and of enrichment (O-JN-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEY = ["company_name", "country"]


def enrich_left_join(primary_best: DataFrame, secondary_best: DataFrame) -> DataFrame:
    """O-JN-01: primary LEFT JOIN secondary on (name, country).

    Both inputs hold one row per key (see ``dedup``), so the join is 1:1 and
    both sides arrive hash-partitioned on the key: no pair blow-up, no extra
    shuffle.  Website prefers the primary, founded year the secondary."""
    s = secondary_best.select(*KEY, F.col("website").alias("_s_website"),
                              F.col("founded_year").alias("_s_founded_year"))
    j = primary_best.join(s, KEY, "left")
    return (j.withColumn("website", F.coalesce("website", "_s_website"))
             .withColumn("founded_year", F.coalesce("_s_founded_year", "founded_year"))
             .drop("_s_website", "_s_founded_year")
             .select(*primary_best.columns))


def anti_join_unmatched(secondary: DataFrame, primary: DataFrame) -> DataFrame:
    """O-JN-02: secondary rows whose (name, country) has no primary row (NOT EXISTS)."""
    return secondary.join(primary.select(*KEY), KEY, "left_anti")


def latest_metrics(bronze_fct: DataFrame) -> DataFrame:
    """O-AG-01: max of each metric and of the date per (company_id, company_name).

    Partial aggregation runs map-side, so a hot key is combined before the shuffle."""
    m = ["fortune_rank", "employee_count", "revenue_millions", "revenue_percent_change",
         "profits_m", "profits_percent_change", "assets_m", "market_cap_updated_m"]
    return (bronze_fct.groupBy("company_id", "company_name")
            .agg(*[F.max(c).alias(c) for c in m], F.max("metric_date").alias("latest_metric_date")))


#: A name with more fact rows than this is dealt over several tasks by ``mart_join``.
HOT = 4096


def mart_join(bronze_dim: DataFrame, fct_latest: DataFrame) -> DataFrame:
    """O-JN-03: dim LEFT JOIN latest metrics on company name.

    Names with several (ticker, country) fact keys fan out, as in the model (Q17).
    Both sides grow with the input, so both are shuffled by name, none is sent whole
    to every executor.  A name of over ``HOT`` facts is cut into parts of about
    ``HOT``: its facts are dealt by their id, its dimension rows meet every part.
    Such a name has a fact, so its rows without one come only from a part that got
    none and are dropped; of other names (one part) they are the left join's."""
    # one row for each name of over HOT facts: at most a row for HOT of the facts
    hot = (fct_latest.groupBy("company_name").agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > HOT)
           .select("company_name", F.ceil(F.col("_n") / HOT).cast("int").alias("_parts")))

    def in_parts(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), "company_name", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    f = (in_parts(fct_latest).withColumn("_part", F.pmod(F.xxhash64("company_id"), F.col("_parts")).cast("int"))
         .withColumn("_met", F.lit(True)).drop("company_id", "_parts"))
    d = (in_parts(bronze_dim.filter(F.col("company_name").isNotNull() & (F.length(F.trim("company_name")) > 0)))
         .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))))
    return (d.join(f.hint("merge"), ["company_name", "_part"], "left")
            .filter((F.col("_parts") == 1) | F.col("_met"))
            .drop("_part", "_parts", "_met"))


def fill_from_lookup(df: DataFrame, lookup: DataFrame, name_col: str = "company_name",
                     value_col: str = "founded_year", seq_col: str = "seq",
                     case_insensitive: bool = True, stamp: str | None = None) -> DataFrame:
    """O-JN-04: fill a column from a (name -> value) table; later lookup rows win.

    The lookup is first reduced to one row per normalised name (max_by on the
    sequence, a partial aggregate), then hash-joined; a non-null lookup value
    replaces the current one.  Names match without case and outer blanks, or
    exactly.  ``stamp``: the new ``last_updated_at`` of all rows, as after any fill."""
    norm = (lambda c: F.lower(F.trim(c))) if case_insensitive else (lambda c: c)
    best = (lookup.filter(F.col(value_col).isNotNull())
            .groupBy(norm(F.col(name_col)).alias("_k"))
            .agg(F.max_by(F.col(value_col), F.col(seq_col)).alias("_v")))
    j = df.join(best, norm(F.col(name_col)) == F.col("_k"), "left")
    out = (j.withColumn(value_col, F.coalesce(F.col("_v").cast(df.schema[value_col].dataType), F.col(value_col)))
            .drop("_k", "_v"))
    return out if stamp is None else out.withColumn("last_updated_at", F.lit(stamp))


def merge_missing_fields(df: DataFrame, enrichment: DataFrame, key: str, fields: list[str],
                         default_source: str = "web_scraper", name_col: str | None = None,
                         stamp: str | None = None) -> DataFrame:
    """O-JN-05: keep each existing non-blank value, else take the enrichment's.

    ``enrichment`` must hold at most one row per ``key``.  ``name_col``: a blank
    name becomes the key it was looked up by; ``stamp``: the new
    ``last_updated_at`` of the merged rows."""
    e = enrichment.select(key, *[F.col(f).alias(f"_e_{f}") for f in fields])
    j = df.join(e, key, "left")
    for f in fields:
        cur = F.col(f)
        blank = cur.isNull() | (cur.cast("string") == "") | (cur.cast("string") == "None")
        j = j.withColumn(f, F.when(blank, F.col(f"_e_{f}").cast(df.schema[f].dataType)).otherwise(cur))
    if "source_system" in df.columns:
        j = j.withColumn("source_system", F.coalesce(F.nullif("source_system", F.lit("")), F.lit(default_source)))
    if name_col:
        j = j.withColumn(name_col, F.coalesce(F.nullif(name_col, F.lit("")), F.col(key)))
    if stamp is not None:
        j = j.withColumn("last_updated_at", F.lit(stamp))
    return j.drop(*[f"_e_{f}" for f in fields]).select(*df.columns)


def top_group_filter(df: DataFrame, col: str, k: int = 8) -> DataFrame:
    """O-JN-06: rows whose ``col`` is among the k most frequent values (ties by value).

    The top-k frame holds at most k rows, so broadcasting it is bounded."""
    top = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
             .orderBy(F.col("_n").desc(), F.col(col).asc()).limit(k).select(col))
    return df.join(F.broadcast(top), col, "left_semi")
