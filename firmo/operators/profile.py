"""Profiling of a company table (O-AG-09..22): the numbers behind the
exploratory charts, computed as distributed aggregates.

Several columns are handled at once in long form (``column_name, value``),
so one scan and one shuffle serve all of them.  Exact quantiles are selected by
histogram refinement (linear interpolation between the two order statistics, as
pandas does): values are counted in buckets, and only those of the wanted buckets
are ever ordered.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from firmo.session import checkpoint_root


def long_form(df: DataFrame, columns: list[str], filters: dict[str, Column] | None = None,
              ids: list[str] | None = None, keep_null: bool = False) -> DataFrame:
    """(ids..., column_name, value double) for the non-null values of ``columns``.

    ``filters`` maps a column to an extra condition on its rows (e.g. > 0)."""
    filters = filters or {}
    ids = ids or []
    parts = []
    for c in columns:
        cond = F.lit(True) if keep_null else F.col(c).isNotNull()
        if c in filters:
            cond = cond & filters[c]
        parts.append(F.when(cond, F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))))
    # explode + row filter (not the interpreted higher-order ``filter``) stays in codegen
    return (df.select(*ids, F.explode(F.array(*parts)).alias("_kv")).filter(F.col("_kv").isNotNull())
              .select(*ids, "_kv.column_name", "_kv.value"))


#: buckets of the first round: this many for each unit of log(1 + |value|)
LOG_STEPS = 256
#: equal parts into which a later round cuts an interval
PARTS = 4096
#: an interval of at most this many rows is fetched instead of cut again
FETCH_ROWS = 1_000_000
#: at most this many wanted intervals pass the driver and are sent to every task; more are
#: checkpointed and joined by a shuffle
SENT_SPANS = 100_000


def _running(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``_upto``: the rows (``_c``) up to and including this one, in ``order`` inside ``keys``."""
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_upto", F.sum("_c").over(inside))


def _holding(df: DataFrame, spans: DataFrame, keys: list[str], inside: Column, send: bool) -> DataFrame:
    """Rows of ``df`` joined to the ``spans`` with equal (also null) ``keys`` for which ``inside`` holds."""
    renamed = spans.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in spans.columns if c not in keys])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    joined = df.join(F.broadcast(renamed) if send else renamed, same & inside)
    return joined.drop(*[f"_of_{k}" for k in keys])


def _wanted_spans(lf: DataFrame, groups: list[str], probs: list[float]) -> DataFrame:
    """One scan: for each group, probability and end (lower, upper order statistic) the
    bucket that holds it, as (_mn, _mx) of its values, its rows ``_c`` and the rank ``_at``
    inside it.

    The logarithm is semi-monotonic, so buckets are in the order of the values; they
    number at most 363,000 for each group, whatever the values (two more for infinities, one for NaN)."""
    v = F.col("_v")
    scaled = F.floor(F.signum(v) * F.least(F.log1p(F.abs(v)), F.lit(1400.0)) * LOG_STEPS)
    bucket = F.when(F.isnan(v), F.lit(1401 * LOG_STEPS)).otherwise(scaled).cast("long")
    counted = lf.groupBy(*groups, bucket.alias("_b")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"))
    ranked = _running(counted, groups, "_b").withColumn("_n", F.sum("_c").over(Window.partitionBy(*groups)))
    pos = lambda p: F.lit(float(p)) * (F.col("_n") - 1)
    ends = [F.struct(F.lit(float(p)).alias("prob"), pos(p).alias("_pos"), F.lit(upper).alias("_upper"),
                     (F.ceil(pos(p)) if upper else F.floor(pos(p))).cast("long").alias("_rank"))
            for p in probs for upper in (False, True)]
    before = F.col("_upto") - F.col("_c")
    holds = lambda rank: (rank >= before) & (rank < F.col("_upto"))
    some = reduce(lambda x, y: x | y, [holds(near(pos(p))) for p in probs for near in (F.floor, F.ceil)])
    held = ranked.filter(some).select(*groups, "_c", "_mn", "_mx", before.alias("_before"), F.explode(F.array(*ends)).alias("_e"))
    held = held.select(*groups, "_c", "_mn", "_mx", "_before", "_e.*")
    at = F.col("_rank") - F.col("_before")
    return held.filter((at >= 0) & (at < F.col("_c"))).select(*groups, "prob", "_pos", "_upper", at.alias("_at"), "_c", "_mn", "_mx")


def _narrowed(lf: DataFrame, spans: DataFrame, groups: list[str], wide: Column, send: bool) -> DataFrame:
    """One scan: intervals for which ``wide`` holds are replaced by the one of their
    ``PARTS`` equal parts that holds the wanted rank; the smallest and the largest value
    fall into different parts, so each round gets nearer."""
    keys = [*groups, "_mn", "_mx"]
    mine = F.col("_v").between(F.col("_mn"), F.col("_mx"))
    rows = _holding(lf, spans.filter(wide).select(*keys).distinct(), groups, mine, send)
    part = F.floor((F.col("_v") - F.col("_mn")) / (F.col("_mx") - F.col("_mn")) * PARTS)
    counted = rows.groupBy(*keys, F.least(part, F.lit(PARTS - 1)).alias("_b")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_mn2"), F.max("_v").alias("_mx2"))
    ranked = _running(counted, keys, "_b")
    first = F.col("_upto") - F.col("_c")
    held = _holding(ranked, spans.filter(wide).drop("_c"), keys, (F.col("_at") >= first) & (F.col("_at") < F.col("_upto")), send)
    done = held.select(*groups, "prob", "_pos", "_upper", (F.col("_at") - first).alias("_at"), "_c",
                       F.col("_mn2").alias("_mn"), F.col("_mx2").alias("_mx"))
    return spans.filter(~wide).unionByName(done)


def _fetched(lf: DataFrame, spans: DataFrame, groups: list[str], is_open: Column, send: bool) -> DataFrame:
    """One scan: the values of the open intervals, counted and ordered inside each."""
    keys = [*groups, "_mn", "_mx"]
    mine = F.col("_v").between(F.col("_mn"), F.col("_mx"))
    rows = _holding(lf, spans.filter(is_open).select(*keys).distinct(), groups, mine, send)
    ranked = _running(rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")), keys, "_v")
    mine = (F.col("_at") >= F.col("_upto") - F.col("_c")) & (F.col("_at") < F.col("_upto"))
    found = _holding(ranked, spans.filter(is_open).drop("_c"), keys, mine, send)
    return found.select(*groups, "prob", "_pos", "_upper", "_v")


def _kept(spans: DataFrame, is_open: Column, wide: Column) -> tuple[DataFrame, dict, bool]:
    """The evaluated intervals, how many of them are open and wide, and whether they are few."""
    counts = [F.count_if(is_open).alias("open"), F.count_if(wide).alias("wide")]
    few = spans.limit(SENT_SPANS + 1).withColumn("_open", is_open.cast("int")).withColumn("_wide", wide.cast("int")).collect()
    if len(few) <= SENT_SPANS:
        size = {"open": sum(r["_open"] for r in few), "wide": sum(r["_wide"] for r in few)}
        local = spans.sparkSession.createDataFrame([tuple(r)[:-2] for r in few], spans.schema)
        return local, size, True
    checkpoint_root(spans.sparkSession)
    spans = spans.checkpoint(eager=True)
    return spans, spans.agg(*counts).first().asDict(), False


def exact_quantiles(long_df: DataFrame, groups: list[str], probs: list[float],
                    value: str = "value") -> DataFrame:
    """(groups..., prob, quantile) with linear interpolation between order statistics;
    ``groups`` names at least one column.

    Exact selection by histogram refinement.  One scan counts the values of each group
    in bounded buckets and keeps the buckets that hold a wanted order statistic; a bucket
    with one distinct value (a hot value) is an answer at once; a last scan fetches the
    values of the few other buckets.  Only where such a bucket holds more than
    ``FETCH_ROWS`` rows, further scans cut it into ``PARTS`` parts each.  So two scans
    serve all columns and groups (three from some 10^9 rows a group), nothing but counts
    and the wanted buckets is shuffled, and no set of values is sorted as a whole.  The
    wanted buckets (two for each group and probability) are all that is kept between scans;
    their number is checked before they pass the driver.  Null is ignored; NaN is above all numbers."""
    lf = long_df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_v"))
    is_open = F.col("_mn") < F.col("_mx")
    wide = is_open & (F.col("_c") > FETCH_ROWS)
    spans, size, send = _kept(_wanted_spans(lf, groups, probs), is_open, wide)
    while size["wide"]:
        spans, size, send = _kept(_narrowed(lf, spans, groups, wide, send), is_open, wide)
    known = spans.filter(~is_open).select(*groups, "prob", "_pos", "_upper", F.col("_mn").alias("_v"))
    ends = known.unionByName(_fetched(lf, spans, groups, is_open, send)) if size["open"] else known
    both = ends.groupBy(*groups, "prob").agg(
        F.max("_pos").alias("_pos"), F.max(F.when(~F.col("_upper"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_upper"), F.col("_v"))).alias("_vhi"))
    between = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * (F.col("_pos") - F.floor("_pos"))
    return both.select(*groups, "prob", F.when(F.col("_vlo") == F.col("_vhi"), F.col("_vlo")).otherwise(between).alias("quantile"))


def approximate_quantiles(long_df: DataFrame, groups: list[str], probs: dict[str, float], accuracy: int = 100_000) -> DataFrame:
    """Named quantiles by a bounded sketch per group: no sort, relative rank error 1/accuracy."""
    arr = F.percentile_approx("value", [float(p) for p in probs.values()], accuracy)
    q = long_df.groupBy(*groups).agg(arr.alias("_q"))
    return q.select(*groups, *[F.col("_q")[i].cast("double").alias(name) for i, name in enumerate(probs)])


def _quantile_wide(long_df: DataFrame, groups: list[str], probs: dict[str, float]) -> DataFrame:
    q = exact_quantiles(long_df, groups, list(probs.values()))
    aggs = [F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name) for name, p in probs.items()]
    return q.groupBy(*groups).agg(*aggs)


# Quantile-derived values are presented at 10 decimals: interpolation in
# another engine may differ in the last bit (e.g. a fused multiply-add).
QUANTILE_SCALE = 10


def _rq(c: str) -> Column:
    return F.round(F.col(c), QUANTILE_SCALE).alias(c)


def _r(c, n=6) -> Column:
    if isinstance(c, str):
        return F.round(F.col(c), n).alias(c)
    return F.round(c, n)


def missing_summary(df: DataFrame) -> DataFrame:
    """O-AG-09: null count and percentage per column (one pass)."""
    total = F.count(F.lit(1))
    one = df.agg(total.alias("_total"), *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(df.columns)])
    stack = ", ".join(f"'{c}', _m{i}" for i, c in enumerate(df.columns))
    long = one.selectExpr("_total", f"stack({len(df.columns)}, {stack}) AS (column_name, null_count)")
    return long.select("column_name", F.col("null_count").cast("long").alias("null_count"),
                       _r(F.when(F.col("_total") > 0, F.col("null_count") * 100.0 / F.col("_total")), 4).alias("null_pct"))


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """O-AG-10: count, mean, std, min, quartiles, max per numeric column."""
    lf = long_form(df, columns)
    basic = lf.groupBy("column_name").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                         F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                         F.max("value").alias("max"))
    qs = _quantile_wide(lf, ["column_name"], {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    j = basic.join(qs, "column_name")
    return j.select("column_name", "count", _r("mean"), _r("std"), "min", _rq("q25"), _rq("q50"), _rq("q75"), "max")


def summary_metrics(df: DataFrame, positive: list[str], all_values: list[str]) -> DataFrame:
    """O-AG-11: mean, median, std, min, max; positive values only for ``positive``."""
    cols = positive + all_values
    lf = long_form(df, cols, {c: F.col(c) > 0 for c in positive})
    basic = lf.groupBy("column_name").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                         F.min("value").alias("min"), F.max("value").alias("max"))
    med = _quantile_wide(lf, ["column_name"], {"median": 0.5})
    return basic.join(med, "column_name").select("column_name", _r("mean"), _rq("median"), _r("std"), "min", "max")


def nunique_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """O-AG-12: total rows and distinct non-null values of each column."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  *[F.count_distinct(c).alias(f"nunique_{c}") for c in columns])


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """O-AG-13: frequency of each non-null value of several categorical columns, one grouped pass."""
    parts = [F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))
             for c in columns]
    lf = df.select(F.explode(F.array(*parts)).alias("_kv")).filter(F.col("_kv").isNotNull()).select("_kv.*")
    return lf.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def flag_share(df: DataFrame, flags: list[str], yes: str = "YES") -> DataFrame:
    """O-AG-14: count and % of rows whose flag is yes (case-insensitive, quirk Q5)."""
    one = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(F.upper(F.trim(F.col(c))) == yes).alias(f"_y{i}") for i, c in enumerate(flags)])
    stack = ", ".join(f"'{c}', _y{i}" for i, c in enumerate(flags))
    long = one.selectExpr("_total", f"stack({len(flags)}, {stack}) AS (flag, yes_count)")
    return long.select("flag", F.col("yes_count").cast("long").alias("yes_count"),
                       _r(F.when(F.col("_total") > 0, F.col("yes_count") * 100.0 / F.col("_total")), 4).alias("yes_pct"))


def group_avg_topk(df: DataFrame, group: str, metrics: dict[str, Column], k: int = 10,
                   count_metric: str | None = "company_count") -> DataFrame:
    """O-AG-15: per group, averages (each with its own row filter via ``when``) and counts;
    the top k groups of each metric (ties by group), long form."""
    aggs = [F.avg(expr).alias(name) for name, expr in metrics.items()]
    if count_metric:
        aggs.append(F.count(F.lit(1)).cast("double").alias(count_metric))
    g = df.filter(F.col(group).isNotNull()).groupBy(group).agg(*aggs)
    names = list(metrics) + ([count_metric] if count_metric else [])
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    long = g.selectExpr(group, f"stack({len(names)}, {stack}) AS (metric, value)").filter(F.col("value").isNotNull())
    w = Window.partitionBy("metric").orderBy(F.col("value").desc(), F.col(group).asc())
    return (long.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= k)
                .select("metric", "pos", group, _r("value", 4).alias("value")))


def _bounds(lf: DataFrame, groups: list[str]) -> DataFrame:
    """Quartiles (presented precision) and the 1.5 IQR fences computed from them."""
    q = _quantile_wide(lf, groups, {"q1": 0.25, "median": 0.5, "q3": 0.75}) \
        .select(*groups, _rq("q1"), _rq("median"), _rq("q3"))
    iqr = F.col("q3") - F.col("q1")
    return q.select(*groups, "q1", "median", "q3", (F.col("q1") - 1.5 * iqr).alias("lower_bound"),
                    (F.col("q3") + 1.5 * iqr).alias("upper_bound"))


def iqr_outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """O-AG-16: Q1 - 1.5 IQR, Q3 + 1.5 IQR, outlier count and % of all rows per column.

    Bounds are one small row per column: a bounded broadcast."""
    lf = long_form(df, columns)
    b = _bounds(lf, ["column_name"])
    every = long_form(df, columns, keep_null=True)
    out = (every.join(F.broadcast(b), "column_name")
             .groupBy("column_name")
             .agg(F.count(F.lit(1)).alias("_rows"),
                  F.count_if((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound")))
                  .alias("outlier_count")))
    res = b.join(out, "column_name")
    return res.select("column_name", "q1", "q3", "lower_bound", "upper_bound",
                      F.col("outlier_count").cast("long").alias("outlier_count"),
                      _r(F.col("outlier_count") * 100.0 / F.col("_rows"), 4).alias("outlier_pct"))


def iqr_outlier_rows(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """O-AG-16 rows: (key, column_name, value) of every outlier."""
    lf = long_form(df, columns, ids=[key])
    b = _bounds(lf, ["column_name"])
    j = lf.join(F.broadcast(b), "column_name")
    return j.filter((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))) \
            .select(key, "column_name", "value")


def box_stats(lf: DataFrame, groups: list[str]) -> DataFrame:
    """O-AG-17: five-number summary, whiskers (extreme values inside the 1.5 IQR fences)
    and outlier count per group of a long frame."""
    b = _bounds(lf, groups)
    # one row per group: as bounded as the result
    j = lf.join(F.broadcast(b), groups)
    inside = (F.col("value") >= F.col("lower_bound")) & (F.col("value") <= F.col("upper_bound"))
    agg = j.groupBy(*groups).agg(F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                                 F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
                                 F.count_if(~inside).alias("outlier_count"),
                                 F.count(F.lit(1)).alias("n"))
    return b.join(agg, groups).select(*groups, "n", "q1", "median", "q3", "whisker_low",
                                      "whisker_high", F.col("outlier_count").cast("long").alias("outlier_count"))


def histogram(lf: DataFrame, bins: int = 50) -> DataFrame:
    """O-AG-18: ``bins`` equal-width bins per column between min and max, the maximum
    in the last bin; a constant column gets the range [v - 0.5, v + 0.5].  Empty
    bins are listed with 0."""
    st = lf.groupBy("column_name").agg(F.min("value").alias("_mn"), F.max("value").alias("_mx"))
    lo = F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn"))
    hi = F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx"))
    st = st.select("column_name", lo.alias("_lo"), hi.alias("_hi"))
    idx = F.least(F.greatest(F.floor((F.col("value") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))),
                             F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = lf.join(F.broadcast(st), "column_name").groupBy("column_name", idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = st.select("column_name", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return (grid.join(counts, ["column_name", "bin"], "left")
                .select("column_name", "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_low"),
                        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_high"),
                        F.coalesce("count", F.lit(0)).cast("long").alias("count")))


#: terms of the expansion of a density about the middle of a box
KDE_TERMS = 20
#: a box adds nothing to grid points over this many bandwidths from its middle
KDE_REACH = 12.0


def kde_grid(lf: DataFrame, groups: list[str], points: int = 200, cut: float = 3.0, bins: int = 50) -> DataFrame:
    """O-AG-19: Gaussian kernel density on ``points`` grid points per group.

    Scott's bandwidth h = std * n^(-1/5); the grid spans min - cut*h .. max + cut*h.
    ``cut`` and ``points`` are those of the plot: a density over a histogram does
    not pass the data (cut 0, 200 points), a violin extends by two bandwidths
    (cut 2, 100 points).  ``count_density`` is the curve scaled to a ``bins``-bin histogram.

    A fast Gauss transform: values are summed up in boxes as wide as h.  With t and y
    the distances of a value and of a grid point from the middle of the box, in
    bandwidths, exp(-(y-t)^2/2) = exp(-y^2/2) * sum over k of y^k * exp(-t^2/2) t^k/k!, so a box
    keeps ``KDE_TERMS`` sums over its values and each grid point near it is one polynomial.
    As |t| <= 1/2, the terms left out are at most 2 * 0.5^20 / sqrt(20! * sqrt(40 pi)) < 4e-16
    of a kernel's peak for each value, and the grid points out of reach get less than
    exp(-11.5^2/2) < 2e-29: below the rounding of the plain sum, and of the presented decimals up
    to a count density of 10^11.  Two scans (deviations, sums) serve all groups; the work is the
    values plus the boxes times the grid points near them, instead of values times points."""
    st = lf.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("value").alias("_sd"),
                                 F.min("value").alias("_mn"), F.max("value").alias("_mx"))
    st = st.withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).filter(F.col("_h") > 0).drop("_sd")
    # one row per group: as bounded as the result
    own = [*groups, "_n", "_mn", "_mx", "_h"]
    j = lf.join(F.broadcast(st), groups).select(*own, "value", F.floor((F.col("value") - F.col("_mn")) / F.col("_h")).alias("_box"))
    middle = F.col("_mn") + (F.col("_box") + 0.5) * F.col("_h")
    j = j.select(*own, "_box", ((F.col("value") - middle) / F.col("_h")).alias("_t"))
    j = j.withColumn("_w", F.exp(F.lit(-0.5) * F.col("_t") * F.col("_t")))
    terms = [F.col("_w")]
    for k in range(1, KDE_TERMS):
        terms.append(terms[-1] * F.col("_t") / F.lit(float(k)))
    boxes = j.groupBy(*own, "_box").agg(*[F.sum(t).alias(f"_m{k}") for k, t in enumerate(terms)])
    boxes = (boxes.withColumn("_g0", F.col("_mn") - cut * F.col("_h"))
             .withColumn("_step", (F.col("_mx") - F.col("_mn") + 2 * cut * F.col("_h")) / (points - 1)))
    # the box of the smallest value always exists: it lists all points, the others those in reach
    lowest = F.col("_box") == 0
    point = lambda x: F.least(F.greatest(x.cast("long"), F.lit(0)), F.lit(points - 1)).cast("int")
    first = point(F.when(lowest, F.lit(0)).otherwise(F.floor((middle - KDE_REACH * F.col("_h") - F.col("_g0")) / F.col("_step"))))
    last = point(F.when(lowest, F.lit(points - 1)).otherwise(F.ceil((middle + KDE_REACH * F.col("_h") - F.col("_g0")) / F.col("_step"))))
    near = boxes.withColumn("i", F.explode(F.sequence(first, last)))
    near = near.withColumn("_y", (F.col("_g0") + F.col("i") * F.col("_step") - middle) / F.col("_h"))
    y = F.col("_y")
    poly = reduce(lambda acc, k: acc * y + F.col(f"_m{k}"), range(KDE_TERMS - 2, -1, -1), F.col(f"_m{KDE_TERMS - 1}"))
    part = F.when(F.abs(y) <= KDE_REACH, F.exp(F.lit(-0.5) * y * y) * poly).otherwise(0.0)
    out = near.groupBy(*own, "_g0", "_step", "i").agg(F.sum(part).alias("_s"))
    dens = F.col("_s") / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))
    return out.select(*groups, "i", _r(F.col("_g0") + F.col("i") * F.col("_step")).alias("x"),
                      _r(dens * F.col("_n") * (F.col("_mx") - F.col("_mn")) / bins, 4).alias("count_density"))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """O-AG-20: pairwise-complete Pearson correlations, lower triangle: one aggregate
    with sums for each pair, over one scan.  A zero variance gives null."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    aggs = []
    for k, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        aggs.append(F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias(f"_c{k}"))
    stack = ", ".join(f"'{a}', '{b}', _c{k}" for k, (a, b) in enumerate(pairs))
    long = df.agg(*aggs).selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)")
    return long.select("col_a", "col_b", _r(F.when(~F.isnan("corr"), F.col("corr"))).alias("corr"))


def corr_top(matrix: DataFrame, k: int = 10) -> DataFrame:
    """O-AG-21: the k highest and k lowest pairs of the full matrix (both directions,
    as pandas' unstack lists them), self pairs and undefined values dropped.  The
    matrix is evaluated once; it has a row per pair of columns."""
    pair = F.explode(F.array(F.struct(F.col("col_a").alias("a"), F.col("col_b").alias("b")), F.struct(F.col("col_b").alias("a"), F.col("col_a").alias("b"))))
    both = (matrix.filter(F.col("corr").isNotNull() & (F.col("corr") != 1.0)).select(pair.alias("p"), "corr")
            .withColumn("up", F.row_number().over(Window.orderBy(F.col("corr").desc(), "p.a", "p.b")))
            .withColumn("down", F.row_number().over(Window.orderBy(F.col("corr").asc(), "p.a", "p.b"))))
    ends = F.array_compact(F.array(F.when(F.col("up") <= k, F.lit("positive")), F.when(F.col("down") <= k, F.lit("negative"))))
    return both.select(F.explode(ends).alias("direction"), F.col("p.a").alias("col_a"), F.col("p.b").alias("col_b"), "corr")


def linear_fit(df: DataFrame, pairs: list[tuple[str, str, Column | None]]) -> DataFrame:
    """O-AG-22: slope, intercept and r² of y on x for each pair (optional row filter)."""
    aggs, names = [], []
    for k, (x, y, cond) in enumerate(pairs):
        yy = F.col(y).cast("double") if cond is None else F.when(cond, F.col(y).cast("double"))
        xx = F.col(x).cast("double") if cond is None else F.when(cond, F.col(x).cast("double"))
        aggs += [F.regr_slope(yy, xx).alias(f"_s{k}"), F.regr_intercept(yy, xx).alias(f"_i{k}"),
                 F.regr_r2(yy, xx).alias(f"_r{k}"), F.regr_count(yy, xx).alias(f"_n{k}")]
        names.append((x, y))
    one = df.agg(*aggs)
    stack = ", ".join(f"'{x}', '{y}', _s{k}, _i{k}, _r{k}, _n{k}" for k, (x, y) in enumerate(names))
    long = one.selectExpr(f"stack({len(names)}, {stack}) AS (x, y, slope, intercept, r2, n)")
    return long.select("x", "y", _r("slope"), _r("intercept", 4), _r("r2"), F.col("n").cast("long").alias("n"))
