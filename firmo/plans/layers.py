"""raw -> bronze -> marts, each a ``DataFrame -> DataFrame`` function (O-MD-*).

Raw and mart layers are written as tables by ``sources.sinks.materialize_layer``;
bronze layers stay lazy (views), as in the reference's project layout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from firmo.functions.keys import metric_key
from firmo.operators import clean, dedup, joins
from firmo.params import DEFAULT, RunParams
from firmo.schemas import RAW_DIM_COLUMNS
from firmo.sources import adapter


def _attr_defaults(df: DataFrame) -> DataFrame:
    """Ticker/sector/industry defaults; country stays raw until after the join (it is a join key)."""
    return (df.withColumn("ticker", F.coalesce("ticker", F.lit(clean.UNKNOWN)))
              .withColumn("sector", F.coalesce("sector", F.lit(clean.UNKNOWN)))
              .withColumn("industry", F.coalesce("industry", "industry_primary", F.lit(clean.UNKNOWN))))


def primary_best(stg_primary: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    return dedup.dedup_primary(_attr_defaults(clean.primary_dim_project(stg_primary, p)))


def secondary_best_match(stg_secondary: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    return dedup.dedup_secondary_match(_attr_defaults(clean.secondary_dim_project(stg_secondary, p)))


def secondary_best_alone(stg_secondary: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    return dedup.dedup_secondary_alone(_attr_defaults(clean.secondary_dim_project(stg_secondary, p)))


def raw_dim_companies(stg_primary: DataFrame, stg_secondary: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """O-MD-01: enrich the primary list with the secondary, add unmatched secondary rows,
    default unknowns, keep one row per (company_id, company_name).

    Each source is read once and reduced to its best rows per (name, country) by one
    partial aggregate (a hot key is one row per task before it moves), both picks
    of the secondary in the same pass; one full outer join on the key then holds
    the enriched rows and, on its other side, the unmatched ones."""
    keys = joins.KEY
    row = lambda df: F.struct(*[F.col(c) for c in df.columns if c not in keys])
    prim = _attr_defaults(clean.primary_dim_project(stg_primary, p))
    sec = _attr_defaults(clean.secondary_dim_project(stg_secondary, p))
    pb = prim.groupBy(*keys).agg(F.min_by(row(prim), dedup.primary_rank()).alias("p"))
    sb = sec.groupBy(*keys).agg(F.min_by(F.struct("website", "founded_year"), dedup.secondary_match_rank()).alias("m"),
                                F.min_by(row(sec), dedup.secondary_alone_rank()).alias("a"))
    both = pb.join(sb, keys, "full")
    known = F.col("p").isNotNull()
    pick = {c: F.when(known, F.col(f"p.{c}")).otherwise(F.col(f"a.{c}")) for c in prim.columns if c not in keys}
    pick["website"] = F.when(known, F.coalesce("p.website", "m.website")).otherwise(F.col("a.website"))
    pick["founded_year"] = F.when(known, F.coalesce("m.founded_year", "p.founded_year")).otherwise(F.col("a.founded_year"))
    unioned = both.select(*[(F.col(c) if c in keys else pick[c]).alias(c) for c in prim.columns])
    return (clean.default_unknown(unioned)
            .withColumn("dim_created_at", F.lit(p.run_ts.isoformat(sep=" ")).cast("timestamp_ntz"))
            .select(*RAW_DIM_COLUMNS))


def raw_fct_company_metrics(stg_primary: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """O-MD-02."""
    return dedup.dedup_fct(clean.raw_fct_project(stg_primary, p))


def bronze_dim_companies(raw_dim: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """O-MD-03."""
    return clean.bronze_dim_clean(raw_dim, p)


def bronze_fct_company_metrics(raw_fct: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """O-MD-04."""
    return clean.bronze_fct_clean(raw_fct, p)


def bronze_dim_founder(stg_primary: DataFrame, stg_secondary: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """O-MD-05: founders from the primary list, one row per id.  The secondary source
    names no founders (its branch of the model yields no rows)."""
    nb = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c)) != "")
    is_founder = F.upper(F.trim("founder_is_ceo")) == "YES"   # quirk Q5: case-insensitive
    prim = (stg_primary.filter(is_founder & nb("ceo") & nb("company"))
            .select(metric_key("company", "ticker", "country").alias("id"),
                    F.trim(F.upper("company")).alias("company_name"),
                    F.trim("ceo").alias("founder_name")))
    return (dedup.dedup_founder(prim).filter(F.col("founder_name").isNotNull())
            .withColumn("bronze_processed_at", F.lit(p.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")))


def unified_companies(bronze_dim: DataFrame, bronze_fct: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """O-MD-06 (flagship): latest metrics per company joined to the dimension by name."""
    joined = joins.mart_join(bronze_dim, joins.latest_metrics(bronze_fct))
    return clean.mart_project(joined, p).filter(F.col("company_name").isNotNull())


@dataclass
class Layers:
    """All layers of one run over the given tables (lazy)."""
    stg_primary: DataFrame
    stg_secondary: DataFrame
    params: RunParams = DEFAULT

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, p: RunParams = DEFAULT) -> "Layers":
        return cls(adapter.stg_primary(spark, sf_dir), adapter.stg_secondary(spark, sf_dir), p)

    @property
    def raw_dim(self) -> DataFrame:
        return raw_dim_companies(self.stg_primary, self.stg_secondary, self.params)

    @property
    def raw_fct(self) -> DataFrame:
        return raw_fct_company_metrics(self.stg_primary, self.params)

    @property
    def bronze_dim(self) -> DataFrame:
        return bronze_dim_companies(self.raw_dim, self.params)

    @property
    def bronze_fct(self) -> DataFrame:
        return bronze_fct_company_metrics(self.raw_fct, self.params)

    @property
    def founders(self) -> DataFrame:
        return bronze_dim_founder(self.stg_primary, self.stg_secondary, self.params)

    @property
    def mart(self) -> DataFrame:
        return unified_companies(self.bronze_dim, self.bronze_fct, self.params)
