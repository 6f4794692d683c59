"""Explicit schemas of the staging tables and layers."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, DT = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType()

# Staging table of the primary (ranked list) source: 32 columns.
STG_PRIMARY = T.StructType([
    T.StructField("rank", L), T.StructField("company", S), T.StructField("ticker", S),
    T.StructField("sector", S), T.StructField("industry", S),
    T.StructField("profitable", S), T.StructField("founder_is_ceo", S),
    T.StructField("femaleceo", S), T.StructField("growth_in_jobs", S),
    T.StructField("change_in_rank", D),
    T.StructField("gained_in_rank", S), T.StructField("dropped_in_rank", S),
    T.StructField("newcomer_to_the_fortune500", S), T.StructField("global500", S),
    T.StructField("worlds_most_admired_companies", S), T.StructField("best_companies_to_work_for", S),
    T.StructField("number_of_employees", L),
    T.StructField("marketcap_march28_m", D), T.StructField("revenues_m", D),
    T.StructField("revenuepercentchange", D), T.StructField("profits_m", D),
    T.StructField("profitspercentchange", D), T.StructField("assets_m", D),
    T.StructField("ceo", S), T.StructField("country", S), T.StructField("headquarterscity", S),
    T.StructField("headquartersstate", S), T.StructField("website", S),
    T.StructField("companytype", S), T.StructField("footnote", S),
    T.StructField("marketcap_updated_m", D), T.StructField("updated", DT),
])

# Staging table of the secondary (global list) source: 9 columns.
STG_SECONDARY = T.StructType([
    T.StructField("company_name", S), T.StructField("domain", S), T.StructField("industry", S),
    T.StructField("country", S), T.StructField("employee_count", I), T.StructField("revenue", D),
    T.StructField("founded_year", I), T.StructField("source_system", S),
    T.StructField("last_updated_at", S),
])

# Unified ingest schema: 7 fields + source and load time.
UNIFIED_FIELDS = ["company_name", "domain", "industry", "country",
                  "employee_count", "revenue", "founded_year"]
UNIFIED_META = ["source_system", "last_updated_at"]
UNIFIED_TYPES = {"company_name": S, "domain": S, "industry": S, "country": S,
                 "employee_count": D, "revenue": D, "founded_year": D,
                 "source_system": S, "last_updated_at": S}

RAW_DIM_COLUMNS = ["company_id", "company_name", "ticker", "sector", "industry",
                   "industry_primary", "industry_secondary", "country",
                   "headquarters_city", "headquarters_state", "ceo", "website",
                   "founded_year", "source_system", "loaded_at", "dim_created_at"]

RAW_FCT_COLUMNS = ["company_id", "company_name", "fortune_rank", "employee_count",
                   "revenue_millions", "revenue_percent_change", "profits_m",
                   "profits_percent_change", "assets_m", "market_cap_march_m",
                   "market_cap_updated_m", "metric_date", "source_system", "loaded_at"]

MART_COLUMNS = ["company_id", "company_name", "ticker", "fortune_rank", "domain", "industry",
                "industry_primary", "country", "headquarters_city", "headquarters_state",
                "ceo", "founded_year", "website", "employee_count", "revenue",
                "market_cap_updated_m", "revenue_percent_change", "profits_m",
                "profits_percent_change", "assets_m", "source_system",
                "last_updated_at", "mart_created_at"]
