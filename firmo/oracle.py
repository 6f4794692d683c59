"""Reference SQL (DuckDB dialect) for the correctness gate.

The statements say what the layers mean, over the given tables: a source's best
row of a key is the smallest tuple of its preferences, the dimension is the full
join of the two sources' best rows, facts and founders are smallest tuples of
their keys.  The Spark plans get there by windows and joins of their own.
"""

from __future__ import annotations

from firmo.operators.clean import FACT_SOURCE, PRIMARY_SOURCE, SECONDARY_DEFAULT_SOURCE, UNKNOWN
from firmo.sources.adapter import COUNTRY_SPELLINGS

AS_OF = "DATE '2001-06-30'"
RUN_TS = "TIMESTAMP '2001-07-01 00:00:00'"

_SPELLINGS = "[" + ", ".join(f"'{c}'" for c in COUNTRY_SPELLINGS) + "]"


def _yes(cond: str, a: str = "yes", b: str = "no") -> str:
    return f"if(coalesce({cond}, false), '{a}', '{b}')"


def _except(n: int, value: str) -> str:
    """``value``, but null for every n-th customer."""
    return f"if(k % {n} = 0, NULL, {value})"


_MOVED = _except(8, "CAST(k % 41 - 20 AS DOUBLE)")

#: staging columns of a customer, in order
_PRIMARY = {
    "rank": "row_number() OVER (ORDER BY rev DESC NULLS LAST, k)",
    "company": "CASE WHEN k % 62 = 0 THEN NULL WHEN k % 31 = 0 THEN '   ' WHEN k % 50 = 7 THEN ' Company Hub ' ELSE ' Company ' || g || ' ' END",
    "ticker": "if(k % 5 = 0, '', 'tk' || (k // 2))",
    "sector": "if(k % 11 = 0, '  ', seg || ' ' || (g % 3))",
    "industry": _except(7, "seg || ' services' || if(k % 4 = 0, ' ' || (g % 5), '')"),
    "profitable": _yes("k % 2 = 0"),
    "founder_is_ceo": _yes("k // 2 % 3 <> 1", " Yes "),
    "femaleceo": _yes("k % 9 = 0"),
    "growth_in_jobs": _except(10, _yes("k % 4 < 2")),
    "change_in_rank": _MOVED,
    "gained_in_rank": _yes(f"{_MOVED} > 0"),
    "dropped_in_rank": _yes(f"{_MOVED} < 0"),
    "newcomer_to_the_fortune500": _yes("k % 40 = 1"),
    "global500": _yes("k % 6 = 1", "YES"),
    "worlds_most_admired_companies": _yes("k % 12 = 3"),
    "best_companies_to_work_for": _yes("k % 15 = 4"),
    "number_of_employees": "CAST(CASE WHEN k % 13 = 0 THEN -1 WHEN k % 14 = 0 THEN NULL ELSE k % 1000 * 321 END AS BIGINT)",
    "marketcap_march28_m": "if(k % 4 = 1, NULL, bal * 9)",
    "revenues_m": "rev / 1000000",
    "revenuepercentchange": _except(17, "CAST(k % 400 - 200 AS DOUBLE) / 4"),
    "profits_m": "bal",
    "profitspercentchange": _except(16, "CAST(k % 304 - 152 AS DOUBLE) / 8"),
    "assets_m": "CAST(n_orders * 1.5 AS DOUBLE)",
    "ceo": _except(6, "'Ceo ' || k"),
    "country": f"CASE WHEN k % 29 = 0 THEN '' WHEN k % 37 = 0 THEN {_SPELLINGS}[k // 37 % 6 + 1] ELSE nation END",
    "headquarterscity": "'City ' || (k % 40)",
    "headquartersstate": _except(3, "'State ' || (k % 12)"),
    "website": "if(k % 9 = 0, '', 'HTTPS://www.Co' || k || '.com:8080/x')",
    "companytype": _except(18, _yes("k % 5 < 3", "Public", "Private")),
    "footnote": "if(k % 20 = 3, 'see note ' || (k % 7), NULL)",
    "marketcap_updated_m": "if(k % 4 = 0, NULL, bal * 10)",
    "updated": "CASE WHEN k % 6 >= 4 THEN if(g % 2 = 0, DATE '2000-02-29', NULL) WHEN k % 19 = 0 THEN DATE '1990-01-01' ELSE CAST(last_order AS DATE) END",
}
_SECONDARY = {
    "company_name": "CASE WHEN own THEN 'Indie ' || g || ' ' WHEN k % 50 = 7 THEN 'company hub' ELSE 'company ' || g END",
    "domain": "if(k % 12 = 5, NULL, 'http://www.Co' || k || '.net/about')",
    "industry": "if(k % 21 = 0, '', seg)",
    "country": f"CASE WHEN own THEN 'Land ' || (g % 7) WHEN k % 37 = 0 THEN lower({_SPELLINGS}[k // 37 % 6 + 1]) ELSE lower(nation) END",
    "employee_count": "CAST(if(k % 4 = 0, NULL, k % 5000) AS INTEGER)",
    "revenue": "if(k % 5 = 0, NULL, bal * 1000)",
    "founded_year": "CAST(CASE WHEN k % 10 = 0 THEN NULL WHEN k % 23 = 0 THEN 1066 ELSE 1850 + k % 170 END AS INTEGER)",
    "source_system": "CASE k % 8 WHEN 0 THEN '' WHEN 1 THEN 'kaggle: list' ELSE 'global' END",
    "last_updated_at": "CASE WHEN k % 5 = 3 THEN 'n/a' WHEN k % 2 = 0 THEN '2024-03-05T06:07:08.123456' ELSE '2024-03-0' || (k % 9 + 1) || 'T06:07:08' END",
}


def _columns(spec: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in spec.items())


STAGING = f"""
people AS (SELECT c_custkey AS k, c_custkey // 6 AS g, c_custkey % 6 IN (1, 2) AS own, c_mktsegment AS seg, c_acctbal AS bal, n_name AS nation
           FROM customer JOIN nation ON n_nationkey = if(c_custkey % 6 >= 4, c_custkey // 6 % 25, c_nationkey)),
bought AS (SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS rev, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders GROUP BY 1),
stg_primary AS (SELECT {_columns(_PRIMARY)} FROM people LEFT JOIN bought USING (k)),
stg_secondary AS (SELECT {_columns(_SECONDARY)} FROM people UNION ALL
                  SELECT s_name, NULL, NULL, n_name, NULL, s_acctbal, CAST(1900 + s_suppkey % 100 AS INTEGER), 'suppliers', '2024-01-02T03:04:05'
                  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def _norm(c: str) -> str:
    """Upper-cased and trimmed; null when nothing is left."""
    return f"nullif(trim(upper({c})), '')"


def _text(c: str) -> str:
    return f"nullif(trim({c}), '')"


def _md5(*parts: str) -> str:
    """Key of upper-cased parts; a missing part is empty."""
    return "md5(concat_ws('|', " + ", ".join(f"coalesce({_norm(p)}, '')" for p in parts) + "))"


#: columns of a dimension row, for either source
_DIM = ["company_id", "company_name", "ticker", "sector", "industry", "industry_primary", "industry_secondary", "country",
        "headquarters_city", "headquarters_state", "ceo", "website", "founded_year", "employee_count", "revenue",
        "source_system", "loaded_at"]
_NULLS = {"industry_secondary": "VARCHAR", "employee_count": "INTEGER", "revenue": "DOUBLE"}


def _dim(source: str, where: str, given: dict[str, str], kinds: dict[str, str]) -> str:
    cols = [f"{given[c]} AS {c}" if c in given else f"CAST(NULL AS {kinds.get(c, _NULLS.get(c, 'VARCHAR'))}) AS {c}" for c in _DIM]
    return f"SELECT {', '.join(cols)} FROM {source} WHERE {where}"


_DIM_P = _dim("stg_primary", _norm("company") + " IS NOT NULL", {
    "company_id": _md5("company", "country"), "company_name": _norm("company"), "ticker": _text("ticker"), "sector": _text("sector"),
    "industry": _text("industry"), "industry_primary": _text("industry"), "country": _norm("country"),
    "headquarters_city": _text("headquarterscity"), "headquarters_state": _text("headquartersstate"), "ceo": _text("ceo"),
    "website": _text("website"), "source_system": f"'{PRIMARY_SOURCE}'", "loaded_at": RUN_TS}, {"founded_year": "INTEGER"})
_WHEN = ("coalesce(" + ", ".join(f"try_strptime({_text('last_updated_at')}, '{f}')" for f in ("%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S"))
         + f", {RUN_TS})")
_DIM_S = _dim("stg_secondary", f"{_norm('company_name')} IS NOT NULL AND {_norm('country')} IS NOT NULL", {
    "company_id": _md5("company_name", "country"), "company_name": _norm("company_name"), "industry": _text("industry"),
    "industry_primary": _text("industry"), "country": _norm("country"), "website": _text("domain"), "founded_year": "founded_year",
    "source_system": f"coalesce({_text('source_system')}, '{SECONDARY_DEFAULT_SOURCE}')", "loaded_at": _WHEN}, {})
_KNOWN = (f"coalesce(ticker, '{UNKNOWN}') AS ticker, coalesce(sector, '{UNKNOWN}') AS sector, coalesce(industry, '{UNKNOWN}') AS industry")
_UNKNOWN_LAST = f"ticker = '{UNKNOWN}', sector = '{UNKNOWN}'"
_CLASS = "CASE WHEN source_system NOT LIKE 'kaggle:%' THEN 2 WHEN founded_year IS NULL THEN 1 ELSE 0 END"


def _best(source: str, preference: str, keys: str = "company_name, country") -> str:
    """One row per key: the one with the smallest preference tuple (nulls last)."""
    return f"SELECT unnest(best) FROM (SELECT arg_min(r, ({preference})) AS best FROM (SELECT r, unnest(r) FROM {source} r) GROUP BY {keys})"


_TAIL = "website, founded_year, industry, source_system"
RAW = f"""
dim_f AS ({_DIM_P}),
dim_g AS ({_DIM_S}),
known_f AS (SELECT * REPLACE ({_KNOWN}) FROM dim_f),
known_g AS (SELECT * REPLACE ({_KNOWN}) FROM dim_g),
pbest AS ({_best("known_f", f"{_UNKNOWN_LAST}, ticker, sector, industry, headquarters_city, headquarters_state, ceo, website")}),
smatch AS ({_best("known_g", f"founded_year IS NULL, -epoch_us(loaded_at), {_TAIL}")}),
salone AS ({_best("known_g", f"founded_year IS NULL, {_CLASS}, -epoch_us(loaded_at), {_TAIL}")}),
sources AS (SELECT p, m, a FROM pbest p FULL JOIN smatch m USING (company_name, country) LEFT JOIN salone a
            ON a.company_name = m.company_name AND a.country = m.country),
enriched_best AS (SELECT unnest(p), m.website AS m_website, m.founded_year AS m_founded FROM sources WHERE p.company_id IS NOT NULL),
unmatched_best AS (SELECT unnest(a) FROM sources WHERE p.company_id IS NULL),
both_best AS (SELECT * EXCLUDE (m_website, m_founded) REPLACE (coalesce(website, m_website) AS website, coalesce(m_founded, founded_year) AS founded_year)
              FROM enriched_best UNION ALL SELECT * FROM unmatched_best),
raw_dim AS (SELECT * EXCLUDE (employee_count, revenue) REPLACE (coalesce(country, '{UNKNOWN}') AS country), {RUN_TS} AS dim_created_at FROM both_best),
fct_src AS (SELECT {_md5("company", "ticker", "country")} AS company_id, {_norm("company")} AS company_name,
                   coalesce(rank, 0) AS fortune_rank, coalesce(number_of_employees, 0) AS employee_count,
                   coalesce(revenues_m, 0) * 1000000 AS revenue_millions, coalesce(revenuepercentchange, 0) AS revenue_percent_change,
                   coalesce(profits_m, 0) AS profits_m, coalesce(profitspercentchange, 0) AS profits_percent_change,
                   coalesce(assets_m, 0) AS assets_m, coalesce(marketcap_march28_m, 0) AS market_cap_march_m,
                   coalesce(marketcap_updated_m, 0) AS market_cap_updated_m, coalesce(updated, {AS_OF}) AS metric_date,
                   '{FACT_SOURCE}' AS source_system, {RUN_TS} AS loaded_at
            FROM stg_primary WHERE {_norm("company")} IS NOT NULL),
raw_fct AS ({_best("fct_src", "revenue_millions <= 0, employee_count <= 0, fortune_rank", "company_id, metric_date")})"""

BRONZE = f"""
bronze_dim AS (SELECT company_id, company_name, upper(ticker) AS ticker, sector, industry, industry_primary, nullif(country, '{UNKNOWN}') AS country,
                      headquarters_city, headquarters_state, ceo, lower(website) AS website,
                      if(founded_year BETWEEN 1800 AND year({AS_OF}), founded_year, NULL) AS founded_year,
                      source_system, loaded_at, dim_created_at FROM raw_dim),
bronze_fct AS (SELECT * EXCLUDE (market_cap_march_m) REPLACE (
                      if(fortune_rank BETWEEN 1 AND 1000, fortune_rank, NULL) AS fortune_rank,
                      if(employee_count >= 0, employee_count, NULL) AS employee_count,
                      if(revenue_millions >= 0, revenue_millions, NULL) AS revenue_millions,
                      if(metric_date BETWEEN {AS_OF} - INTERVAL 10 YEAR AND {AS_OF}, metric_date, {AS_OF}) AS metric_date) FROM raw_fct)"""

_METRICS = ["fortune_rank", "employee_count", "revenue_millions", "revenue_percent_change", "profits_m", "profits_percent_change",
            "assets_m", "market_cap_updated_m"]
MART = f"""
fct_latest AS (SELECT company_id, company_name, {", ".join(f"max({c}) AS {c}" for c in _METRICS)}, max(metric_date) AS latest_metric_date
               FROM bronze_fct GROUP BY ALL),
mart AS (SELECT d.company_id, company_name, ticker, fortune_rank, sector AS domain, industry, industry_primary, country, headquarters_city,
                headquarters_state, ceo, founded_year, website, employee_count, revenue_millions AS revenue, market_cap_updated_m,
                revenue_percent_change, profits_m, profits_percent_change, assets_m, source_system,
                coalesce(CAST(latest_metric_date AS TIMESTAMP), loaded_at) AS last_updated_at, {RUN_TS} AS mart_created_at
         FROM bronze_dim d LEFT JOIN fct_latest USING (company_name))"""

_FOUNDER = f"{_norm('company')} IS NOT NULL AND {_norm('founder_is_ceo')} = 'YES' AND {_text('ceo')} IS NOT NULL"
FOUNDERS = f"""
founders AS (SELECT {_md5("company", "ticker", "country")} AS id, min({_norm("company")}) AS company_name, min({_text("ceo")}) AS founder_name,
                    {RUN_TS} AS bronze_processed_at FROM stg_primary WHERE {_FOUNDER} GROUP BY 1)"""

CTES = "WITH " + ",".join([STAGING, RAW, BRONZE, MART, FOUNDERS])


def expectations_sql(table: str, expectations, columns: list[str], int_columns: set[str]) -> str:
    """SQL for ``quality.validate`` on ``table`` (columns known to the caller)."""
    parts = []
    for e in expectations:
        if e.optional and e.column not in columns:
            continue
        c = e.column
        if e.check == "exists":
            ok = c in columns
            parts.append(f"SELECT 'exists' AS \"check\", '{c}' AS \"column\", CAST(1 AS BIGINT) AS evaluated, "
                         f"CAST({0 if ok else 1} AS BIGINT) AS unexpected, CAST(1.0 AS DOUBLE) AS mostly")
        elif e.check == "not_null":
            parts.append(f"SELECT 'not_null', '{c}', count(*), count(*) FILTER (WHERE {c} IS NULL), "
                         f"CAST({e.mostly!r} AS DOUBLE) FROM {table}")
        elif e.check == "between":
            conds = []
            if e.min_value is not None:
                conds.append(f"{c} >= {e.min_value}")
            if e.max_value is not None:
                conds.append(f"{c} <= {e.max_value}")
            okx = " AND ".join(conds) or "TRUE"
            parts.append(f"SELECT 'between', '{c}', count({c}), count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({okx})), "
                         f"CAST({e.mostly!r} AS DOUBLE) FROM {table}")
        elif e.check == "type":
            bad = "0" if c in int_columns else f"count({c})"
            parts.append(f"SELECT 'type', '{c}', count({c}), CAST({bad} AS BIGINT), CAST({e.mostly!r} AS DOUBLE) FROM {table}")
        elif e.check == "unique":
            parts.append(f"SELECT 'unique', '{c}', CAST(coalesce(sum(n), 0) AS BIGINT), "
                         f"CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT), CAST({e.mostly!r} AS DOUBLE) "
                         f"FROM (SELECT {c}, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}) g")
    body = " UNION ALL ".join(parts)
    return ("SELECT \"check\", \"column\", evaluated, unexpected, "
            "round(CASE WHEN evaluated > 0 THEN unexpected / evaluated ELSE 0.0 END, 6) AS ratio, mostly, "
            "(1.0 - CASE WHEN evaluated > 0 THEN unexpected / evaluated ELSE 0.0 END) >= mostly - 1e-12 AS success "
            f"FROM ({body}) v")


def q(select: str) -> str:
    """A full oracle statement: all layer CTEs, then ``select``."""
    return CTES + "\n" + select
