import pytest

from firmo.operators import aggregates as AG
from firmo.operators import topk as TK
from firmo.plans import serve as SV

MART = ("company_id string, company_name string, ticker string, fortune_rank int, domain string, industry string, "
        "industry_primary string, country string, headquarters_city string, ceo string, founded_year int, "
        "website string, employee_count long, revenue double, market_cap_updated_m double, "
        "revenue_percent_change double")


def mart(spark, rows):
    cols = [c.split()[0] for c in MART.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], MART)


ROWS = [
    dict(company_id="1", company_name="ACME 100%", industry="UNKNOWN", industry_primary=None, country="USA",
         employee_count=0, revenue=5e9, market_cap_updated_m=0.0, revenue_percent_change=50.0, fortune_rank=0,
         ceo="Jo Acme", founded_year=1900),
    dict(company_id="2", company_name="BETA", industry="", industry_primary="Retail", country=" UNKNOWN ",
         employee_count=100, revenue=None, market_cap_updated_m=10.0, revenue_percent_change=20.0, fortune_rank=3),
    dict(company_id="3", company_name="GAMMA", industry="Tech", country="", employee_count=300, revenue=1e6,
         market_cap_updated_m=30.0, revenue_percent_change=-5.0, fortune_rank=None, founded_year=0),
    dict(company_id="4", company_name="DELTA", industry="Tech", country="UK", employee_count=None, revenue=2e6,
         market_cap_updated_m=None, revenue_percent_change=None, ceo="Ann"),
]


def test_search_filters_literal_substring(spark):
    m = mart(spark, ROWS)
    assert [r.company_id for r in SV.search_companies(m, company_name="cme 100%").collect()] == ["1"]
    assert SV.search_companies(m, company_name="A_ME").count() == 0        # '_' is not a wildcard
    got = SV.search_companies(m, industry="Tech", min_employees=200).collect()
    assert [r.company_id for r in got] == ["3"]
    page, total = SV.search_page(m, page=2, page_size=2)
    assert [r.company_name for r in page.collect()] == ["DELTA", "GAMMA"] and total.first().total == 4
    with pytest.raises(ValueError):
        TK.paginate(m, page=1, page_size=101)
    assert [r.company_id for r in SV.search_name_or_ceo(m, "ann").collect()] == ["4"]


def test_statistics_exclusions_and_fallbacks(spark):
    m = mart(spark, ROWS)
    s = AG.export_statistics(m).first()
    assert (s.total_companies, s.total_countries, s.total_industries) == (4, 2, 2)    # USA, UK; Retail, Tech
    assert (s.companies_with_fortune_rank, s.companies_with_founded_year, s.companies_with_revenue) == (1, 1, 3)
    assert s.avg_employee_count == 200.0                                              # positive counts only
    g = AG.global_statistics(m).first()
    assert g.total_companies == 4 and g.oldest_company_year == 0 and g.newest_company_year == 1900
    dist = [(r.industry, r["count"]) for r in AG.industry_distribution(m).collect()]
    assert dist == [("Tech", 2), ("Retail", 1)]


def test_top_k_and_growth_decline(spark):
    m = mart(spark, ROWS)
    assert [r.company_name for r in TK.top_market_cap6(m).collect()] == ["GAMMA", "BETA"]
    gd = [(r.label, r.direction) for r in TK.growth_and_decline(m).collect()]
    assert gd == [("BETA", "growth"), ("GAMMA", "decline")]                          # top grower left out
