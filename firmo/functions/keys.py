"""Surrogate keys: md5 over upper-cased, trimmed parts joined by ``|``.

A null part contributes ``''`` (Spark's ``concat`` would return null)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _part(c: Column, lower: bool = False) -> Column:
    f = F.lower if lower else F.upper
    return F.coalesce(f(F.trim(c)), F.lit(""))


def _key(*parts: Column) -> Column:
    items = []
    for i, p in enumerate(parts):
        if i:
            items.append(F.lit("|"))
        items.append(p)
    return F.md5(F.concat(*items))


def company_key(name: Column | str, country: Column | str) -> Column:
    """Dimension key: md5(NAME|COUNTRY)."""
    return _key(_part(F.col(name) if isinstance(name, str) else name),
                _part(F.col(country) if isinstance(country, str) else country))


def metric_key(name: Column | str, ticker: Column | str, country: Column | str) -> Column:
    """Fact / founder key: md5(NAME|TICKER|COUNTRY)."""
    c = [F.col(x) if isinstance(x, str) else x for x in (name, ticker, country)]
    return _key(_part(c[0]), _part(c[1]), _part(c[2]))


def founder_key(name: Column | str, domain: Column | str, country: Column | str) -> Column:
    """Key of the secondary founder branch: md5(NAME|domain|COUNTRY)."""
    c = [F.col(x) if isinstance(x, str) else x for x in (name, domain, country)]
    return _key(_part(c[0]), _part(c[1], lower=True), _part(c[2]))
