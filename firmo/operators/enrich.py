"""Enrichment as Spark jobs (O-EN-*): parse fetched pages and model responses
that are already landed as tables, and merge what they yield."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from firmo.functions.numeric import parse_count, parse_revenue_text, parse_year
from firmo.functions.text import is_missing_text
from firmo.operators.joins import merge_missing_fields
from firmo.operators.numbering import batch_ids  # noqa: F401  (re-exported: O-EN-05)
from firmo.operators.setops import recombine

# The ordered country list searched in a headquarters text, and
# how two spellings are folded.
HQ_COUNTRIES = ["USA", "United States", "US", "UK", "United Kingdom", "Canada",
                "Germany", "France", "Japan", "China", "India", "Australia"]
HQ_COUNTRY_FOLD = {"United States": "USA", "US": "USA", "United Kingdom": "UK"}

def country_from_text(c: Column) -> Column:
    """O-EN-04: first country of the ordered list contained in the text (case-sensitive)."""
    out = None
    for name in HQ_COUNTRIES:
        label = F.lit(HQ_COUNTRY_FOLD.get(name, name))
        out = F.when(c.contains(name), label) if out is None else out.when(c.contains(name), label)
    return out


class _InfoTable(HTMLParser):
    """Rows of the first table of class ``infobox``: (label, value, first link) of
    each row, at any depth of nesting, with its first header and data cell."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth = 0                      # open tables, from the info table on
        self.done = False
        self.rows: list[dict] = []
        self.open: list[dict] = []          # open rows, innermost last

    def _close_rows(self):
        """Rows of the innermost table end with the next row or their table."""
        while self.open and self.open[-1]["depth"] == self.depth:
            self.open.pop()

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        if self.done:
            return
        if tag == "table":
            if self.depth or "infobox" in (at.get("class") or "").split():
                self.depth += 1
        elif self.depth and tag == "tr":
            self._close_rows()
            self.open.append({"depth": self.depth, "th": None, "td": None, "href": None, "in": None})
            self.rows.append(self.open[-1])
        elif self.depth and tag in ("th", "td"):
            for row in self.open:
                if row["in"] and row["in"][1] == self.depth:      # cells close one another
                    row["in"] = None
                # the first such cell below a row counts for it, its own or a nested one
                if row[tag] is None and row["in"] is None:
                    row[tag], row["in"] = [], (tag, self.depth)
        elif self.depth and tag == "a" and at.get("href"):
            for row in self.open:
                if row["in"] and row["in"][0] == "td" and row["href"] is None:
                    row["href"] = at["href"]

    def handle_endtag(self, tag):
        if self.done or not self.depth:
            return
        if tag in ("th", "td"):
            for row in self.open:
                if row["in"] == (tag, self.depth):
                    row["in"] = None
        elif tag == "tr":
            self._close_rows()
        elif tag == "table":
            self._close_rows()
            self.depth -= 1
            self.done = self.depth == 0

    def handle_data(self, data):
        text = data.strip()
        if self.depth and not self.done and text:
            for row in self.open:
                if row["in"]:
                    row[row["in"][0]].append(text)


def infobox_rows(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, label, value, href) for each row of a page's first info table that
    has a header and a data cell.  Tags nest, which patterns cannot follow, so
    batches of pages go through the standard library's HTML parser."""
    kind = dict(pages.dtypes)[key]

    def run(batches):
        for b in batches:
            out = []
            for k, text in zip(b[key], b[html], strict=True):
                p = _InfoTable()
                p.feed(text or "")
                p.close()
                for pos, r in enumerate(p.rows):
                    if r["th"] is not None and r["td"] is not None:
                        out.append((k, pos, "".join(r["th"]).lower(), "".join(r["td"]), r["href"]))
            yield pd.DataFrame(out, columns=[key, "pos", "label", "value", "href"])

    return pages.select(key, html).mapInPandas(run, f"`{key}` {kind}, pos int, label string, value string, href string")


def extract_infobox(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """O-EN-01: domain, industry, founded year, employees, revenue and country from a
    page's info table.  A later row of the same field overwrites an earlier one,
    but a web row without a link leaves a domain that is already known; of the
    headquarters and location rows the last that names a listed country wins.
    Rows are grouped per page, so each group is one page's table."""
    r = infobox_rows(pages, key, html)
    lab, val = F.col("label"), F.col("value")
    link = F.lower(F.nullif(F.regexp_extract("href", r"https?://(?:www\.)?([^/]+)", 1), F.lit("")))
    field = (F.when(lab.contains("web"), F.lit("domain"))
              .when(lab.contains("industry") | lab.contains("sector"), F.lit("industry"))
              .when(lab.contains("founded") | lab.contains("foundation"), F.lit("founded_year"))
              .when(lab.contains("employees") | lab.contains("workforce"), F.lit("employee_count"))
              .when(lab.contains("revenue"), F.lit("revenue")))
    t = r.select(key, "pos", field.alias("f"), val.alias("value"), link.alias("link"),
                 F.when(lab.contains("headquarters") | lab.contains("location"), country_from_text(val)).alias("land"))
    is_ = lambda name: F.col("f") == name
    last = lambda expr, cond: F.max_by(expr, F.when(cond, F.col("pos")))
    first = lambda expr, cond: F.min_by(expr, F.when(cond, F.col("pos")))
    number = F.regexp_extract(F.regexp_replace("value", r"[^\d.,]", ""), r"([\d.,]+)", 1) != ""
    count = parse_count(F.col("value"))
    out = t.groupBy(key).agg(
        # the last link; without any, the first web row's text
        F.coalesce(last(F.col("link"), is_("domain") & F.col("link").isNotNull()),
                   first(F.lower("value"), is_("domain") & (F.col("value") != ""))).alias("domain"),
        last(F.col("value"), is_("industry")).alias("industry"),
        last(parse_year(F.col("value")).cast("long"), is_("founded_year")).alias("founded_year"),
        last(count, is_("employee_count") & count.isNotNull()).alias("employee_count"),
        last(parse_revenue_text(F.col("value")), is_("revenue") & number).alias("revenue"),
        last(F.col("land"), F.col("land").isNotNull()).alias("country"))
    return out.filter(F.coalesce(*[F.col(c).cast("string") for c in out.columns if c != key]).isNotNull())


def parse_json_responses(responses: DataFrame, batch_col: str = "batch_num",
                         text_col: str = "response_text") -> DataFrame:
    """O-EN-06: (company_name, founded_year) from JSON-object responses that may be
    wrapped in a ```json fence; unparsable responses are skipped; for a name in
    several batches the later batch wins."""
    t = F.trim(F.col(text_col))
    body = (F.when(t.contains("```json"), F.trim(F.split(F.split(t, "```json", 2).getItem(1), "```", 2).getItem(0)))
             .when(t.contains("```"), F.trim(F.split(t, "```", 3).getItem(1)))
             .otherwise(t))
    # years come as numbers, decimals or strings; one odd value must not lose the batch
    parsed = F.from_json(body, "map<string,string>")
    pairs = (responses.select(batch_col, parsed.alias("_m"))
             .filter(F.col("_m").isNotNull())
             .select(batch_col, F.explode("_m").alias("company_name", "_y"))
             .withColumn("founded_year", F.col("_y").try_cast("double").try_cast("int")))
    return pairs.groupBy("company_name").agg(F.max_by("founded_year", batch_col).alias("founded_year"),
                                            F.max(batch_col).alias(batch_col))


def enrich_missing(df: DataFrame, enrichment: DataFrame, key: str, required: list[str],
                   fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """O-EN-07: rows missing any ``required`` field take the enrichment's values
    for missing ``fields``; complete rows pass through.  Returns the recombined
    rows and a one-row frame of missing counts before and after."""
    missing = None
    for c in required:
        m = is_missing_text(c)
        missing = m if missing is None else (missing | m)
    complete = df.filter(~missing)
    todo = df.filter(missing)
    enriched = merge_missing_fields(todo, enrichment, key, fields)
    out = recombine(complete, enriched)
    counts = [F.count_if(is_missing_text(c)).alias(f"missing_{c}") for c in required]
    before = df.agg(*counts).select(F.lit("before").alias("stage"), "*")
    after = out.agg(*counts).select(F.lit("after").alias("stage"), "*")
    return out, before.unionByName(after)
