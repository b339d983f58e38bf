"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import math
import os
from html.parser import HTMLParser
from urllib.parse import urljoin

import duckdb
import pytest

from quillspark.plans import catalog, lifecycle, readers  # noqa: F401 (these add their queries)

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    return round(x, 6) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_matches_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    found = duck.execute(catalog.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = [tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()]
    have = [tuple(plain(r[c]) for c in columns) for r in got.collect()]
    assert sorted(map(repr, have)) == sorted(map(repr, want))


class Words(HTMLParser):
    """Links, and words outside scripts and styles, of a page."""

    def __init__(self, page):
        super().__init__()
        self.links, self.words, self.off = [], [], False
        self.feed(page or "")
        self.close()

    def handle_starttag(self, tag, attrs):
        self.off = tag in ("script", "style")
        if tag in ("p", "li", "blockquote", "h1", "h2", "h3", "h4"):
            self.words.append(" ")
        self.links += [v for k, v in attrs if tag == "a" and k == "href" and v]

    def handle_endtag(self, tag):
        self.off = False
        if tag in ("p", "li", "blockquote", "h1", "h2", "h3", "h4"):
            self.words.append(" ")

    def handle_data(self, data):
        self.words += [] if self.off else [data]


def test_without_sql_links_and_text(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    links = {(r["page_id"], r["ord"], r["link"]) for r in catalog.QUERIES["q_html_links"](spark, SF).collect()}
    assert links == {(i, n, urljoin(r["url"], h)) for i, r in pages.items() for n, h in enumerate(Words(r["html"]).links)}
    texts = {r["page_id"]: r["text"] for r in catalog.QUERIES["q_html_text"](spark, SF).collect()}
    assert texts == {i: " ".join("".join(Words(r["html"]).words).split()) for i, r in pages.items()}


def test_without_sql_grants(spark):
    """Requests in order of time: open from 6 to 2, five grants a day, ten minutes apart."""
    rows = sorted((r["user_id"], r["ts"], math.floor(r["value"] * 100)) for r in spark.read.parquet(f"{SF}/events.parquet").collect())
    want, grants, last = [], {}, {}
    for source, ts, _ in rows:
        day = (source, ts.date())
        if 2 <= ts.hour < 6:
            decision = "operating_window"
        elif grants.get(day, 0) == 5:
            decision = "daily_budget"
        elif source in last and (ts - last[source]).total_seconds() < 600:
            decision = "delay"
        else:
            decision, last[source] = "grant", ts
            grants[day] = grants.get(day, 0) + 1
        want.append((source, ts, decision))
    got = [(r["source"], r["ts"], r["decision"]) for r in catalog.QUERIES["q_rate_limit_grants"](spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_all_without_sql_are_tested():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"q_html_links", "q_html_text", "q_rate_limit_grants"}


def test_pages_of_works_are_parsed_once(spark):
    plan = catalog.QUERIES["q_read_works"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("ArrowEvalPython") == 1
