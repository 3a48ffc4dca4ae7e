"""Queries held against their SQL on rows that the smallest tables don't have."""

import os

import duckdb
import pytest

from quillsieve.functions.html import read_page
from quillsieve.plans.queries import ORACLES, QUERIES
from quillsieve.sources import state
from quillsieve.sources.state import State
from tests.test_sources import NOW


@pytest.fixture
def held(spark, tmp_path):
    """Writes a table by SQL and holds a query on it against the query's own SQL."""

    def check(name, table, sql):
        con = duckdb.connect()
        con.execute("SET timezone = 'UTC'")
        path = os.path.join(tmp_path, f"{table}.parquet")
        con.execute(f"COPY ({sql}) TO '{path}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
        df = QUERIES[name](spark, str(tmp_path))
        columns = sorted(df.columns)
        got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
        want = con.execute(ORACLES[name])
        at = [[d[0] for d in want.description].index(c) for c in columns]
        assert got == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)
        return got

    return check


def test_state_without_a_bound(spark, tmp_path):
    for kept, n in ((3, 3), (None, 8)):
        s = State(spark, str(tmp_path / str(kept)), kept)
        s.add(spark.range(5).selectExpr("cast(id as string) id", "id as place"), NOW)
        s.add(spark.range(3, 8).selectExpr("cast(id as string) id", "id as place"), NOW)
        ids = [r.id for r in s.read().orderBy("seq").collect()]
        assert len(ids) == n and ids[-3:] == ["5", "6", "7"]


def test_recurring_runs_remember_more_than_a_bounded_state(held, monkeypatch):
    """A run that sends more ids than the bound repeats none of them later."""
    monkeypatch.setattr(state, "KEPT", 4)
    assert len(held("st_recurring_runs", "supplier", "SELECT range AS s_suppkey FROM range(30)")) > 4


#: Pages whose heading was cut within a reference.
CUT_PAGES = """SELECT range AS page_id, 'https://www.e.com/' || range AS url, '<html><head><script>a && b &amp</script></head><body><article><h1>Rates &amp;&amp; rules' || range || ' &amp</h1><p><b>Rates &amp; rules' || range || ' &amp</b>'
  || repeat(' more words &middot; here', 8) || '</p></article></body></html>' AS html FROM range(3)"""


def test_text_of_pages_with_cut_references(held):
    assert all("&&amp" not in text and "&ampRates" in text for _, text in held("x1_main_text", "pages", CUT_PAGES))


def test_titles_with_cut_references(held):
    assert ("Rates && rules1 &amp" in [title for _, title in held("x2_title", "pages", CUT_PAGES)])


def test_direct_articles_with_cut_references(held):
    assert len(held("s4_direct_articles", "pages", CUT_PAGES)) == 3


def test_references_without_a_semicolon_are_read_like_a_browser_unless_told():
    page = "<!-- <script> --><p>x &amp y &copy &lt;b &foo; &#65; &#65</p><a href='/x?a=1&amp;copy=2'>l</a>"
    assert read_page(page, fields=["text"]) == {"text": "x & y © <b &foo; A A"}
    got = read_page(page, fields=["text", "links"], closed_only=True)
    assert got["text"] == "x &amp y &copy <b &foo; A &#65" and got["links"][0]["href"] == "/x?a=1&copy=2"


def test_state_of_sendings(held):
    """A URL that comes twice is two of the newest sendings."""
    got = held("k2_sent_state", "pages", "SELECT range AS page_id, 'https://E.com/' || (range - CAST(range % 1000 = 999 AS INTEGER)) AS url FROM range(10020)")
    assert len(got) == 10_000 and len(set(got)) == 10_000 - 10
