"""Rules, routing and reasons on article rows."""

import re
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from quillsieve.functions import articles
from quillsieve.operators import route, rules
from quillsieve.plans.run import run
from quillsieve.sources.options import Options

BASE = {
    "title": "Builder opens bookings for a residential project in Manesar",
    "description": "The homes near Manesar come with new infrastructure and a metro corridor, said the developer.",
    "articleText": "Manesar gets a township with 400 flats.",
    "newsLink": "https://news.test/2026/manesar-homes",
    "thumbnailImage": "https://news.test/m.jpg",
    "postedBy": "Test Paper",
    "postedByLogo": "https://news.test/logo.png",
    "createdAt": "2026-06-20T00:00:00.000Z",
    "publishedAt": "2026-06-20T00:00:00.000Z",
    "fetchedAt": "2026-06-20T00:00:00.000Z",
}


def case(title, about, body, link="https://news.test/a"):
    return {"title": title, "description": about, "articleText": body, "newsLink": link}


#: changes to BASE, cities, label, whether published (None: not checked), reason pattern
CASES = [
    ({}, ["gurugram"], None, True, None),
    (case("Salary of M3M's CEO goes up by a fifth", "Shareholders agreed to higher pay at the realty firm.", "M3M builds homes."), ["gurugram"], "developer_corporate_positive", True, None),
    (case("BPTP sees Delhi-NCR as a core growth market", "The managing director wants to buy land for its next project.", "An interview."), ["gurugram", "faridabad"], "leadership_confidence", True, None),
    (case("Omaxe won a prize for its housing project in Neharpar", "The jury gave the award for a residential scheme in Greater Faridabad.", "A ceremony was held."), ["faridabad"], "project_development", True, None),
    (case("BPTP adds an office block in Noida", "The block is in Noida.", "A note on BPTP."), [], None, False, None),
    (case("Family bought a flat in The Arbour, Gurugram", "A transaction among the largest for premium real estate in Gurugram.", "It has five rooms."), ["gurugram"], "luxury_transaction", True, None),
    (case("HUDA offers plots in Faridabad", "Demarcation of Faridabad sites for commercial use is done.", "Sites in Faridabad.", "https://hsvphry.org.in/documents/notices/NEWS_202605010900_x.pdf"), ["faridabad"], "authority_pipeline", True, None),
    (case("Interchange at Sohna opens way for growth", "The interchange is good for property and infrastructure in Sohna.", "Cars pass faster."), ["gurugram"], "connectivity_catalyst", True, None),
    (case("DPR of a highway from Manesar to Neharpar via Noida is ready", "It ties Manesar, Neharpar and Noida together; development follows.", "A highway for Manesar and Neharpar."), ["faridabad", "gurugram"], None, True, None),
    (case("NCR office space in demand", "Firms took more office space in Delhi NCR, a study of the office market says.", "Office space only."), ["gurugram", "faridabad"], "ncr_office_market", True, None),
    (case("Noida International Airport means a boom for Faridabad", "Faridabad expects development from the airport; DLF and others watch.", "More homes in Faridabad are planned."), ["faridabad"], "faridabad_jewar_catalyst", True, None),
    (case("Pataudi is an investment destination for housing", "Real estate in Pataudi and its housing market did well.", "Pataudi's homes."), ["gurugram"], "positive_city_market", True, None),
    (case("Flats sell quicker than last year", "A study of residential sales.", "Homes in Delhi NCR sold well."), None, None, False, "no allowed city match"),
    (case("Broker accused of fraud over a flat in Pataudi", "He was arrested.", "An arrest in a fraud case."), None, "reject_negative", False, "negative/crime"),
    ({"title": "मानेसर में घर", "newsLink": "https://news.test/h"}, None, None, False, "non-English"),
    ({"title": "", "description": ""}, None, None, False, "missing title/link"),
    ({"thumbnailImage": "no address", "postedBy": ""}, ["gurugram"], None, False, r"missing required fields \(postedBy\).*invalid URL fields \(thumbnailImage\)"),
    (case("Chennai homes", "Housing in Chennai is up.", "Chennai."), None, None, False, "outside|no allowed city"),
]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [{**BASE, **change, "seq": i} for i, (change, *_) in enumerate(CASES)]
    df = spark.createDataFrame(rows)
    pack = rules.Pack.default()
    out = route.assign(articles.clean(articles.ensure(df)), pack)
    return {r.seq: r for r in out.select("seq", "cityCode", "rules.codes", "rules.label", rules.reasons(F.lit(False)).alias("reasons")).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(judged, i):
    _, codes, label, published, pattern = CASES[i]
    row = judged[i]
    if codes is not None:
        assert row.codes == codes
        assert row.cityCode == (codes[0] if codes else "")
    if label is not None:
        assert row.label == label
    if published is not None:
        assert (row.reasons == []) == published, row.reasons
    if pattern:
        assert re.search(pattern, "; ".join(row.reasons)), row.reasons


def test_opt_in_city(spark):
    change = case("Mahindra Lifespace launches homes in Yamuna Expressway area of Noida", "An investment of Rs 700 crore in a residential project in Noida.", "Homes in Noida.")
    df = spark.createDataFrame([{**BASE, **change, "seq": 0}])
    row = route.assign(articles.clean(articles.ensure(df)), rules.Pack.default(True)).select("rules.codes", rules.reasons(F.lit(False)).alias("reasons")).first()
    assert row.codes == ["noida"] and row.reasons == []


def test_run(spark):
    """Fan-out, sent state, date window, dedupe and order over one small batch."""
    region = CASES[2][0]
    rows = [
        {**BASE, "seq": 0},
        {**BASE, "seq": 1, "newsLink": "https://news.test/other"},  # same title
        {**BASE, **region, "seq": 2},
        {**BASE, "seq": 3, "title": "Bookings open for a residential project in Sohna", "newsLink": "https://news.test/sent"},
        {**BASE, "seq": 4, "title": "Bookings open for a residential project in Pataudi", "newsLink": "https://news.test/old", "publishedAt": "2025-01-01T00:00:00Z"},
    ]
    df = spark.createDataFrame(rows)
    sent = articles.ensure(spark.createDataFrame([rows[3]])).select(articles.link_id().alias("id"))
    out = run(df, sent, Options(), datetime(2026, 6, 25, tzinfo=UTC))
    chosen = out.chosen.select("seq", "cityCode").collect()
    assert [(r.seq, r.cityCode) for r in chosen] == [(0, "gurugram"), (2, "faridabad"), (2, "gurugram")]
    assert [(p.cityCode, p.createdAt) for p in out.payloads.collect()][-1] == ("gurugram", "2026-06-20T00:00:00.000Z")
    counts = {r.reason: r.n for r in out.reason_counts.collect()}
    assert counts == {rules.REASONS[13]: 1}
    assert [r.seq for r in out.date_excluded.collect()] == [4]
    assert out.push_counts.first().asDict() == {"n_shared": 2, "n_specific": 1}
    assert out.missed.count() == 0 and out.rejections.count() == 1
