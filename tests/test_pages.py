"""Offer cards, links and sources on small pages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from offerweave.functions import vocab
from offerweave.operators import pages, scope

CARD = """<div data-role="jobs:thumb"{id}>
  <div>
   <a href="{href}"><h2>Data Engineer</h2></a>
   <div><span>Acme</span></div>
   <p>Short description</p>
   <div><div>CDI</div><div>Paris</div><div>Télétravail fréquent</div><div>Salaire : 45K à 55K €</div><div>120 collaborateurs</div><div>Logiciels</div></div>
   <time>hier</time>
  </div>
 </div>"""
GOOD = "/fr/companies/acme/jobs/data-engineer_paris"
PAGE = (
    '<div class="jobs-results-list">'
    + CARD.format(id=' data-object-id="ID1"', href=GOOD)
    + CARD.format(id="", href=GOOD)
    + CARD.format(id=' data-object-id="ID2"', href="/fr/pages/other")
    + CARD.format(id=' data-object-id="ID1"', href=GOOD)
    + '</div><a href="?page=2">2</a><a href="?page=7">7</a>'
)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, "https://x/?page=3", PAGE), (2, None, None), (3, "u", "<p>no cards</p>")], "page_id long, url string, html string")


def test_cards(table):
    got = {r["external_id"]: r for r in pages.offer_cards(table, "https://site").collect()}
    assert set(got) == {"ID1", "data-engineer_paris"}
    card = got["ID1"].asDict()
    expected = {
        "title": "Data Engineer", "company": "Acme", "description": "Short description", "contract_type": "CDI", "location": "Paris", "remote_policy": "Télétravail fréquent",
        "salary": "45K à 55K €", "company_size": "120 collaborateurs", "sector": "Logiciels", "published_at": "hier", "url": "https://site" + GOOD,
    }
    assert {k: card[k] for k in expected} == expected


def test_cards_end_at_their_own_end_tag(spark):
    """Nested divs, a card within a card's noise, tags left open, and what follows a card."""
    deep = "<div>" * 300
    odd = (
        "<div data-role='jobs:thumb' data-object-id=' A '>" + deep + f"<a href='{GOOD}'><h2>In<b>side</b></h2></a><section><span>Firm</span></section><p>d &amp; e"
        "</p><ul><div>x</div></ul>" + "</div>" * 301 + f"<a href='{GOOD}2'><h2>After</h2></a>"
        f"<div data-role='jobs:thumb'><p>open<div><a href='{GOOD}3'><h2>B</h2></a><div>no firm</div></div>"
    )
    df = spark.createDataFrame([(1, odd), (2, "<div data-role='jobs:thumb'>"), (3, ""), (4, None)], "page_id long, html string")
    got = {r["external_id"]: (r["title"], r["company"], r["description"], r["contract_type"], r["location"]) for r in pages.offer_cards(df, "https://s").collect()}
    assert got == {"A": ("In side", "Firm", "d & e", "x", ""), "data-engineer_paris3": ("B", "", "", "", "")}


def test_links_and_numbers(table):
    assert [r["href"] for r in pages.links(table, vocab.OFFER_HREF_PATTERN).collect()] == [GOOD]
    assert {r["page_id"]: r["last_page"] for r in pages.last_page(table, vocab.PAGE_NUMBER_PATTERN).collect()} == {1: 7, 2: None, 3: None}
    assert [r[0] for r in table.orderBy("page_id").select(F.coalesce(pages.has_cards(F.col("html")), F.lit(False))).collect()] == [True, False, False]


def test_source_selection():
    assert scope.selected(skip=("bpce",)) == tuple(s for s in vocab.COLLECT_SOURCES if s != "bpce")
    with pytest.raises(ValueError):
        scope.selected(only=("bpce",), skip=("bpce",))
    with pytest.raises(ValueError):
        scope.selected(only=("nowhere",))
