"""Offer pages: links and page numbers by native expressions over whole HTML columns, cards by a small tree of each page."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.functions import text, vocab

HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(HREF), F.lit(1))


def links(pages: DataFrame, pattern: str) -> DataFrame:
    """page_id, position, href: distinct hrefs of each page that match, in their order."""
    found = F.array_distinct(F.filter(hrefs(F.col("html")), lambda h: h.rlike(pattern)))
    return pages.select("page_id", F.posexplode(found).alias("position", "href"))


def last_page(pages: DataFrame, number: str) -> DataFrame:
    """page_id, last_page: the largest page number among a page's own address and its hrefs; null where there is none."""
    all_links = F.concat(F.array(F.coalesce("url", F.lit(""))), hrefs(F.col("html")))
    numbers = F.transform(all_links, lambda h: F.nullif(F.regexp_extract(h, number, 1), F.lit("")).try_cast("bigint"))
    return pages.select("page_id", F.array_max(numbers).alias("last_page"))


def blocks(pages: DataFrame, tag: str) -> DataFrame:
    """page_id, position, label, words: each element of a kind as a card, its text without tags."""
    found = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(rf"(?is)<{tag}[^>]*>(.*?)</{tag}>"), F.lit(1))
    cards = pages.select("page_id", F.posexplode(found).alias("position", "inner"))
    plain = F.trim(F.regexp_replace(F.regexp_replace("inner", "<[^>]*>", " "), r"\s+", " "))
    return cards.select("page_id", "position", plain.alias("label"), F.length(plain).alias("chars"))


_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_OFFER = re.compile(vocab.OFFER_HREF_PATTERN.replace(r"\z", r"\Z"))
_WANTED = ("external_id", "title", "company", "description", "contract_type", "location", "remote_policy", "salary", "company_size", "sector", "published_at", "url")


class _Cards(HTMLParser):
    """Elements of one page as [tag, attributes, children, parent], each ending at its own end tag."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at = self.root = ["", {}, [], None]
        self.cards: list[list] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = [tag, dict(attrs), [], self.at]
        self.at[2].append(node)
        if tag == "div" and node[1].get("data-role") == "jobs:thumb":
            self.cards.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at[3]

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not None and node[0] != tag:
            node = node[3]
        if node is not None and node is not self.root:
            self.at = node[3]

    def handle_data(self, data: str) -> None:
        self.at[2].append(data)


def _all(node: list) -> Iterator:
    """Texts and elements below, in order."""
    waiting = list(reversed(node[2]))
    while waiting:
        x = waiting.pop()
        yield x
        if not isinstance(x, str):
            waiting.extend(reversed(x[2]))


def _text(node: list | None) -> str:
    return " ".join(t for x in _all(node) if isinstance(x, str) and (t := x.strip(text.SPACES))) if node else ""


def _under(node: list, tag: str) -> list | None:
    return next((x for x in _all(node) if not isinstance(x, str) and x[0] == tag), None)


def _card(card: list, base: str) -> tuple | None:
    """What a card says, by its place in it; None without a title in a link that leads to an offer."""
    inside = (x for x in _all(card) if not isinstance(x, str))
    title = next((x for x in inside if x[0] == "h2" and x[3][0] == "a" and x[3][3][0] == "div"), None)
    if title is None or "href" not in title[3][1]:
        return None
    href = (title[3][1]["href"] or "").strip(text.SPACES)
    if not _OFFER.search(href):
        return None
    body = title[3][3]
    parts = [x for x in body[2] if not isinstance(x, str)]
    meta = [m for x in parts[3][2] if not isinstance(x, str) and x[0] == "div" and (m := _text(x))] if len(parts) > 3 else []
    pay = [m for m in meta[3:] if "Salaire" in m]
    people = [m for m in meta[3:] if m not in pay and "collaborateur" in m.lower()]
    other = [m for m in meta[3:] if m not in pay and m not in people]
    last = lambda found: found[-1] if found else ""
    own = (card[1].get("data-object-id") or "").strip(text.SPACES)
    return (
        own or href.rsplit("/", 1)[-1], _text(title), _text(_under(parts[1], "span")) if len(parts) > 1 else "", _text(parts[2]) if len(parts) > 2 and parts[2][0] == "p" else "",
        *[meta[k] if len(meta) > k else "" for k in range(3)], last(pay).replace("Salaire :", "").strip(text.SPACES), last(people), other[0] if other else "", _text(_under(body, "time")), urljoin(base, href), own,
    )


def offer_cards(pages: DataFrame, base: str) -> DataFrame:
    """page_id, position and the fields of each offer card of ``pages`` (page_id, html).

    A card is a ``div data-role='jobs:thumb'`` up to its own end tag; its fields are told by their place below it: the
    title in a link, beside it the company, a description and a list of contract, place, remote policy and more. A card
    needs a link that leads to an offer. Its id falls back to the last part of that link; of cards of one page with one
    id of their own the first counts. Pages without cards, null and empty ones give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for page_id, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page, seen = _Cards(), set()
                page.feed(html)
                page.close()
                for position, card in enumerate(page.cards):
                    found = _card(card, base)
                    if found and not (found[-1] and found[-1] in seen):
                        seen.add(found[-1])
                        out.append((page_id, position, *found[:-1]))
            columns = list(zip(*out, strict=True)) or [()] * (2 + len(_WANTED))
            kinds = [pa.int64(), pa.int32(), *[pa.string()] * len(_WANTED)]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "position", *_WANTED])

    rows = pages.where(F.col("html").contains("jobs:thumb")).select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id long, position int, {', '.join(f'{c} string' for c in _WANTED)}")


def has_cards(html: Column) -> Column:
    return html.contains('data-role="jobs:thumb"') & html.contains("jobs-results-list")
