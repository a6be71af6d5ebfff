"""Text cleaning and matching as native column expressions."""

from __future__ import annotations

import html
import json
import sys
import unicodedata
import zlib
from collections.abc import Mapping, Sequence
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.functions import vocab

# Python's str whitespace, wider than Java's default \s
SPACES = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
_SPACE = r"[\x1c\x1d\x1e\x1f\p{IsWhite_Space}]"
# runs of whitespace but for one plain space, which stays as it is
_SPACE_RUN = rf"{_SPACE}(?:{_SPACE}+|(?<! ))"
# characters listed one by one are a single table to the regex engine, ranges are tested in turn
_BLANK = "[^ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/&\\-]"
_BLANKED = f"{_BLANK}(?:{_BLANK}+|(?<! ))"
_HASHED = 1024  # parts of a table that is looked up by hash
_KEPT = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+/&-")
LIST_MARK = "\x01"


def text(c: Column) -> Column:
    """Any value as text, null as ''."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACES))


def squash(c: Column) -> Column:
    """Collapse whitespace runs and trim."""
    return F.trim(F.regexp_replace(c, _SPACE_RUN, " "))


def truthy(c: Column) -> Column:
    """null when empty, else the text itself (not trimmed)."""
    return F.nullif(c.cast("string"), F.lit(""))


def or_chain(*cols: Column) -> Column:
    """First value that is neither null nor ''; null when there is none."""
    return F.coalesce(*[truthy(c) for c in cols])


def first_non_blank(*cols: Column) -> Column:
    """First value that is not blank once stripped, else ''."""
    return F.coalesce(*[F.nullif(strip(c.cast("string")), F.lit("")) for c in cols], F.lit(""))


@lru_cache(maxsize=1)
def _entity_tables() -> tuple[str, str, str]:
    """JSON maps from the standard library: named entities, those that need no semicolon, and numbers that mean another character."""
    legacy = {k: v for k, v in html5.items() if not k.endswith(";")}
    numbers = {str(n): c for n in range(0xA0) if (c := html.unescape(f"&#{n};")) != chr(n)}
    return _hashed(html5), _hashed(legacy), json.dumps(numbers)


def _hashed(table: Mapping[str, str]) -> str:
    """JSON list of maps, each key in the one that its hash names: Spark looks keys of a map up one after another."""
    out: list[dict[str, str]] = [{} for _ in range(_HASHED)]
    for k, v in table.items():
        out[zlib.crc32(k.encode()) % _HASHED][k] = v
    return json.dumps(out)


def _looked_up(table: str, key: Column) -> Column:
    part = F.get(F.from_json(F.lit(table), "array<map<string,string>>"), F.pmod(F.crc32(key.cast("binary")), F.lit(_HASHED)).cast("int"))
    return F.element_at(part, key)


def _character(n: Column) -> Column:
    """The character of a code point as HTML reads it; '' for those that mean none."""
    known = F.element_at(F.from_json(F.lit(_entity_tables()[2]), "map<string,string>"), n.cast("string"))
    none = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    own = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return F.coalesce(known, F.when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), "\ufffd").when(none, "").otherwise(own))


def _entity(part: Column) -> Column:
    """What follows an ampersand, decoded; with the ampersand where it begins no entity."""
    named, legacy, _ = _entity_tables()
    digits, hexed = F.regexp_extract(part, r"\A#0*([0-9]+);?", 1), F.regexp_extract(part, r"\A#[xX]0*([0-9a-fA-F]+);?", 1)
    after = F.regexp_replace(part, r"\A#(?:[0-9]+|[xX][0-9a-fA-F]+);?", "")
    # more digits than any character has
    code = F.when(digits != "", F.when(F.length(digits) > 7, F.lit(0x110000)).otherwise(digits.try_cast("int"))).otherwise(
        F.when(F.length(hexed) > 6, F.lit(0x110000)).otherwise(F.conv(hexed, 16, 10).try_cast("int"))
    )
    none = F.concat(F.lit("&"), part)

    def by_name(name: Column) -> Column:
        found = [F.concat(_looked_up(named, name), F.substr(part, F.length(name) + 1))]
        for n in range(6, 1, -1):  # the longest name without semicolon that it begins with
            found.append(F.when(F.length(name) > n, F.concat(_looked_up(legacy, F.substr(part, F.lit(1), F.lit(n))), F.substr(part, F.lit(n + 1)))))
        return F.when(name == "", none).otherwise(F.coalesce(*found, none))

    number = F.when((digits != "") | (hexed != ""), F.concat(_character(code), after)).otherwise(none)
    return F.when(part.startswith("#"), number).otherwise(let(F.regexp_extract(part, r"\A([^\t\n\f <&#;]{1,32};?)", 1), by_name))


def unescape(c: Column) -> Column:
    """HTML entities decoded once, as the standard library does."""
    return F.when(
        c.contains("&"), let(F.split(c, "&"), lambda parts: F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), _entity), "")))
    ).otherwise(c)


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is referred to."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def staged(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``columns`` alone, computed once whatever is made of them later.

    The optimizer may neither repeat what a random number decides about nor move filters below it, so that long
    expressions aren't written out again wherever their column is used.
    """
    return df.select(F.when(F.rand(0) < 2, F.struct(*[c.alias(n) for n, c in columns.items()])).alias("stage")).select("stage.*")


def held(c: Column) -> Column:
    """``c`` in a way that no filter on it is moved below the projection that makes it, where it would be written out anew for each use.

    The optimizer tells by itself that a random number is below a literal of 1 or more, but not of a sum.
    """
    return F.when(F.rand(0) + 1 < 3, c)


def clean_stage(df: DataFrame, cols: Mapping[str, Column], again: Sequence[str] = ()) -> DataFrame:
    """Add cleaned text columns: entities decoded, whitespace collapsed, null as ''.

    Names in ``again`` also get ``<name>__re``, the text cleaned a second time, because
    matching cleans its input anew and double-escaped entities resolve only there.
    """
    names = list(cols)
    df = df.withColumns({f"__raw{i}": text(cols[n]) for i, n in enumerate(names)})
    # one expression for all columns; a random number keeps the optimizer from writing it out for each use
    once = F.transform(F.array(*[F.col(f"__raw{i}") for i in range(len(names))]), unescape)
    df = df.withColumn("__once", F.when(F.rand(0) < 2, once))
    if again:
        df = df.withColumn("__twice", F.when(F.rand(0) < 2, F.transform("__once", unescape)))
    out = {}
    for i, n in enumerate(names):
        out[n] = squash(F.col("__once")[i])
        if n in again:
            out[f"{n}__re"] = squash(F.col("__twice")[i])
    return df.withColumns(out).drop("__once", "__twice", *[f"__raw{i}" for i in range(len(names))])


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Per-character effect of casefold + NFKD + mark removal, from Unicode data.

    Returns (translate from, translate to, characters that expand to several). Characters
    that end as no kept letter are left out: they become a space later anyway.
    """
    single, expand, deleted = {}, {}, []
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        parts = unicodedata.normalize("NFKD", c.casefold())
        base = "".join(p for p in parts if not unicodedata.combining(p))
        kept = "".join(p if p in _KEPT else " " for p in base)
        if not base:
            deleted.append(c)
        elif kept.strip():
            (single if len(kept) == 1 else expand)[c] = kept
    return "".join(single) + "".join(deleted), "".join(single.values()), expand


def _swap(c: Column, table: Mapping[str, str]) -> Column:
    """Replace characters outside ASCII by table; the work follows the distinct ones that a text holds."""
    # one foldable node instead of a literal for each entry: plans with many folded columns stay small
    pairs = F.from_json(F.lit(json.dumps(table)), "map<string,string>")
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(r"([^\x00-\x7f])"), F.lit(1)))
    return F.aggregate(found, c, lambda acc, ch: F.replace(acc, ch, F.coalesce(F.element_at(pairs, ch), ch)))


def _if_not_ascii(c: Column, otherwise: Column) -> Column:
    return F.when(F.octet_length(c) != F.length(c), otherwise).otherwise(c)


def fold(c: Column) -> Column:
    """Cleaned text -> lower-case unaccented text made of [a-z0-9+/&-] and single spaces."""
    src, dst, expand = _fold_tables()
    # what translate leaves outside ASCII is rare, and looked up one character after another
    base = _if_not_ascii(c, let(F.translate(c, src, dst), lambda t: _if_not_ascii(t, _swap(t, expand))))
    # lower comes last: on ASCII alone it needs no locale rules
    return F.trim(F.lower(F.regexp_replace(base, _BLANKED, " ")))


@lru_cache(maxsize=1)
def _casefold_table() -> dict[str, str]:
    """Characters that casefold changes in another way than lower does."""
    return {c: c.casefold() for c in map(chr, range(0x80, sys.maxunicode + 1)) if c.casefold() != c.lower()}


def casefold(c: Column) -> Column:
    return F.lower(_if_not_ascii(c, _swap(c, _casefold_table())))


def signature(folded: Column, size: int = 6) -> Column:
    """First significant tokens of a folded text."""
    tokens = F.filter(
        F.split(folded, " "),
        lambda t: (F.length(t) > 1) & ~t.isin(*vocab.SIGNATURE_STOPWORDS),
    )
    return F.array_join(F.slice(tokens, 1, size), " ")


def canonical_url(cleaned: Column) -> Column:
    """scheme://host/path in canonical form; anything without scheme and host unchanged."""
    pattern = r"\A([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]+)([^?#]*)"
    scheme = F.lower(F.regexp_extract(cleaned, pattern, 1))
    host = F.lower(F.regexp_extract(cleaned, pattern, 2))
    raw_path = F.regexp_extract(cleaned, pattern, 3)
    path = F.when(
        scheme.isin(*vocab.PARAM_SCHEMES), F.regexp_replace(raw_path, r";[^/]*\z", "")
    ).otherwise(raw_path)
    path = F.rtrim(path, F.lit("/"))
    return F.when(
        scheme != "", F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path))
    ).otherwise(cleaned)


def slugify(c: Column) -> Column:
    """ASCII slug: accents dropped, other non-ASCII removed, the rest joined by '-'."""
    src, dst, expand = _slug_tables()
    plain = _if_not_ascii(c, F.regexp_replace(F.translate(_swap(c, expand), src, dst), r"[^\x00-\x7f]", ""))
    return F.trim(F.regexp_replace(F.lower(plain), "[^a-z0-9]+", "-"), F.lit("-"))


@lru_cache(maxsize=1)
def _slug_tables() -> tuple[str, str, dict[str, str]]:
    """NFKD then ASCII only; characters that give several are expanded."""
    single, several = {}, {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        base = unicodedata.normalize("NFKD", chr(cp)).encode("ascii", "ignore").decode("ascii")
        if base:
            (single if len(base) == 1 else several)[chr(cp)] = base
    return "".join(single), "".join(single.values()), several


def split_parts(cleaned: Column) -> Column:
    """Cleaned free text -> its parts joined by LIST_MARK, to be cleaned once more as one column."""
    return F.regexp_replace(cleaned, "[;,|/]+", LIST_MARK)


def parts_of(joined: Column) -> Column:
    """Cleaned joined parts -> list of non-blank texts."""
    return F.filter(F.transform(F.split(joined, LIST_MARK), squash), lambda s: s != "")


def distinct_by_key(items: Column, key) -> Column:
    """Keep items whose key (a function of the item) is non-blank and appears for the first time."""
    return let(
        F.struct(items.alias("items"), F.transform(items, key).alias("keys")),
        lambda s: F.filter(
            s["items"],
            lambda x, i: (F.get(s["keys"], i) != "") & (F.array_position(s["keys"], F.get(s["keys"], i)) == i + 1),
        ),
    )


def distinct_ignore_case(items: Column) -> Column:
    """Ordered distinct non-blank strings, compared without case."""
    return distinct_by_key(F.filter(F.transform(items, strip), lambda s: s != ""), casefold)


def fallback_id(own: Column, prefix: str, parts: Sequence[Column]) -> Column:
    """Own id, else prefix + 16 hex digits of SHA-1 over the non-blank parts, else ''."""
    joined = F.concat_ws(" | ", *[F.nullif(strip(text(p)), F.lit("")) for p in parts])
    made = F.when(joined == "", "").otherwise(
        F.concat(F.lit(prefix), F.substring(F.sha1(joined), 1, 16))
    )
    return F.when(own != "", own).otherwise(made)


def lenient_bool(c: Column, default: bool) -> Column:
    """Boolean words in French or English, else the default."""
    word = F.lower(strip(text(c)))
    return (
        F.when(word.isin(*vocab.TRUE_WORDS), True)
        .when(word.isin(*vocab.FALSE_WORDS), False)
        .otherwise(default)
    )


def _bounded(folded: Column) -> Column:
    """Every token surrounded by single spaces, joiners as tokens of their own."""
    return F.concat(F.lit(" "), F.regexp_replace(folded, "([+/&-])", " $1 "), F.lit(" "))


def keyword_hits(folded: Column, words: Sequence[str]) -> Column:
    """Number of distinct vocabulary entries found on word boundaries in a folded text.

    One-word entries are counted by one array intersection over the tokens; entries of
    several words by a substring test, since a folded text has single spaces only.
    """
    one_word = [w for w in words if " " not in w]
    phrases = [w for w in words if " " in w]

    def count(padded: Column) -> Column:
        total = F.lit(0)
        if one_word:
            tokens = F.split(padded, " ")
            total = total + F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in one_word])))
        for p in phrases:
            total = total + padded.contains(f" {p} ").cast("int")
        return total

    # bound once: a filter that is pushed below this column would else repeat the text for every phrase
    return let(_bounded(folded), count)
