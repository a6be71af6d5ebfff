"""Mixing sources to target weights: budgets down a domain-language-source tree, then seeded token prefixes.

Budgets. Every leaf can give ``max_epochs`` times its tokens; every inner node what its children can. The root gets
``share`` of all tokens. A node's budget is dealt to its children by weight; a child that can't use its part takes
all it has, and what it leaves goes to its siblings by their weights. Only if all children are full does a node
itself fall short, and then its siblings get the rest: siblings before ancestors.

Selection. A leaf with budget b and t tokens gives b div t whole epochs, and of the next epoch, in an order drawn
from the seed, the documents that begin before its b mod t first tokens. The order is that of an MD5 of seed, epoch
and doc_id; its first hexadecimal digits cut a leaf into ``SLOTS`` slots, whose token sums say in which slot the
prefix ends. Only that one slot is ever sorted, so a leaf that holds a third of all rows costs no more than others.

Everything is DataFrame functions; amounts are whole numbers, so a plan is the same on every run.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerweave.llm.shared import Scratch, stored

SLOT_DIGITS = 3
SLOTS = 16**SLOT_DIGITS
SALTS = 16
WORD = r"[^\x20\x09-\x0D]+"
_WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class Mixture:
    """Weights are whole numbers, 1 where none is given; a node of weight 0 gives nothing."""

    domains: Mapping[str, str] = field(default_factory=dict)  # source to domain; others are in the domain "other"
    domain_weights: Mapping[str, int] = field(default_factory=dict)
    lang_weights: Mapping[str, int] = field(default_factory=dict)
    source_weights: Mapping[str, int] = field(default_factory=dict)
    share: tuple[int, int] = (1, 1)
    max_epochs: int = 1
    seed: int = 0


def _looked_up(key: Column, table: Mapping, default) -> Column:
    if not table:
        return F.lit(default)
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(default))


def leaves_of(docs: DataFrame, mix: Mixture) -> dict[str, Column]:
    """The tree's levels as columns of ``docs``; null counts as ''."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return {
        "__domain": _looked_up(source, mix.domains, "other"),
        "__lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        "__source": source,
    }


LEVELS = ("__domain", "__lang", "__source")


def _deal(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Children with weight, capacity and their parent's budget to the same with their own budget."""
    ratio = F.col("capacity").cast("double") / F.col("weight")
    by = Window.partitionBy(*parents)
    ordered = by.orderBy(ratio, "name")
    given = F.coalesce(F.sum("capacity").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing))
    rest = F.col("parent_budget") - given
    full = F.col("capacity").cast(_WIDE) * left <= F.col("weight").cast(_WIDE) * rest
    marked = nodes.where("weight > 0").withColumn("full", full)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(by), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(by)
    part = F.floor(F.col("weight").cast(_WIDE) * (F.col("parent_budget") - taken) / open_weight)
    # division is rounded: compare back so that the part is the exact floor
    wide = F.col("weight").cast(_WIDE) * (F.col("parent_budget") - taken)
    part = F.when(part.cast(_WIDE) * open_weight > wide, part - 1).otherwise(part)
    return marked.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(part).cast("long"))


def leaf_budgets(tokens: DataFrame, mix: Mixture, scratch: Scratch) -> DataFrame:
    """One row per leaf (the levels, tokens, budget) from rows with the levels and n_tokens."""
    leaves = tokens.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    leaves = scratch.stored(leaves.withColumn("capacity", F.col("tokens") * mix.max_epochs), "leaves")
    total = leaves.agg(F.floor(F.sum("tokens").cast(_WIDE) * mix.share[0] / mix.share[1]).cast("long").alias("parent_budget"))
    weights = dict(zip(LEVELS, (mix.domain_weights, mix.lang_weights, mix.source_weights), strict=True))
    above = total.withColumn("__root", F.lit(0))
    parents = ["__root"]
    for k, level in enumerate(LEVELS):
        nodes = leaves.withColumn("__root", F.lit(0)).groupBy(*parents, level).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", _looked_up(F.col(level), weights[level], 1).cast("long")).withColumn("name", F.col(level))
        dealt = _deal(nodes.join(above, parents), parents)
        parents = [*parents, level]
        above = dealt.select(*parents, F.col("budget").alias("parent_budget"))
    return leaves.join(above, list(LEVELS)).select(*LEVELS, "tokens", F.col("parent_budget").alias("budget"))


def _order(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def plan(docs: DataFrame, mix: Mixture) -> tuple[DataFrame, DataFrame]:
    """Slim rows (doc_id, the levels, n_tokens), and per leaf: tokens, budget, epochs, rest, end slot, tokens before it."""
    slim = docs.select("doc_id", F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"), *[c.alias(n) for n, c in leaves_of(docs, mix).items()])
    slim = stored(slim, "slim")
    with Scratch(docs.sparkSession) as scratch:
        budgets = leaf_budgets(slim, mix, scratch)
        epochs = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0)
        budgets = budgets.withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
        budgets = scratch.stored(budgets, "budgets")
        slots = _with_plan(slim, budgets).where("rest > 0").withColumn("slot", F.substring(_order(mix.seed, F.col("epochs")), 1, SLOT_DIGITS))
        slots = slots.groupBy(*LEVELS, "slot").agg(F.sum("n_tokens").alias("slot_tokens"), F.first("rest").alias("rest"))
        before = F.sum("slot_tokens").over(Window.partitionBy(*LEVELS).orderBy("slot")) - F.col("slot_tokens")
        ends = slots.withColumn("before", before).where("before < rest").groupBy(*LEVELS).agg(F.max(F.struct("slot", "before")).alias("end"))
        table = budgets.join(ends, list(LEVELS), "left").withColumns({"end_slot": F.col("end.slot"), "before": F.col("end.before")}).drop("end")
        return slim, stored(table, "plan")


def _with_plan(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with their leaf's columns; each leaf is joined in ``SALTS`` parts, as one may hold a third of all rows."""
    parts = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(SALTS)).cast("int"))
    return salted.join(parts, [*LEVELS, "__salt"]).drop("__salt")


def _selected(rows: DataFrame, table: DataFrame, mix: Mixture, tie: Column) -> DataFrame:
    """``rows`` (with the levels, doc_id and n_tokens) once for each epoch they are chosen in, with ``epoch``."""
    keyed = _with_plan(rows, table.drop("tokens", "budget")).withColumn("__at", _order(mix.seed, F.col("epochs"))).withColumn("__tie", tie)
    slot = F.substring("__at", 1, SLOT_DIGITS)
    sure = keyed.where(F.col("end_slot").isNull() | (slot != F.col("end_slot")))
    sure = sure.withColumn("__n", F.col("epochs") + F.coalesce(slot < F.col("end_slot"), F.lit(False)).cast("int"))
    edge = keyed.where(slot == F.col("end_slot"))
    ahead = F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("__at", "n_tokens", "__tie").rowsBetween(Window.unboundedPreceding, -1))
    begins = F.col("before") + F.coalesce(ahead, F.lit(0))
    edge = edge.withColumn("__n", F.col("epochs") + (begins < F.col("rest")).cast("int"))
    both = sure.unionByName(edge).where("__n > 0")
    return both.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n").cast("long") - 1)))


def mixed_rows(docs: DataFrame, mix: Mixture) -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, epoch (from 0): a row for each time a row of ``docs`` is taken.

    Tokens are white-space separated words; null texts have none, and such rows come along with their leaf at no
    cost. Null lang or source counts as ''. Repeated rows are rows of their own. An empty table gives none. Other
    columns aren't read.
    """
    slim, table = plan(docs, mix)
    out = _selected(slim, table, mix, F.lit(0))
    return out.select("doc_id", F.col("__domain").alias("domain"), F.col("__lang").alias("lang"), F.col("__source").alias("source"), "n_tokens", "epoch")


def mixed_documents(docs: DataFrame, mix: Mixture) -> DataFrame:
    """The same with all columns of ``docs`` (and no others): the documents to train on."""
    _, table = plan(docs, mix)
    names = docs.columns
    whole = docs.select(
        F.struct(*names).alias("__row"),
        "doc_id",
        F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"),
        *[c.alias(n) for n, c in leaves_of(docs, mix).items()],
    )
    return _selected(whole, table, mix, F.xxhash64(F.col("__row.text"))).select("__row.*")


def oracle(mix: Mixture) -> str:
    """The same as one DuckDB statement over ``documents``, written from the definition: no slots, one sort per leaf."""

    def case(column: str, table: Mapping, default) -> str:
        quoted = [(k, f"'{v}'" if isinstance(v, str) else v) for k, v in table.items()]
        body = " ".join(f"WHEN '{k}' THEN {v}" for k, v in quoted)
        default = f"'{default}'" if isinstance(default, str) else default
        return f"CASE {column} {body} ELSE {default} END" if body else str(default)

    parts = [
        "w AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, "
        f"{case("coalesce(source, '')", mix.domains, 'other')} AS domain, "
        "CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents)",
        f"leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {mix.max_epochs} AS capacity FROM w GROUP BY ALL)",
        f"b0 AS (SELECT sum(tokens) * {mix.share[0]} // {mix.share[1]} AS parent_budget FROM leaf)",
    ]
    above, keys = "b0", []
    for k, (level, weights) in enumerate((("domain", mix.domain_weights), ("lang", mix.lang_weights), ("source", mix.source_weights)), 1):
        by = ("PARTITION BY " + ", ".join(keys)) if keys else ""
        joined = f"JOIN {above} USING ({', '.join(keys)})" if keys else f"CROSS JOIN {above}"
        mine = ", ".join([*keys, level])
        parts += [
            f"n{k} AS (SELECT * FROM (SELECT {mine}, sum(capacity)::HUGEINT AS c, {case(level, weights, 1)}::HUGEINT AS wt FROM leaf GROUP BY {mine}) {joined} WHERE wt > 0)",
            f"f{k} AS (SELECT *, c * sum(wt) OVER ({by} ORDER BY c::DOUBLE / wt::DOUBLE, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= wt * (parent_budget - "
            f"coalesce(sum(c) OVER ({by} ORDER BY c::DOUBLE / wt::DOUBLE, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full FROM n{k})",
            f"b{k} AS (SELECT {mine}, CASE WHEN is_full THEN c ELSE wt * (parent_budget - coalesce(sum(CASE WHEN is_full THEN c END) OVER ({by}), 0)) // "
            f"sum(CASE WHEN NOT is_full THEN wt END) OVER ({by}) END AS parent_budget FROM f{k})",
        ]
        above, keys = f"b{k}", [*keys, level]
    parts += [
        "p AS (SELECT *, CASE WHEN tokens > 0 THEN parent_budget // tokens ELSE 0 END AS epochs FROM leaf JOIN b3 USING (domain, lang, source))",
        f"o AS (SELECT w.*, epochs, parent_budget - epochs * tokens AS rest, md5('{mix.seed}|' || epochs || '|' || coalesce(doc_id::VARCHAR, '')) AS place FROM w JOIN p USING (domain, lang, source))",
        "s AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM o)",
        "t AS (SELECT *, epochs + CASE WHEN ahead < rest THEN 1 ELSE 0 END AS n FROM s)",
    ]
    return f"WITH {', '.join(parts)} SELECT doc_id, domain, lang, source, n_tokens, e.epoch::BIGINT AS epoch FROM t, LATERAL (SELECT unnest(range(0, n::BIGINT)) AS epoch) e"
