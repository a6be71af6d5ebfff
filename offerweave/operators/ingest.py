"""Landed snapshots and the ingest job: payloads of any schema to rows, their status, and the union of chosen sources."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.functions import text, vocab
from offerweave.operators import scope, store


def snapshot_rows(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Rows of payloads ``source -> list of objects``, in one pass: the other columns, source, place, row, status.

    A payload is read as VARIANT, so sources may have unlike and changing schemas. ``status`` is ``kept`` for an object
    of a known source's list; what is left out is told as well: ``bad_payload`` (no JSON, or no object), ``not_a_list``,
    ``empty_list``, ``unknown_source`` and ``not_a_row``. An empty object has no row at all.
    """
    spark = payloads.sparkSession
    others = "".join(f"`{c}`, " for c in payloads.columns if c != column)
    kind = "coalesce(schema_of_variant({0}), 'VOID')"
    # JSON that begins with a brace is an object; a schema is told by reading all of a value
    brace = F.ltrim(F.col(column), F.lit(" \t\r\n")).startswith("{")
    read = payloads.withColumns({"__v": F.try_parse_json(F.col(column)), "__brace": brace}).drop(column)
    read = read.withColumn("__good", F.coalesce(F.col("__v").isNotNull() & F.col("__brace"), F.lit(False)))
    parted = spark.sql(f"SELECT {others}__good, s.key AS source, s.value AS __rows FROM {{read}}, LATERAL variant_explode_outer(CASE WHEN __good THEN __v END) s", read=read)
    # elements of a list have no key, fields of an object have one; only what gave neither is asked for its schema
    found = spark.sql(
        f"SELECT {others}__good, source, r.key AS __key, r.pos AS __pos, CASE WHEN r.pos IS NULL THEN {kind.format('__rows')} LIKE 'ARRAY%' ELSE r.key IS NULL END AS __list, "
        "CASE WHEN r.key IS NULL THEN r.pos END AS place, CASE WHEN r.key IS NULL THEN r.value END AS row FROM {parted}, LATERAL variant_explode_outer(__rows) r",
        parted=parted,
    ).where("(not __good or source is not null) and (__key is null or __pos = 0)").drop("__key", "__pos")
    status = (
        F.when(~F.col("__good"), "bad_payload")
        .when(~F.col("__list"), "not_a_list")
        .when(F.col("place").isNull(), "empty_list")
        .when(~F.expr(f"{kind.format('row')} LIKE 'OBJECT%'"), "not_a_row")
        .when(~F.col("source").isin(*vocab.STORE_SOURCES), "unknown_source")
        .otherwise("kept")
    )
    return found.withColumn("status", status).drop("__good", "__list")


def statuses(rows: DataFrame) -> DataFrame:
    """How many rows of each status; a payload or list that gave no row counts once."""
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def offers_of(rows: DataFrame, ord_: Column) -> DataFrame:
    """Kept rows as raw offers: the fields that the offers table takes, and ``source`` where a row has none of its own."""
    names = sorted({c for raw in store.TEXTS.values() for c in raw} | {"salary_is_predicted"})
    get = lambda c, kind="string": F.expr(f"try_variant_get(row, '$.{c}', '{kind}')")
    own = {c: get(c) for c in names if c not in ("source", "salary_is_predicted")}
    listed, one = get("skills", "array<string>"), get("skills")
    is_list = F.expr("coalesce(schema_of_variant(try_variant_get(row, '$.skills', 'variant')) LIKE 'ARRAY%', false)")
    skills = F.when(is_list, listed).when(text.strip(text.text(one)) != "", F.array(one)).otherwise(F.array().cast("array<string>"))
    predicted = F.coalesce(get("salary_is_predicted", "int"), get("salary_is_predicted", "boolean").cast("int"))
    return rows.where("status = 'kept'").select(
        ord_.alias("ord"), F.coalesce(get("source"), F.col("source")).alias("source"), *[c.alias(n) for n, c in own.items()], predicted.alias("salary_is_predicted"), skills.alias("skills"), F.to_json("row").alias("raw_payload")
    )


def collected(readers: Mapping[str, Callable[[], DataFrame]], only: tuple[str, ...] = (), skip: tuple[str, ...] = ()) -> DataFrame:
    """One plan for the chosen sources: mapped rows with the columns that any of them has, null where others lack them.

    Readers of sources that aren't chosen are never called, so nothing of theirs is listed, read or planned.
    """
    out = None
    for name in scope.selected(only, skip):
        if name in readers:
            rows = readers[name]()
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise ValueError("none of the chosen sources can be read")
    return out
