"""First earlier leader: each profile joins the first leader before it that it matches, else it becomes a leader.

Matches are told by *hubs* and never written out as pairs: a row (key, profile, at, gives, takes) says that the profile
is matched by every other profile of the key on the other side. Rounds settle all profiles before which
nothing is open that could still change their choice. Only the frontier survives a round: rows of profiles that are still
open, and each key's first leader; older tables are deleted. What is left in the end, or in one connected
part of bounded size, is settled in order in one task, so a long chain doesn't cost a round for each link.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerweave.operators.tables import Workspace

#: Rows of open profiles that one task settles, some 100 bytes each.
ONE_TASK = 200_000
#: Rounds between searches for connected parts.
ROUNDS = 4
#: Rounds over cores, before what is still open is written out profile by profile.
CORE_ROUNDS = 12
_DECIDED = "profile long, leader long"


def _in_order(table: pa.Table) -> pa.Table:
    """Rows (key, profile, at, gives, takes, led) of whole connected parts: their profiles one after another."""
    rows: dict[int, list] = {}
    order: dict[int, tuple] = {}
    led: dict[str, tuple] = {}
    for key, profile, at, gives, takes, first in zip(*(table.column(c).to_pylist() for c in ("key", "profile", "at", "gives", "takes", "led")), strict=True):
        rows.setdefault(profile, []).append((key, gives, takes))
        order[profile] = tuple(at.values())
        if first is not None:
            led[key] = tuple(first.values())
    out = []
    for profile in sorted(order, key=order.__getitem__):
        at = order[profile]
        found = [led[key] for key, _, takes in rows[profile] if takes and key in led and led[key] < at]
        if found:
            out.append((profile, min(found)[-1]))
            continue
        out.append((profile, profile))
        for key, gives, _ in rows[profile]:
            if gives:
                led[key] = min(at, led.get(key, at))
    return pa.table({"profile": pa.array([p for p, _ in out], pa.int64()), "leader": pa.array([x for _, x in out], pa.int64())})


def parts(rows: DataFrame, work: Workspace) -> DataFrame:
    """(profile, part): profiles that share keys, directly or by others, get one number, the smallest of them.

    A round takes the smallest label over each key, and then that label's own, so that chains shorten by half.
    """
    labels = work.written(rows.select("profile", F.col("profile").alias("part")).distinct())
    links = work.written(rows.select("key", "profile").distinct())
    while True:
        keys = links.join(labels, "profile").groupBy("key").agg(F.min("part").alias("near"))
        near = links.join(keys, "key").groupBy("profile").agg(F.min("near").alias("near"))
        jump = labels.select(F.col("profile").alias("near"), F.col("part").alias("beyond"))
        moved = labels.join(near, "profile").join(jump, "near")
        new = work.written(moved.select("profile", F.least("near", "beyond").alias("part"), (F.least("near", "beyond") < F.col("part")).alias("moved")))
        work.drop(labels)
        labels = new
        if not new.where("moved").limit(1).count():
            work.drop(links)
            return labels.select("profile", "part")


def _ahead(c: str, takes: str = "takes") -> Column:
    return F.when(F.col(takes) & (F.col(c) < F.col("at")), F.col(c))


def assigned(links: DataFrame, work: Workspace, one_task: int = ONE_TASK, rounds: int = ROUNDS) -> DataFrame:
    """(profile, leader) of every profile in ``links``: key, profile, at (ends with the profile's number), gives, takes."""
    # a key of one profile decides nothing, but its profile is to be settled
    counts = links.groupBy("key").agg((F.min("profile") < F.max("profile")).alias("met"))
    open_ = work.written(links.join(counts, "key").where("met").drop("met"))
    alone = links.select("profile").distinct().join(open_.select("profile").distinct(), "profile", "left_anti")
    settled = [work.written(alone.select("profile", F.col("profile").alias("leader")))]
    at = open_.schema["at"].dataType.simpleString()
    led = work.written(open_.sparkSession.createDataFrame([], f"key string, led {at}"))
    since = 0
    while size := open_.count():
        grouped = open_.join(led, "key", "left").select("key", "profile", "at", "gives", "takes", "led")
        if size <= one_task:
            settled.append(work.written(grouped.withColumn("part", F.lit(0)).groupBy("part").applyInArrow(_in_order, _DECIDED)))
            break
        if since == rounds:
            since = 0
            of = parts(open_, work)
            sizes = open_.join(of, "profile").groupBy("part").agg(F.count("*").alias("n"))
            small = of.join(sizes.where(F.col("n") <= one_task).select("part"), "part")
            new = work.written(grouped.join(small, "profile").groupBy("part").applyInArrow(_in_order, _DECIDED))
        else:
            since += 1
            firsts = open_.where("gives").groupBy("key").agg(F.min("at").alias("first"))
            state = grouped.join(firsts, "key", "left")
            seen = state.groupBy("profile").agg(F.min(_ahead("led")).alias("led"), F.min(_ahead("first")).alias("first"))
            ready = seen.where(F.col("first").isNull() | (F.col("led") < F.col("first")))
            new = work.written(ready.select("profile", F.coalesce(F.col("led")[_last(open_)], F.col("profile")).alias("leader")))
        settled.append(new)
        leaders = new.where("leader = profile").select("profile")
        gained = open_.where("gives").join(leaders, "profile", "left_semi").groupBy("key").agg(F.min("at").alias("gain"))
        left = work.written(open_.join(new.select("profile"), "profile", "left_anti"))
        best = led.join(gained, "key", "full_outer").select("key", F.least("led", "gain").alias("led"))
        ahead = work.written(best.join(left.select("key").distinct(), "key", "left_semi"))
        work.drop(open_, led)
        open_, led = left, ahead
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def _matched(givers: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(core, near) and (own, near_own): the first of ``givers`` that a core's hubs, or an address, matches."""
    hubs = links.where("gives").join(givers.groupBy("core").agg(F.min("at").alias("near")), "core").groupBy("key").agg(F.min("near").alias("near"))
    cores = links.where("takes").join(hubs, "key").groupBy("core").agg(F.min("near").alias("near"))
    return cores, givers.where("own is not null").groupBy("own").agg(F.min("at").alias("near_own"))


def assigned_by_core(nodes: DataFrame, links: DataFrame, work: Workspace, one_task: int = ONE_TASK, rounds: int = CORE_ROUNDS) -> DataFrame:
    """(profile, leader) of ``nodes`` (profile, at, core, own): matched through their core's ``links`` (key, core, gives,
    takes), or by an equal ``own`` that isn't null.

    A round names as leaders all open profiles that nothing open before them matches, and closes what these match:
    that will join one of them or an earlier one, and never lead. Which one is found at the end, once all leaders
    are known. Hubs are read per core, so their rows don't grow with the profiles of a core.
    """
    fan = links.groupBy("core").agg(F.count("*").alias("n"))
    open_, found = nodes, []
    for k in range(rounds + 1):
        size = open_.join(fan, "core", "left").agg(F.sum(F.coalesce("n", F.lit(0)) + 1)).first()[0]
        if not size:
            break
        if k == rounds or (k and size <= one_task):
            rows = open_.join(links, "core").select("key", "profile", "at", "gives", "takes")
            rows = work.written(rows.unionByName(open_.select(F.coalesce(F.concat(F.lit("own "), "own"), F.concat(F.lit("none "), F.col("profile").cast("string"))).alias("key"), "profile", "at", F.lit(True).alias("gives"), F.lit(True).alias("takes"))))
            led = assigned(rows, work, one_task).where("leader = profile").select("profile")
            found.append(work.written(open_.join(led, "profile", "left_semi").select(*nodes.columns)))
            break
        cores, owns = _matched(open_, links)
        seen = open_.join(cores, "core", "left").join(owns, "own", "left")
        before = F.coalesce(F.col("near") < F.col("at"), F.lit(False)) | F.coalesce(F.col("near_own") < F.col("at"), F.lit(False))
        new = work.written(seen.where(~before).select(*nodes.columns))
        found.append(new)
        cores, owns = _matched(new, links)
        rest = open_.join(new.select("profile"), "profile", "left_anti").join(cores, "core", "left").join(owns, "own", "left")
        left = work.written(rest.where(~before).select(*nodes.columns))
        if open_ is not nodes:
            work.drop(open_)
        open_ = left
    leaders = found[0] if found else nodes
    for more in found[1:]:
        leaders = leaders.unionByName(more)
    cores, owns = _matched(leaders, links)
    met = nodes.join(cores, "core", "left").join(owns, "own", "left")
    least = F.least(F.when(F.col("near") < F.col("at"), F.col("near")), F.when(F.col("near_own") < F.col("at"), F.col("near_own")))
    return met.select("profile", F.coalesce(least[_last(nodes)], F.col("profile")).alias("leader"))


def _last(df: DataFrame) -> str:
    return df.schema["at"].dataType.names[-1]
