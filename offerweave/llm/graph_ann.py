"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Vectors are dealt into shards of about ``SHARD`` by a hash of their values. In a shard every vector in turn looks
for its neighbours by a greedy beam search in the graph so far; of those it met, robust pruning keeps the nearest
and drops what that one is nearer to by the factor ``ALPHA``, then the next nearest left, and so on, so the
``DEGREE`` edges kept point in diverse directions. Edges are added back the other way and pruned likewise
(the method of Subramanya et al., NeurIPS 2019). A query runs a beam search in every shard; scores of what it found are
computed exactly, in double precision on the original vectors, and the best over all shards stay.

Equal vectors are one vertex: of their ids only the ``k + 1`` smallest can be among a query's k nearest, so that
many go along, cut down before the shuffle. A task builds or searches one shard. Queries aren't shuffled: they are
written once, in files of about ``QUERY_BLOCK``, and every search task reads these files one after another, so its
memory holds one shard and one block. Where shards are fewer than cores, several tasks share out a shard's files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerweave.llm.shared import Scratch, new_path, stored

SHARD = 5000
QUERY_BLOCK = 4096
DEGREE = 32
BEAM = 64  # while searching
BUILD_BEAM = 48
ALPHA = 1.2  # of distances; squared ones are compared
ENTRIES = 16  # vertices where every search begins: the medoid and some drawn ones
BATCH = 128
SEED = 5


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For unit vectors q: the ``width`` nearest vertices that greedy search meets (-1 pads), and squared distances."""
    n, rows = len(q), np.arange(len(q))
    seen = np.zeros((n, len(x) + 1), bool)  # the last column is that of the padding
    seen[:, -1] = True
    seen[:, entries] = True
    ids = np.full((n, width), -1)
    dist = np.full((n, width), np.inf)
    done = np.ones((n, width), bool)
    first = 2 - 2 * (q @ x[entries].T)
    order = np.argsort(first, axis=1, kind="stable")[:, :width]
    ids[:, : order.shape[1]] = entries[order]
    dist[:, : order.shape[1]] = np.take_along_axis(first, order, 1)
    done[:, : order.shape[1]] = False
    active = rows
    while len(active):
        pick = np.argmax(~done[active], axis=1)
        open_ = ~done[active, pick]
        active, pick = active[open_], pick[open_]
        if not len(active):
            break
        done[active, pick] = True
        near = graph[ids[active, pick]]
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        d = np.where(fresh, 2 - 2 * np.einsum("bd,brd->br", q[active], x[near]), np.inf)
        all_d = np.concatenate([dist[active], d], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        dist[active] = np.take_along_axis(all_d, order, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], near], axis=1), order, 1)
        done[active] = np.take_along_axis(np.concatenate([done[active], ~fresh], axis=1), order, 1)
    ids[np.isinf(dist)] = -1
    return ids, dist


def robust_prune(x: np.ndarray, of: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """For vertices ``of``, at most ``DEGREE`` diverse neighbours out of each row of candidates (-1 pads)."""
    n, rows = len(of), np.arange(len(of))
    candidates = np.where(candidates == of[:, None], -1, candidates)
    vectors = x[candidates]
    d = np.where(candidates >= 0, 2 - 2 * np.einsum("bd,bcd->bc", x[of], vectors), np.inf)
    # equal candidates: the first one stays
    order = np.argsort(candidates, axis=1, kind="stable")
    by_id = np.take_along_axis(candidates, order, 1)
    twice = np.zeros_like(candidates, bool)
    np.put_along_axis(twice, order[:, 1:], by_id[:, 1:] == by_id[:, :-1], 1)
    d[twice] = np.inf
    out = np.full((n, DEGREE), -1)
    for k in range(DEGREE):
        best = np.argmin(d, axis=1)
        alive = np.isfinite(d[rows, best])
        if not alive.any():
            break
        out[alive, k] = candidates[rows, best][alive]
        between = 2 - 2 * np.einsum("bd,bcd->bc", vectors[rows, best], vectors)
        d = np.where(ALPHA**2 * between <= d, np.inf, d)
        d[rows, best] = np.inf
    return out


def build(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entries) over unit vectors; row i of the graph holds the neighbours of vertex i, -1 pads."""
    n = len(x)
    draw = np.random.default_rng(SEED)
    graph = np.full((n, DEGREE), -1)
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    entries = np.unique(np.concatenate([[medoid], draw.integers(0, n, min(n, ENTRIES - 1))]))
    if n > 1:
        start = draw.integers(0, n, (n, min(8, n - 1)))
        graph[:, : start.shape[1]] = np.where(start == np.arange(n)[:, None], -1, start)
    order = draw.permutation(n)
    for a in range(0, n, BATCH):
        now = order[a : a + BATCH]
        met, _ = beam_search(x, graph, entries, x[now], BUILD_BEAM)
        graph[now] = robust_prune(x, now, np.concatenate([met, graph[now]], axis=1))
        back: dict[int, list[int]] = {}
        for i, near in zip(now.tolist(), graph[now].tolist(), strict=True):
            for j in near:
                if j >= 0:
                    back.setdefault(j, []).append(i)
        full: list[int] = []
        for j, new in back.items():
            own = graph[j]
            new = [i for i in new if i not in own]
            free = np.flatnonzero(own < 0)
            if len(new) <= len(free):
                own[free[: len(new)]] = new
            elif new:
                full.append(j)
        for b in range(0, len(full), BATCH):
            some = full[b : b + BATCH]
            most = max(len(back[j]) for j in some)
            extra = np.full((len(some), most), -1)
            for k, j in enumerate(some):
                extra[k, : len(back[j])] = back[j]
            graph[some] = robust_prune(x, np.array(some), np.concatenate([graph[some], extra], axis=1))
    return graph, entries


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, size)


def _build_shard(key: tuple, table: pa.Table) -> pa.Table:
    size, shard = key[0].as_py(), key[1].as_py()
    table = table.sort_by("ids_least")
    x = _matrix(table.column("embedding"), size)
    graph, entries = build(_unit(x))
    ids = table.column("ids").combine_chunks()
    return pa.table({
        "size": pa.array([size], pa.int32()),
        "shard": pa.array([shard], pa.int32()),
        "vectors": pa.array([x.tobytes()], pa.binary()),
        "graph": pa.array([graph.astype(np.int32).tobytes()], pa.binary()),
        "entries": pa.array([entries.astype(np.int32).tobytes()], pa.binary()),
        "ids": pa.array([ids.flatten().to_numpy().astype(np.int64).tobytes()], pa.binary()),
        "copies": pa.array([np.asarray(ids.value_lengths(), np.int32).tobytes()], pa.binary()),
    })


def _query_blocks(uri: str, size: int, part: int, parts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of the queries of ``size`` values, from every ``parts``-th file of the table at ``uri``."""
    from pyarrow import fs
    from pyarrow.parquet import ParquetFile

    files, root = fs.FileSystem.from_uri(uri)
    names = sorted(f.path for f in files.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("part-"))
    for name in names[part::parts]:
        with files.open_input_file(name) as f:
            for batch in ParquetFile(f).iter_batches(QUERY_BLOCK, columns=["query_id", "size", "embedding"]):
                batch = batch.filter(pc.equal(batch.column("size"), size))
                if batch.num_rows:
                    yield batch.column("query_id").to_numpy(), batch.column("embedding").flatten().to_numpy().reshape(-1, size)


def _search(uri: str, parts: int, k: int):
    """For rows of the index, each with its ``part`` of the query files: the k nearest of the shard for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                of = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                x = np.frombuffer(of["vectors"]).reshape(-1, of["size"])
                graph = np.frombuffer(of["graph"], np.int32).reshape(len(x), -1).astype(np.int64)
                entries = np.frombuffer(of["entries"], np.int32).astype(np.int64)
                ids, copies = np.frombuffer(of["ids"], np.int64), np.frombuffer(of["copies"], np.int32)
                at = np.cumsum(copies) - copies
                unit, norm = _unit(x), np.linalg.norm(x, axis=1)
                for query_ids, q in _query_blocks(uri, of["size"], of["part"], parts):
                    out_q, out_v, out_s = [], [], []
                    for a in range(0, len(q), BATCH):
                        some = q[a : a + BATCH]
                        met, _ = beam_search(unit, graph, entries, _unit(some), BEAM)
                        for query_id, v, near in zip(query_ids[a : a + BATCH].tolist(), some, met, strict=True):
                            near = near[near >= 0]
                            score = (x[near] @ v) / (norm[near] * np.linalg.norm(v))
                            n = copies[near].astype(np.int64)
                            of_id = np.concatenate([ids[at[i] : at[i] + copies[i]] for i in near])
                            all_scores = np.repeat(score, n)
                            other = of_id != query_id
                            of_id, all_scores = of_id[other], all_scores[other]
                            best = np.lexsort((of_id, -all_scores))[:k]
                            out_q += [query_id] * len(best)
                            out_v += of_id[best].tolist()
                            out_s += all_scores[best].tolist()
                    yield pa.record_batch([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_s, pa.float64())], ["query_id", "vec_id", "score"])

    return run


def _usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding as doubles) that can be compared."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sum_squares = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v)
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return rows.where("vec_id is not null and embedding is not null").where(whole).where(sum_squares > 0).dropDuplicates(["vec_id", "embedding"])


def index(vectors: DataFrame, k: int) -> DataFrame:
    """One row per shard: its vectors, graph and ids. Written to the shared folder."""
    one = Window.partitionBy("embedding").orderBy("vec_id")
    rows = _usable(vectors).withColumn("copy", F.row_number().over(one)).where(F.col("copy") <= k + 1)
    classes = rows.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    with Scratch(vectors.sparkSession) as scratch:
        classes = scratch.stored(classes.withColumn("size", F.size("embedding")).withColumn("ids_least", F.col("ids")[0]), "vectors")
        shards = max(1, -(-classes.count() // SHARD))
        # an int, since groups stay where rows were dealt only by the column as it is
        dealt = classes.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))
        schema = "size int, shard int, vectors binary, graph binary, entries binary, ids binary, copies binary"
        return stored(dealt.repartitionById(shards, "shard").groupBy("size", "shard").applyInArrow(_build_shard, schema), "index")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the k nearest rows of ``vectors`` found.

    Both have vec_id and embedding. Nearness is cosine; ties go to the smaller vec_id; a query's own id is left out.
    Rows without an id, and vectors that are null, empty, zero or hold null or non-finite values take no part,
    neither as queries; a repeated (id, vector) counts once. Only vectors of as many values are compared.
    Empty tables give no rows. Other columns, whatever their names, aren't read.
    """
    spark = vectors.sparkSession
    shards = index(vectors, k)
    asked = _usable(queries).select(F.col("vec_id").alias("query_id"), "embedding", F.size("embedding").alias("size"))
    uri = new_path(spark, "queries")
    with Scratch(spark) as scratch:
        asked = scratch.stored(asked, "asked")
        blocks = max(1, -(-asked.count() // QUERY_BLOCK))
        asked.repartition(blocks, "query_id").write.parquet(uri)
    n_shards = (shards.agg(F.max("shard")).first()[0] or 0) + 1
    parts = min(blocks, max(1, spark.sparkContext.defaultParallelism // n_shards))
    dealt = shards.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = dealt.repartitionById(n_shards * parts, F.col("shard") * parts + F.col("part"))
    found = dealt.mapInArrow(_search(uri, parts, k), "query_id long, vec_id long, score double").repartition("query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # a query id with several vectors may find an id twice
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
