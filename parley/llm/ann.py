"""Nearest neighbours by robust-pruned directed graphs, one per shard, searched with a beam."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import saved

#: Distinct vectors in one shard at most, about; queries in one block, and those of them that step together.
SHARD, BLOCK, TOGETHER = 8192, 16384, 1024
DEGREE, BUILD_BEAM, SEARCH_BEAM = 24, 40, 96
#: Edges that a vertex may hold while the graph is built, before it is pruned.
SLACK = 40
#: Relaxation of the pruning rule in the second pass.
ALPHA = 1.2
BATCH = 512
#: Vectors whose largest components differ by up to this power of two share shards; their squares stay within doubles.
CLASS_BITS = 400


def _squares(points: np.ndarray, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of queries (b, d) to points[rows], rows (b, m); -1 in rows is infinitely far."""
    gap = points[rows] - queries[:, None, :]
    out = np.einsum("bmd,bmd->bm", gap, gap)
    out[rows < 0] = np.inf
    return out


def beam_search(points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The `beam` nearest vertices found for each query, and their squared distances, nearest first; -1 where there are fewer.

    All queries of a batch take a step at once: each opens its nearest unopened vertex and keeps the nearest of what
    it had and of that vertex's neighbours, until nothing in its beam is unopened.
    """
    b = len(queries)
    ids = np.full((b, beam), -1, np.int64)
    far = np.full((b, beam), np.inf)
    opened = np.zeros((b, beam), bool)
    ids[:, 0] = start
    far[:, 0] = _squares(points, ids[:, :1], queries)[:, 0]
    seen = np.zeros((b, len(points)), bool)
    seen[:, start] = True
    live = np.arange(b)
    while len(live):
        waiting = ~opened[live] & (ids[live] >= 0)
        has = waiting.any(axis=1)
        live, waiting = live[has], waiting[has]
        if not len(live):
            break
        place = waiting.argmax(axis=1)  # the beam is sorted, so the first is the nearest
        opened[live, place] = True
        near = edges[ids[live, place]]
        rows = np.arange(len(live))[:, None]
        new = (near >= 0) & ~seen[live[:, None], near]
        near = np.where(new, near, -1)
        seen[np.broadcast_to(live[:, None], near.shape)[new], near[new]] = True
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_far = np.concatenate([far[live], _squares(points, near, queries[live])], axis=1)
        all_open = np.concatenate([opened[live], np.zeros(near.shape, bool)], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        ids[live], far[live], opened[live] = all_ids[rows, order], all_far[rows, order], all_open[rows, order]
        ids[live] = np.where(np.isinf(far[live]), -1, ids[live])
    return ids, far


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """For each vertex up to `degree` of its candidates: the nearest, then the nearest that no kept one is closer to by alpha, and so on."""
    candidates = np.where(candidates == own[:, None], -1, candidates)
    by_id = np.argsort(candidates, axis=1, kind="stable")
    sorted_ids = np.take_along_axis(candidates, by_id, 1)
    sorted_ids[:, 1:][sorted_ids[:, 1:] == sorted_ids[:, :-1]] = -1
    far = _squares(points, sorted_ids, points[own])
    order = np.argsort(far, axis=1, kind="stable")
    candidates, far = np.take_along_axis(sorted_ids, order, 1), np.take_along_axis(far, order, 1)
    vectors = points[candidates] - points[own][:, None, :]  # so that what all have in common costs no digits
    norms = np.einsum("bmd,bmd->bm", vectors, vectors)
    between = norms[:, :, None] + norms[:, None, :] - 2 * (vectors @ vectors.transpose(0, 2, 1))
    covers = alpha * alpha * between <= far[:, None, :]  # [b, k, c]: candidate k, if kept, rules candidate c out
    alive = candidates >= 0
    out = np.full((len(own), degree), -1, np.int64)
    rows = np.arange(len(own))
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        pick = alive.argmax(axis=1)
        out[some, k] = candidates[rows, pick][some]
        alive &= ~covers[rows, pick]
        alive[rows, pick] = False
    return out


def _offer(points: np.ndarray, edges: np.ndarray, own: np.ndarray, alpha: float, degree: int) -> None:
    """Gives each new edge of `own` to its other end as well; ends that have no room left are pruned first to what is best."""
    width = edges.shape[1]
    source, target = np.repeat(own, degree), edges[own, :degree].reshape(-1)
    new = (target >= 0) & ~(edges[target] == source[:, None]).any(axis=1)
    source, target = source[new], target[new]
    order = np.lexsort((((points[source] - points[target]) ** 2).sum(axis=1), target))  # of many offers to one end the nearest
    source, target = source[order], target[order]
    ends, first, count = np.unique(target, return_index=True, return_counts=True)
    nth = np.arange(len(target)) - np.repeat(first, count)
    keep = nth < width
    offered = np.full((len(ends), width), -1, np.int64)
    offered[np.repeat(np.arange(len(ends)), count)[keep], nth[keep]] = source[keep]
    held = (edges[ends] >= 0).sum(axis=1)
    full = held + np.minimum(count, width) > width
    for at in range(0, int(full.sum()), BATCH):
        part = np.flatnonzero(full)[at : at + BATCH]
        kept = robust_prune(points, ends[part], np.concatenate([edges[ends[part]], offered[part]], axis=1), alpha, degree)
        edges[ends[part]] = -1
        edges[ends[part], :degree] = kept
    room = ~full[np.repeat(np.arange(len(ends)), count)] & keep
    place = np.repeat(held, count) + nth
    edges[target[room], place[room]] = source[room]


def power_of(points: np.ndarray) -> int:
    """The power of two that the largest component is about as large as."""
    return int(np.frexp(np.abs(points).max(initial=0))[1])


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances of pairs of vectors; where squares leave the range of doubles, of the vectors over their largest component."""
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.sqrt(((left - right) ** 2).sum(axis=-1))
        odd = ~((out > 1e-150) & (out < np.inf))
        if odd.any():
            a, b = left[odd], right[odd]
            most = np.maximum(np.maximum(np.abs(a).max(axis=-1), np.abs(b).max(axis=-1)), 5e-324)[:, None]
            out[odd] = most[:, 0] * np.sqrt(((a / most - b / most) ** 2).sum(axis=-1))
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM) -> tuple[np.ndarray, int]:
    """Edges (n, SLACK), -1 where there are fewer, and the vertex that searches start from: the one nearest the mean.

    From random edges, two passes over all vertices in batches: a greedy search for each vertex proposes
    neighbours, pruning keeps diverse ones, and each kept edge is offered to its other end, which is pruned when full. The
    points are doubles whose largest component is about one.
    """
    n = len(points)
    random = np.random.default_rng(n)
    edges = np.full((n, SLACK), -1, np.int64)
    if n < 2:
        return edges, 0
    some = min(degree // 2, n - 1)
    drawn = random.integers(0, n - 1, (n, some))
    edges[:, :some] = drawn + (drawn >= np.arange(n)[:, None])
    start = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    for alpha in (1.0, ALPHA):
        order = random.permutation(n)
        for at in range(0, n, BATCH):
            own = order[at : at + BATCH]
            found, _ = beam_search(points, edges, start, points[own], beam)
            kept = robust_prune(points, own, np.concatenate([found, edges[own]], axis=1), alpha, degree)
            edges[own] = -1
            edges[own, :degree] = kept
            _offer(points, edges, own, alpha, degree)
    return edges, start


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector) of vectors that are not null, empty or zero and hold finite components only, in double precision."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    limit = F.lit(float("inf"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (x < limit) & (x > -limit))
    return rows.filter(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)) & F.exists("vector", lambda x: x != 0))


def nearest(embeddings: DataFrame, every: int = 100, k: int = 10, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors found for each vector whose id is divisible by `every`, itself left out.

    Nearness is Euclidean distance on the given vectors in double precision, ties to the smaller id. Equal vectors
    are one vertex that carries its k + 1 least ids, which is all that any answer can show of it. Vertices
    are dealt to shards of about `shard` by a hash, those of very different sizes apart; each shard is indexed and searched on its own, blocks of queries
    meeting shards by a join on the shard. Graphs are built and searched on doubles over a power of two, so that no square overflows. Vectors of different lengths aren't compared. Repeated ids with one
    vector count once; an id with several vectors is searched with all of them and listed once, at its least
    distance. Of vectors at the distance of the last rank, the smaller ids among those in the beam are given. A query among many equal vectors gets the least ids of the others.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings).distinct().withColumn("vertex", F.sha2(F.concat_ws(",", F.transform("vector", lambda x: (x + 0.0).cast("string"))), 256))
    rows = saved(rows, "vectors")
    least = Window.partitionBy("vertex").orderBy("vec_id")
    members = rows.withColumn("nth", F.row_number().over(least)).filter(F.col("nth") <= k + 1)
    vertices = members.groupBy("vertex").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vector").alias("vector"))
    largest = F.aggregate("vector", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    sized = vertices.withColumn("d", F.size("vector")).withColumn("class", F.floor(F.log2(largest) / CLASS_BITS).cast("int"))
    sizes = {(r["d"], r["class"]): max(1, -(-r["count"] // shard)) for r in sized.groupBy("d", "class").count().collect()}
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    counts = F.create_map(*(F.lit(x) for (d, c), n in sizes.items() for x in (f"{d} {c}", n)))
    placed = sized.withColumn("shard", F.pmod(F.xxhash64("vertex"), counts[F.concat_ws(" ", "d", "class")]))
    shards = spark.createDataFrame([(d, c, s) for (d, c), n in sizes.items() for s in range(n)], "d int, class int, shard long")
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    questions = asked.groupBy("vertex").agg(F.first("vector").alias("vector")).withColumn("d", F.size("vector"))

    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vertex")
        points = np.stack(pdf["vector"].to_numpy())
        edges, start = build_graph(np.ldexp(points, -power_of(points)))
        return pd.DataFrame({"d": [key[0]], "class": [key[1]], "shard": [key[2]], "start": [start], "points": [points.tobytes()], "edges": [edges.astype(np.int32).tobytes()], "ids": [[list(x) for x in pdf["ids"]]]})

    index = placed.groupBy("d", "class", "shard").applyInPandas(build, "d int, class int, shard long, start int, points binary, edges binary, ids array<array<long>>")
    index = saved(index, "graphs")

    # A block of queries is one row; it is repeated for each shard of its length and meets it by the shard's number.
    block = F.pmod(F.xxhash64("vertex", F.lit(1)), F.lit(max(1, -(-questions.count() // BLOCK))))
    blocks = questions.groupBy("d", block.alias("block")).agg(F.collect_list(F.struct("vertex", "vector")).alias("queries"))
    pairs = blocks.join(shards, "d").join(index, ["d", "class", "shard"])

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        (r,) = pdf.itertuples(index=False)  # one block of queries and one shard at a time
        points = np.frombuffer(r.points).reshape(-1, r.d)
        edges = np.frombuffer(r.edges, np.int32).reshape(len(points), -1).astype(np.int64)
        queries = np.array([q["vector"] for q in r.queries], float)
        sizes = np.frexp(np.abs(queries).max(axis=1))[1] // CLASS_BITS
        out = []
        for chosen in (c[at : at + TOGETHER] for size in np.unique(sizes) for c in [np.flatnonzero(sizes == size)] for at in range(0, len(c), TOGETHER)):
            some = queries[chosen]
            power = max(power_of(points), power_of(some))
            found, _ = beam_search(np.ldexp(points, -power), edges, r.start, np.ldexp(some, -power), max(SEARCH_BEAM, k + 1))
            real = np.where(found >= 0, distances(points[found], np.broadcast_to(some[:, None, :], (*found.shape, r.d))), np.inf)
            order = np.lexsort((real, found < 0))
            found, real = np.take_along_axis(found, order, 1), np.take_along_axis(real, order, 1)
            for q, ids, own in zip([r.queries[c] for c in chosen], found, real, strict=True):
                near = (ids >= 0) & (own <= own[k])  # all that are as near as the (k + 1)th, so that ties fall to the smaller id
                best = sorted((float(s), int(i)) for v, s in zip(ids[near], own[near], strict=True) for i in r.ids[v])
                out += [(q["vertex"], i, s) for s, i in best[: k + 1]]
        return pd.DataFrame(out, columns=["vertex", "vec_id", "score"])

    found = pairs.groupBy("d", "class", "shard", "block").applyInPandas(search, "vertex string, vec_id long, score double")
    by_nearness = Window.partitionBy("vertex").orderBy("score", "vec_id")
    found = found.withColumn("nth", F.row_number().over(by_nearness)).filter(F.col("nth") <= k + 1)
    answers = asked.select(F.col("vec_id").alias("query_id"), "vertex").distinct().join(found, "vertex").filter("query_id <> vec_id")
    answers = answers.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    by_rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return answers.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
