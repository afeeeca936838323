"""Exact largest inner products by three phases over parts of the vectors, with one uniform threshold a query."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import saved

#: Parts that vectors are cut into; distinct vectors in one shard and queries in one block, about.
PARTS, SHARD, BLOCK = 2, 8192, 512
#: Best local scores of a query in one part, from all shards, whose vectors' sums give its cutoff.
GATHERED = 32
SCALE = 256
#: From here on doubles are whole numbers, and 256 times them is worked out in Python's integers.
_WHOLE = 2.0**52
_LONG = (1 << 63) - 1
#: Pieces that equal vectors' ids are dealt to before their least are taken.
_SALTS = 32
_FOUND = "query long, node long, score long, beyond string"


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows whose id and vector aren't null and whose components all are finite, in double precision."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    limit = F.lit(float("inf"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (x < limit) & (x > -limit))
    return rows.filter(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))


def _vertices(embeddings: DataFrame, every: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(vec_id, vector, wide), one for each id, and the distinct vectors: node (their least id), their k + 1 least ids, whether any is a query.

    Of vectors that doubles add exactly `vector` holds floor(256 x); of the others, the wide ones, it holds x.
    """
    one = usable(embeddings).groupBy("vec_id").agg(F.min("vector").alias("given"))
    ints = F.transform("given", lambda x: F.when(F.abs(x) < _WHOLE, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE) + F.lit(0.0))
    most = F.floor(F.sqrt(F.lit(2.0**53) / F.greatest(F.size("given"), F.lit(1))))
    rows = one.withColumn("ints", ints).withColumn("wide", F.coalesce(F.exists("ints", lambda x: F.abs(x) > most), F.lit(False)))
    rows = saved(rows.select("vec_id", F.when(F.col("wide"), F.transform("given", lambda x: x + F.lit(0.0))).otherwise(F.col("ints")).alias("vector"), "wide"), "components")
    asked = F.pmod("vec_id", F.lit(every)) == 0
    alike = Window.partitionBy("vector", "wide", F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS)))
    some = rows.withColumn("nth", F.row_number().over(alike.orderBy("vec_id"))).withColumn("asked", F.max(asked).over(alike)).filter(F.col("nth") <= k + 1)
    ids = F.slice(F.sort_array(F.collect_list("vec_id")), 1, k + 1)
    found = some.groupBy("vector", "wide").agg(ids.alias("ids"), F.max("asked").alias("asked"))
    return rows, saved(found.select(F.col("ids")[0].alias("node"), "ids", F.size("vector").alias("d"), "wide", "asked", "vector"), "vertices")


def _packed(rows: DataFrame, number: str, parts: int) -> DataFrame:
    """(d, number, nodes, points): a row for each group of vectors, its points as one matrix of doubles for each part."""

    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        points, d = np.array(list(pdf["vector"]), float).reshape(len(pdf), key[0]), key[0]
        cut = [np.ascontiguousarray(points[:, d * p // parts : d * (p + 1) // parts]).tobytes() for p in range(parts)]
        return pd.DataFrame({"d": [d], number: [key[1]], "nodes": [pdf["node"].to_numpy(np.int64).tobytes()], "points": [cut]})

    return saved(rows.groupBy("d", number).applyInPandas(pack, f"d int, {number} long, nodes binary, points array<binary>"), number)


def _matrix(points: bytes, n: int) -> np.ndarray:
    return np.frombuffer(points).reshape(n, -1) if n else np.zeros((0, 0))


def _nodes(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.int64)


def _rows(work: Callable) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function of one row, as one of batches; it yields a frame a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                yield work(r)

    return run


def _first(order: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Of rows in this order, sorted by group first, the n first of each group."""
    group = group[order]
    start = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, int)
    nth = np.arange(len(group)) - np.repeat(start, np.diff(np.append(start, len(group))))
    return order[nth < n]


def _looked_up(blocks: list[np.ndarray], shards: list[np.ndarray], q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """(part, entry) local scores of pairs of rows, a million components at a time."""
    out = np.zeros((len(blocks), len(q)), np.int64)
    for p, (left, right) in enumerate(zip(blocks, shards, strict=True)):
        step = max(1, (1 << 20) // max(1, left.shape[1]))
        for at in range(0, len(q), step):
            out[p, at : at + step] = np.einsum("ij,ij->i", left[q[at : at + step]], right[v[at : at + step]])
    return out


def _narrow(vertices: DataFrame, k: int, parts: int, shards: Column, blocks: Column, gathered: int) -> DataFrame:
    """(query, node, score, beyond): the k + 1 best of each query among vectors whose products doubles add exactly, and those that tie."""
    shard_of = lambda node: F.pmod(F.xxhash64(node), shards)
    block_of = lambda node: F.pmod(F.xxhash64(node, F.lit(1)), blocks)
    lists = _packed(vertices.withColumn("shard", shard_of("node")), "shard", parts)
    asked = _packed(vertices.filter("asked").withColumn("block", block_of("node")), "block", parts)
    every_shard = F.explode(F.sequence(F.lit(0).cast("long"), shards.cast("long") - 1)).alias("shard")
    held = lists.select("d", "shard", F.col("nodes").alias("vertices"), F.posexplode("points").alias("part", "shard_points"))

    # Joins that carry points are sorted: Spark takes a block for one row though it is repeated for every shard, and would gather them all in the driver to broadcast them.
    # Phase 1: the best local scores of each query in each part, and the sums of the vectors that have them.
    def local_best(r) -> pd.DataFrame:
        queries, nodes = _nodes(r.queries), _nodes(r.vertices)
        scores = _matrix(r.block_points, len(queries)) @ _matrix(r.shard_points, len(nodes)).T
        n = min(k + 1, len(nodes))
        best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
        local = np.take_along_axis(scores, best, 1)
        return pd.DataFrame({"d": r.d, "part": r.part, "query": np.repeat(queries, n), "node": nodes[best.reshape(-1)], "local": local.reshape(-1).astype(np.int64)})

    dealt = asked.select("d", "block", F.col("nodes").alias("queries"), F.posexplode("points").alias("part", "block_points")).select("*", every_shard)
    best = dealt.join(held.hint("merge"), ["d", "part", "shard"]).mapInPandas(_rows(local_best), "d int, part int, query long, node long, local long")
    nth = F.row_number().over(Window.partitionBy("query", "part").orderBy(F.col("local").desc(), "node"))
    known = best.withColumn("nth", nth).filter(F.col("nth") <= gathered).select("d", "query", "node").distinct()
    pairs = known.withColumns({"shard": shard_of("node"), "block": block_of("query")}).groupBy("d", "shard", "block").agg(F.collect_list("query").alias("left"), F.collect_list("node").alias("right"))
    whole = lists.select("d", "shard", F.col("nodes").alias("vertices"), F.col("points").alias("shard_points"))

    def sums(r) -> pd.DataFrame:
        queries, nodes = _nodes(r.nodes), _nodes(r.vertices)
        left = [_matrix(p, len(queries)) for p in r.points]
        right = [_matrix(p, len(nodes)) for p in r.shard_points]
        locals_ = _looked_up(left, right, np.searchsorted(queries, r.left), np.searchsorted(nodes, r.right))
        return pd.DataFrame({"d": r.d, "block": r.block, "query": r.left, "total": locals_.sum(axis=0), "locals": list(locals_.T)})

    summed = pairs.join(asked.hint("merge"), ["d", "block"]).join(whole.hint("merge"), ["d", "shard"]).mapInPandas(_rows(sums), "d int, block long, query long, total long, locals array<long>")
    by_total = Window.partitionBy("query").orderBy(F.col("total").desc())
    top = summed.withColumn("nth", F.row_number().over(by_total)).filter(F.col("nth") <= k + 1)

    # The cutoff is the (k + 1)th sum, as one of the k + 1 may be the query itself; its even shares are above the parts' means.
    means = [F.floor(F.avg(F.col("locals")[p])).cast("long") for p in range(parts)]
    cut = top.groupBy("d", "block", "query").agg(F.when(F.count("*") > k, F.min("total")).alias("cutoff"), F.array(*means).alias("means"))
    spare = F.floor((F.col("cutoff") - F.aggregate("means", F.lit(0).cast("long"), lambda a, x: a + x)) / F.lit(parts)).cast("long")
    cut = cut.withColumn("least", F.transform("means", lambda m: m + spare))
    cuts = cut.groupBy("d", "block").agg(F.sort_array(F.collect_list(F.struct("query", "cutoff", "least"))).alias("cuts"))
    asked = saved(asked.hint("merge").join(cuts, ["d", "block"]), "cutoffs")

    # Phase 2: every entry that reaches its part's share of the cutoff.
    lowest = -(1 << 62)

    def limits(cuts) -> tuple[np.ndarray, np.ndarray]:
        none = [lowest] * parts
        cutoffs = np.array([lowest if c["cutoff"] is None else c["cutoff"] for c in cuts], np.int64)
        return cutoffs, np.array([none if c["cutoff"] is None else list(c["least"]) for c in cuts], np.int64)

    def sufficient(r) -> pd.DataFrame:
        queries, nodes = _nodes(r.queries), _nodes(r.vertices)
        scores = _matrix(r.block_points, len(queries)) @ _matrix(r.shard_points, len(nodes)).T
        q, v = np.nonzero(scores >= limits(r.cuts)[1][:, r.part, None])
        packed = [q.astype(np.int32).tobytes(), v.astype(np.int32).tobytes(), scores[q, v].astype(np.int64).tobytes()]
        return pd.DataFrame([(r.d, r.shard, r.block, r.part, *packed)] if len(q) else [], columns=["d", "shard", "block", "part", "left", "right", "local"])

    dealt = asked.select("d", "block", "cuts", F.col("nodes").alias("queries"), F.posexplode("points").alias("part", "block_points")).select("*", every_shard)
    entries = dealt.join(held.hint("merge"), ["d", "part", "shard"]).mapInPandas(_rows(sufficient), "d int, shard long, block long, part int, left binary, right binary, local binary")
    entries = entries.groupBy("d", "shard", "block").agg(F.collect_list(F.struct("part", "left", "right", "local")).alias("entries"))

    # Phase 3: what the others could still add, then the parts that are missing, then the best sums of each shard.
    def resolved(r) -> pd.DataFrame:
        queries, nodes = _nodes(r.nodes), _nodes(r.vertices)
        cutoffs, least = limits(r.cuts)
        told = [(e["part"], np.frombuffer(e["left"], np.int32).astype(np.int64) * len(nodes) + np.frombuffer(e["right"], np.int32), np.frombuffer(e["local"], np.int64)) for e in r.entries]
        codes = np.unique(np.concatenate([c for _, c, _ in told]))
        q, v = codes // len(nodes), codes % len(nodes)
        highest = (least - 1)[q].T.copy()
        seen = np.zeros(highest.shape, bool)
        for part, code, local in told:
            at = np.searchsorted(codes, code)
            highest[part, at], seen[part, at] = local, True
        hope = (highest.sum(axis=0) >= cutoffs[q]) | (cutoffs[q] == lowest)
        q, v, highest, seen = q[hope], v[hope], highest[:, hope], seen[:, hope]
        left = [_matrix(p, len(queries)) for p in r.points]
        right = [_matrix(p, len(nodes)) for p in r.shard_points]
        for part in range(parts):
            gone = np.flatnonzero(~seen[part])
            highest[part, gone] = _looked_up([left[part]], [right[part]], q[gone], v[gone])[0]
        total = highest.sum(axis=0)
        enough = total >= cutoffs[q]
        q, v, total = q[enough], v[enough], total[enough]
        kept = _first(np.lexsort((nodes[v], -total, q)), q, k + 1)
        return pd.DataFrame({"query": queries[q[kept]], "node": nodes[v[kept]], "score": total[kept], "beyond": ""})

    return entries.join(asked.hint("merge"), ["d", "block"]).join(whole.hint("merge"), ["d", "shard"]).mapInPandas(_rows(resolved), _FOUND)


def _ints(vector: np.ndarray, wide: bool) -> list[int]:
    """floor(256 x) of each component of a wide vector, of any size; others hold it already."""
    if not wide:
        return [int(x) for x in vector]
    return [int(x) * SCALE if abs(x) >= _WHOLE else math.floor(x * SCALE) for x in vector]


def _scaled(vectors: list, wide: list[bool]) -> np.ndarray:
    """The same integers over a power of two that makes the largest about one: exact but for what is 2^1000 times smaller than that."""
    out = []
    for v, w in zip(vectors, wide, strict=True):
        x = np.asarray(v, float)
        whole = np.abs(x) >= _WHOLE
        mantissa, power = np.frexp(np.where(whole | (not w), x, np.floor(np.where(whole, 0, x) * SCALE)))
        out.append((mantissa, power + np.where(whole & w, 8, 0)))
    mantissas, powers = (np.array(c) for c in zip(*out, strict=True))
    return np.ldexp(mantissas, powers - int(powers.max(initial=0)))


def _beyond(score: int) -> str:
    """Empty for scores inside the longs, else a text that sorts as the score does."""
    return "" if abs(score) < _LONG else str(score + 10**700).zfill(701)


def _wide(vertices: DataFrame, k: int, shards: Column, blocks: Column) -> DataFrame:
    """(query, node, score, beyond): the k + 1 best of each query among pairs of which one at least is wide.

    Doubles on scaled vectors, with a bound of their error, leave few candidates; those are ranked by Python's integers.
    """
    given = F.sort_array(F.collect_list(F.struct("node", "wide", "vector")))
    lists = vertices.withColumn("shard", F.pmod(F.xxhash64("node"), shards)).groupBy("d", "shard").agg(given.alias("others"))
    asked = vertices.filter("asked").withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), blocks)).groupBy("d", "block").agg(given.alias("queries"))
    dealt = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), shards.cast("long") - 1)))

    def best(r) -> pd.DataFrame:
        sides = [([x["node"] for x in side], [x["wide"] for x in side], [x["vector"] for x in side]) for side in (r.queries, r.others)]
        (qn, qw, qv), (vn, vw, vv) = sides
        left, right = _scaled(qv, qw), _scaled(vv, vw)
        about = left @ right.T
        error = (r.d + 4) * 2.0**-50 * np.linalg.norm(left, axis=1)[:, None] * np.linalg.norm(right, axis=1)[None, :] + 2.0**-900
        counted = np.array(qw)[:, None] | np.array(vw)[None, :]
        low = np.where(counted, about - error, -np.inf)
        n = min(k + 1, len(vn))
        floor = -np.partition(-low, n - 1, axis=1)[:, n - 1]
        out, right_ints = [], {}
        for i, j in zip(*np.nonzero(counted & (about + error >= floor[:, None])), strict=True):
            if j not in right_ints:
                right_ints[j] = _ints(vv[j], vw[j])
            out.append((i, j))
        rows = []
        for i in sorted({i for i, _ in out}):
            own = _ints(qv[i], qw[i])
            scored = sorted(((-sum(a * b for a, b in zip(own, right_ints[j], strict=True)), vn[j]) for x, j in out if x == i))[:n]
            rows += [(qn[i], node, max(-_LONG - 1, min(_LONG, -s)), _beyond(-s)) for s, node in scored]
        return pd.DataFrame(rows, columns=["query", "node", "score", "beyond"])

    return dealt.join(lists.hint("merge"), ["d", "shard"]).mapInPandas(_rows(best), _FOUND)


def top_inner(embeddings: DataFrame, every: int = 50, k: int = 5, parts: int = PARTS, shard: int = SHARD, block: int = BLOCK, gathered: int = GATHERED) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each vector whose id is divisible by `every` with all others.

    Components are floor(256 x). Vectors are cut into `parts` runs of components, each of which has a local score for each query;
    the score is their sum. Phase 1 takes the best local scores of each shard in each part and keeps the best of all
    shards; the sums of those vectors give a cutoff that k + 1 vectors reach. Phase 2: what the cutoff exceeds the
    parts' means over these k + 1 by is shared evenly. A vector below its share in every part can't reach the cutoff, so
    entries at or above a share are all that is collected. Phase 3 drops those that can't reach the cutoff, looks up the
    parts that the rest have not shown, and ranks the sums. Nothing is approximate. Cutoffs go with their block of queries.

    Equal vectors are one vertex that carries its k + 1 least ids, which is all that an answer can show of it. Ties go to the
    smaller id. Repeated rows count once; of an id with several vectors the least counts, in the order of arrays. Vectors
    of different lengths aren't compared; zero vectors take part, and empty ones have score 0 with each other. A query with fewer than k
    others gets all. Pairs with a vector too large for doubles to add exactly are ranked by the exact integer and
    shown as the nearest long. No usable vectors: no rows. To the driver come the counts for each length of vectors.
    """
    spark = embeddings.sparkSession
    rows, vertices = _vertices(embeddings, every, k)
    sizes = vertices.groupBy("d").agg(F.count("*").alias("n"), F.count_if("asked").alias("asked"), F.count_if("wide").alias("wide")).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def by_length(count: str, size: int) -> Column:
        return F.create_map(*(F.lit(x) for r in sizes for x in (r["d"], max(1, -(-r[count] // size)))))[F.col("d")]

    shards, blocks = by_length("n", shard), by_length("asked", block)
    found = _narrow(vertices.filter("NOT wide"), k, parts, shards, blocks, gathered)
    if any(r["wide"] for r in sizes):
        found = found.unionByName(_wide(vertices, k, shards, blocks))
    order = [F.col("score").desc(), F.col("beyond").desc()]
    best = found.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(*order, "node"))).filter(F.col("nth") <= k + 1)
    listed = best.join(vertices.select("node", "ids"), "node").select("query", "score", "beyond", F.explode("ids").alias("vec_id"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy(*order, "vec_id"))
    answers = listed.withColumn("nth", nth).filter(F.col("nth") <= k + 1).groupBy("query").agg(F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("answers"))

    # Each query's id finds its vector's answers; those of one vector may be many, so they are dealt over several tasks.
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")
    shown = vertices.filter("asked").join(answers, F.col("node") == F.col("query")).select("vector", "wide", "answers", salts)
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS)).cast("int"))
    others = F.slice(F.filter("answers", lambda a: a["vec_id"] != F.col("vec_id")), 1, k)
    out = queries.join(shown, ["vector", "wide", "salt"]).select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("at", "a"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("a.vec_id").alias("vec_id"), F.col("a.score").alias("score"))
