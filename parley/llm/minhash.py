"""Near-duplicates by weighted Jaccard similarity of word-shingle multisets: BagMinHash, bands, exact checks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import bags, free_name, mix, saved, slices, times

THRESHOLD = 0.8
BANDS, ROWS = 24, 5
#: Rounds in which one text of each bucket meets all the others there, before what is left is joined on rare shingles.
STARS = 2
#: Ratio between the bounds of one class of lengths, in the join on rare shingles.
LENGTH_STEP = 1.02

_U = np.uint64
_STEP, _PLACE, _SLOT = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)


def _uniform(x: np.ndarray) -> np.ndarray:
    """Doubles in (0, 1] from hashed bits."""
    return ((mix(x) >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53


def bag_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, slots: int = BANDS * ROWS) -> np.ndarray:
    """Signatures of multisets, (n_docs, slots) doubles; two documents agree in a slot with probability their weighted Jaccard similarity.

    Each element carries Poisson points in time and weight, the same in every document. The weights 0, 1, 2, 4, 8
    ... bound blocks, each with a process of its own of rate its length; a point's place within a block is refined
    by hashed bits, and it counts where the element's weight reaches beyond it. Each point falls into one slot, and
    a slot keeps its earliest time. Points are drawn in order of time and only as far as a document's slots need
    them, so heavy elements and long documents cost little more than light and short ones.
    """
    signature = np.full((n_docs, slots), np.inf)
    if not len(doc):
        return signature
    total = np.bincount(doc, weight, n_docs)
    parts = []
    low, rate = 0, 1
    index = np.arange(len(doc))
    while len(index):
        key = mix(element[index] ^ times(low, _PLACE))
        parts.append((doc[index], key, np.full(len(index), rate), weight[index] - low))
        low += rate
        rate = low
        index = index[weight[index] > low]
    doc, key, rate, reach = (np.concatenate(x) for x in zip(*parts, strict=True))
    arrival = -np.log(_uniform(key)) / rate
    limit = np.where(total > 0, slots * (np.log(slots) + 3) / np.maximum(total, 1), 0.0)
    pending = total > 0
    flat = signature.reshape(-1)
    while pending.any():
        live = np.flatnonzero(pending[doc] & (arrival <= limit[doc]))
        d, k, r, w, t = doc[live], key[live], rate[live], reach[live], arrival[live]
        step = 0
        while len(d):
            point = mix(k + times(2 * step + 1, _STEP))
            slot = (mix(point ^ _SLOT) % _U(slots)).astype(np.int64)
            inside = _uniform(point ^ _PLACE) * r <= w
            np.minimum.at(flat, d[inside] * slots + slot[inside], t[inside])
            step += 1
            t = t - np.log(_uniform(k + times(2 * step, _STEP))) / r
            go = t <= limit[d]
            d, k, r, w, t = d[go], k[go], r[go], w[go], t[go]
        pending &= (signature.max(axis=1) > limit) & (total > 0)
        limit = np.where(pending, 2 * limit, limit)
    return signature


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash for each band of a signature, (n_docs, bands)."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    out = np.arange(bands, dtype=np.uint64)[None, :] * _PLACE
    for k in range(rows):
        out = mix(out ^ bits[:, :, k])
    return out.view(np.int64)


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, mark, n, key, bands): a hash of each text and its number of shingles, a key equal for equal multisets only, and band hashes.

    Null ids are left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                n = batch.num_rows
                doc, element, count = bags(batch.column("text"))
                key = bag_keys(doc, element, count, n)
                signature = bag_minhash(doc, element, count, n, bands * rows)
                hashes = band_hashes(signature, bands, rows)
                yield pa.record_batch(
                    [
                        batch.column("doc_id"),
                        batch.column("mark"),
                        pa.array(np.bincount(doc, count, n).astype(np.int64)),
                        key,
                        pa.ListArray.from_arrays(np.arange(0, n * bands + 1, bands, dtype=np.int32), pa.array(hashes.reshape(-1))),
                    ],
                    names=["doc_id", "mark", "n", "key", "bands"],
                )

    return _marked(docs).mapInArrow(work, "doc_id long, mark long, n long, key binary, bands array<long>")


def _marked(docs: DataFrame) -> DataFrame:
    """(doc_id, text, mark) of rows with an id."""
    known = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text").filter("doc_id IS NOT NULL")
    return known.withColumn("mark", F.xxhash64("text"))


def bag_keys(doc: np.ndarray, element: np.ndarray, count: np.ndarray, n: int) -> pa.Array:
    """128 bits for each multiset, whatever its order: equal for equal multisets."""
    counted = mix(element + count.astype(np.uint64) * _PLACE)
    at = np.searchsorted(doc, np.arange(n + 1))
    key = np.stack([_sums(counted, at), _sums(mix(counted ^ _SLOT), at)], axis=1)
    return pa.array([k.tobytes() for k in key], pa.binary())


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def bag_sets(texts: DataFrame) -> DataFrame:
    """(key, n, bag) of (text): the multiset as a set of hashes of (shingle, how many of it came before), so set overlap is multiset overlap."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                doc, element, count = bags(batch.column("text"))
                first = np.cumsum(count) - count
                nth = np.arange(count.sum()) - np.repeat(first, count)
                items = mix(np.repeat(element, count) + nth.astype(np.uint64) * _PLACE)
                at = np.searchsorted(np.repeat(doc, count), np.arange(batch.num_rows + 1))
                key = bag_keys(doc, element, count, batch.num_rows)
                bag = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(items.view(np.int64)))
                yield pa.record_batch([key, pa.array(np.diff(at)), bag], names=["key", "n", "bag"])

    return texts.select("text").mapInArrow(work, "key binary, n long, bag array<long>")


def similar(pairs: DataFrame, bag: DataFrame, threshold: float) -> DataFrame:
    """Those (a, b) whose multisets overlap enough, exactly. Both joins may be split by Spark where one text is in many pairs."""
    left = bag.select(F.col("key").alias("b"), F.col("bag").alias("bag_b"))
    right = bag.select(F.col("key").alias("a"), F.col("bag").alias("bag_a"))
    size = F.size("bag_a") + F.size("bag_b")
    common = F.size(F.array_intersect("bag_a", "bag_b"))
    return pairs.join(left, "b").join(right, "a").filter(common >= F.lit(threshold) * (size - common)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of the edges (a, b) with the least node that it is connected to; labels and their labels' labels, until nothing moves."""
    both = saved(edges.union(edges.select("b", "a")).distinct(), "edges")
    root = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root"))
    root = saved(root, "roots")
    while True:
        near = both.join(root, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        nearer = root.join(near, F.col("node") == F.col("a")).select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        jump = root.select(F.col("node").alias("at"), F.col("root").alias("up"))
        moved = saved(nearer.join(jump, F.col("root") == F.col("at")).select("node", F.least("root", "up").alias("root"), "was"), "roots")
        root = moved.select("node", "root")
        if moved.filter("root <> was").isEmpty():
            return root


def rare_pairs(members: DataFrame, bag: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of members (key, comp, n) of different comp that may be similar enough: every pair that is, and few others.

    Only shingles that occur in several comps can be common to a pair, and a similar pair shares at least
    t / (1 + t) of its joint length. So a text meets texts of certain lengths only, and two similar texts share
    one of the rarest shingles of each, early enough for what follows to make up the rest. Lengths are joined
    by classes; a text of many own shingles has few or none to meet, so a group of texts that are alike, but not
    enough, costs no pairs.
    """
    share = threshold / (1 + threshold)
    items = bag.select("key", "bag").join(members, "key").select("key", "comp", "n", F.explode("bag").alias("item"))
    common = items.groupBy("item").agg(F.count("*").alias("often"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    rare = items.join(common.select("item", "often"), "item").groupBy("key", "comp", "n").agg(F.sort_array(F.collect_list(F.struct("often", "item"))).alias("shared"))
    own = F.col("n") - F.size("shared")
    first = F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1 - own
    rare = rare.withColumn("own", own).withColumn("first", first).filter("first > 0")
    # Whom a text may meet: no longer than itself, and together no longer than its shared shingles allow.
    rare = rare.withColumn("both", F.floor(F.size("shared") / F.lit(share) + 1e-6))
    rare = rare.select("key", "comp", "n", "own", "both", F.posexplode(F.slice("shared", F.lit(1), F.least(F.col("first"), F.size("shared")).cast("int"))).alias("at", "s"))
    rare = rare.select("key", "comp", "n", "both", (F.col("own") + F.col("at")).alias("at"), F.col("s.item").alias("item"))

    def length_class(n: Column) -> Column:
        return F.floor(F.log(n) / F.lit(math.log(LENGTH_STEP)))

    shorter = rare.select("item", length_class(F.col("n")).alias("length"), *(F.col(c).alias(f"{c}_b") for c in ("key", "comp", "n", "at", "both")))
    least, most = F.ceil(F.lit(threshold) * F.col("n") - 1e-6), F.least(F.col("n"), F.col("both") - F.col("n"))
    longer = rare.filter(least <= most).withColumn("length", F.explode(F.sequence(length_class(least), length_class(most))))
    longer = longer.select("item", "length", *(F.col(c).alias(f"{c}_a") for c in ("key", "comp", "n", "at", "both")))
    rest, length = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")), F.col("n_a") + F.col("n_b")
    met = (F.col("comp_a") != F.col("comp_b")) & (F.col("n_b") <= F.col("n_a")) & (length <= F.least("both_a", "both_b")) & (rest + 1e-6 >= F.lit(share) * length)
    pairs = longer.join(shorter, (longer["item"] == shorter["item"]) & (longer["length"] == shorter["length"]) & met)
    return pairs.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b")).distinct()


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, mark, class): one row for each distinct id and text, `class` equal where texts are linked directly or through others.

    Two texts are linked when their multisets of five-word shingles have a weighted Jaccard similarity of
    `threshold` or more. Texts with equal multisets are one representative from the start, so copies are never
    paired. In each bucket of equal bands one representative meets all that are not yet connected to it and then
    leaves the bucket; buckets whose members are all connected are done. After `STARS` such rounds, which link most
    of any group of near copies at a cost in proportion to the buckets, what is still apart is joined on rare
    shingles. So every two similar representatives that share a bucket end in one class, without all pairs of a bucket.
    """
    sig = saved(signatures(docs, bands, rows).dropDuplicates(["doc_id", "mark"]), "signatures")
    reps = sig.filter("n > 0").groupBy("key").agg(F.min(F.struct("doc_id", "mark", "n", "bands")).alias("s")).select("key", "s.*")
    reps = saved(reps, "representatives")
    spread = reps.select("key", "n", F.explode("bands").alias("bucket"))
    size = saved(spread.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1"), "sizes")
    at = saved(spread.join(size, "bucket"), "buckets")
    # Who shares many crowded buckets is near the middle of a group of near copies and links most of it in one round.
    middle = at.groupBy("key").agg(F.sum("m").alias("weight"))
    at = saved(at.drop("m").join(middle, "key").withColumn("comp", F.col("key")), "buckets")

    wanted = reps.join(middle, "key", "left_semi").select("doc_id", "mark")
    texts = _marked(docs).join(wanted, ["doc_id", "mark"], "left_semi").dropDuplicates(["doc_id", "mark"])
    bag = saved(bag_sets(texts).dropDuplicates(["key"]), "bags")

    links, label = None, None
    for turn in range(STARS + 1):
        if turn < STARS:
            order = F.struct((-F.col("weight") if turn == 0 else F.xxhash64("key")).alias("h"), "key", "comp", "n")
            lead = at.groupBy("bucket").agg(F.min(order).alias("lead")).select("bucket", *(F.col(f"lead.{c}").alias(f"{c}_a") for c in ("key", "comp", "n")))
            met = at.join(saved(lead, "leaders"), "bucket")
            alike = F.least("n", "n_a") >= F.lit(threshold) * F.greatest("n", "n_a")
            pairs = met.filter((F.col("comp") != F.col("comp_a")) & alike).select(F.least("key", "key_a").alias("a"), F.greatest("key", "key_a").alias("b")).distinct()
        else:
            pairs = rare_pairs(at.select("key", "comp", "n").distinct(), bag, threshold)
        found = similar(pairs, bag, threshold)
        links = saved(found if links is None else links.union(found), "links")
        label = components(links)
        if turn < STARS:
            left = met.filter("key <> key_a").select("bucket", "key", "n", "weight")
            left = left.join(label, F.col("key") == F.col("node"), "left").withColumn("comp", F.coalesce("root", "key")).drop("node", "root")
            mixed = left.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
            at = saved(left.join(saved(mixed.select("bucket"), "mixed"), "bucket"), "unsettled")
            if at.isEmpty():
                break
    named = saved(reps.select("key").join(label, F.col("key") == F.col("node"), "left").select("key", F.coalesce("root", "key").alias("class")), "classes")
    # A text without a word is a class of its own for each id.
    alone = F.concat(F.col("doc_id").cast("string"), F.lit("|"), F.col("mark").cast("string")).cast("binary")
    return sig.select("doc_id", "mark", "key").join(named, "key", "left").select("doc_id", "mark", F.coalesce("class", alone).alias("class"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, class_size): the class of each document, named after its least doc_id, and how many documents it has.

    A class holds the texts that are linked, directly or through others (see `classes`). Texts without a word
    (null, empty) belong to no group: each is its own class. A row without doc_id takes no part. Rows that repeat
    an id and its text give one row; an id with several texts gives a row for each class that these are in.
    """
    found = saved(classes(docs, threshold).select("doc_id", "class").distinct(), "members")
    size = saved(found.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")), "sizes")
    return found.join(size, "class").select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents less all but one of each near-duplicate class: the one with the least doc_id, once.

    What is judged is the row's own text: an id with several texts may keep some of them. Rows without doc_id stay
    as they are. All columns stay.
    """
    kept = classes(docs, threshold).groupBy("class").agg(F.min(F.struct("doc_id", "mark")).alias("s")).select("s.*")
    row, at = free_name(docs, "kept_row"), free_name(docs, "kept_id")
    kept = kept.select(F.struct(F.col("doc_id").alias("id"), "mark").alias(at))
    whole = docs.select(F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("mark")).alias(at), F.struct("*").alias(row))
    plain = [F.col(f"{row}.{f.name}") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    once = whole.filter(F.col(f"{at}.id").isNotNull()).join(kept, at).groupBy(at).agg(F.min_by(row, F.xxhash64(*plain)).alias(row))
    return once.select(f"{row}.*").unionByName(docs.filter("doc_id IS NULL"))
