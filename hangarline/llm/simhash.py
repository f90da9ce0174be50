"""SimHash near-duplicates: fingerprints within a few bits of each other, linked into components by vantage-point trees.

Equal fingerprints are one point from here on. A vantage-point tree, built over a bounded sample, deals the points to shards:
at each node points within the median distance of the vantage point go to the inner side, the others to the outer
side, and those outside by no more than the linking distance are also copied to the inner side. By the triangle
inequality two linked points then meet in some shard. A shard goes on in the same way down to small leaves, where all
distances are computed. It returns a spanning forest of the links it finds, not the links, so a group of thousands of
near copies gives as many rows as it has points. Large-star and small-star steps join the shards' forests.

Scale: texts are read once and not shuffled; points are 16 bytes. The sample only decides where shards are cut, never
which links are found. Points of one shard are bounded on average by a parameter. The last join, of documents and
points, is one that adaptive execution splits where a fingerprint is hot.

Null text counts as empty; documents without words have the fingerprint zero and are linked like any other. Repeated
rows come back repeated, in one component. A null doc_id takes part and is never the smallest unless it is alone.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from hangarline.llm.common import fresh_name, shards_for, text_parts, written

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
POINTS_PER_SHARD = 1 << 12
SAMPLE_POINTS = 1 << 13
LEAF_POINTS = 512
PART_BYTES = 8 << 20
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of each run of words, joined by single spaces; of the whole sequence if it is shorter."""
    found = text.lower().split()  # on bytes both know ASCII only
    if not found:
        return []
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    if len(found) <= words:
        return [xxh64_intdigest(line, SEED)]
    spans = zip(starts[: len(starts) - words + 1].tolist(), (ends[words - 1 :] - 1).tolist(), strict=True)
    return [xxh64_intdigest(line[a:b], SEED) for a, b in spans]


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each run of hashes the bits set in over half of them. Bits are counted in the bytes of words, 255 at a time."""
    fingerprints = np.zeros(len(sizes), dtype=np.uint64)
    full = sizes > 0
    runs = sizes[full]
    if not len(runs):
        return fingerprints
    parts = -(-runs // 255)
    first_part = np.concatenate([[0], np.cumsum(parts)[:-1]])
    run_starts = np.concatenate([[0], np.cumsum(runs)[:-1]])
    within = np.arange(int(parts.sum())) - np.repeat(first_part, parts)
    part_starts = np.repeat(run_starts, parts) + 255 * within
    found = np.zeros(len(runs), dtype=np.uint64)
    for shift in range(8):
        lanes = (hashes >> np.uint64(shift)) & _LANES
        counts = np.add.reduceat(lanes, part_starts).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(counts.astype(np.int64), first_part, axis=0)
        for byte in range(8):
            majority = 2 * counts[:, byte] > runs
            found |= majority.astype(np.uint64) << np.uint64(8 * byte + shift)
    fingerprints[full] = found
    return fingerprints


def _fingerprint_batches(words: int):
    """The first columns of a batch with the fingerprint of its last column, the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(pc.fill_null(batch.columns[-1], ""), pa.binary())
            for low, high in text_parts(texts, PART_BYTES):
                part = texts.slice(low, high - low).to_pylist()
                hashes = [np.array(shingle_hashes(text, words), dtype=np.uint64) for text in part]
                sizes = np.array([len(x) for x in hashes], dtype=np.int64)
                bits = pa.array(majority_bits(np.concatenate(hashes), sizes).view(np.int64))
                others = [column.slice(low, high - low) for column in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*others, bits], [*batch.schema.names[:-1], "point"])

    return run


def content(text: Column) -> Column:
    """A hash that tells apart texts under one doc_id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, with_content: bool = False) -> DataFrame:
    """doc_id, point: the fingerprint as a signed 64-bit number; on request `content`."""
    more = [content(F.col("text")).alias("content")] if with_content else []
    rows = docs.select(F.col("doc_id").cast("long"), *more, F.col("text").cast("string"))
    return rows.mapInArrow(_fingerprint_batches(words), f"doc_id long, {'content long, ' if with_content else ''}point long")


def _bits_apart(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int64)


def vantage_split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point and a radius that leave points on both sides, or None. The one with the thinnest border of a few."""
    best = None
    for vantage in points[:: max(1, len(points) // 7)][:7]:
        apart = _bits_apart(points, vantage)
        radius = int(np.partition(apart, len(apart) // 2)[len(apart) // 2])
        for r in (radius - 1, radius):
            inner, border = int((apart <= r).sum()), int(((apart > r) & (apart <= r + MAX_BITS)).sum())
            cost = max(inner + border, len(points) - inner)
            if inner < len(points) and cost < len(points) and (best is None or cost < best[0]):
                best = (cost, vantage, r)
    return best and best[1:]


class Router:
    """The upper part of the tree: which shards a point goes to. Nodes are (vantage, radius, inner, outer) or a shard."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.shards = 0
        self.root = self._node(sample, shards)

    def _node(self, sample: np.ndarray, shards: int):
        split = vantage_split(sample) if shards > 1 and len(sample) > 1 else None
        if split is None:
            self.shards += 1
            return self.shards - 1
        inside = _bits_apart(sample, split[0]) <= split[1]
        inner = self._node(sample[inside], shards // 2)
        return (*split, inner, self._node(sample[~inside], shards - shards // 2))

    def route(self, points: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of points and their shards, a row for each shard that a point goes to."""
        numbers, shards, stack = [], [], [(self.root, np.arange(len(points)))]
        while stack:
            node, here = stack.pop()
            if isinstance(node, int):
                numbers.append(here)
                shards.append(np.full(len(here), node, dtype=np.int64))
                continue
            vantage, radius, inner, outer = node
            apart = _bits_apart(points[here], vantage)
            stack.append((inner, here[apart <= radius + max_bits]))
            stack.append((outer, here[apart > radius]))
        return np.concatenate(numbers), np.concatenate(shards)


def _forest(points: np.ndarray, max_bits: int) -> np.ndarray:
    """For each point the smallest number of those it is linked to, over any number of links; blocks of rows at a time."""
    labels = np.arange(len(points))
    while True:
        before = labels.copy()
        for low in range(0, len(points), LEAF_POINTS):
            linked = np.bitwise_count(points[low : low + LEAF_POINTS, None] ^ points[None, :]) <= max_bits
            labels[low : low + LEAF_POINTS] = np.where(linked, labels[None, :], len(points)).min(axis=1)
        labels = labels[labels]
        if (labels == before).all():
            return labels


def linked_points(points: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of all links among distinct points, as two arrays of points."""
    ends, roots, stack = [], [], [points]
    while stack:
        here = stack.pop()
        split = vantage_split(here) if len(here) > LEAF_POINTS else None
        if split is not None:
            apart = _bits_apart(here, split[0])
            inner, outer = here[apart <= split[1] + max_bits], here[apart > split[1]]
            if max(len(inner), len(outer)) < 0.95 * len(here):
                stack += [inner, outer]
                continue
        labels = _forest(here, max_bits)
        child = labels != np.arange(len(here))
        ends.append(here[child])
        roots.append(here[labels[child]])
    none = np.empty(0, dtype=np.uint64)
    return np.concatenate([none, *ends]), np.concatenate([none, *roots])


def _link_shard(max_bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        points = np.unique(pdf["point"].to_numpy(np.int64)).view(np.uint64)
        a, b = linked_points(points, max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()

    return run


def shard_links(points: DataFrame, max_bits: int = MAX_BITS, points_per_shard: int = POINTS_PER_SHARD) -> DataFrame:
    """Edges (a, b) between distinct points that connect exactly the points which links connect."""
    shards = shards_for(points.count(), points_per_shard)
    sample = points.orderBy(F.xxhash64("point")).limit(SAMPLE_POINTS).collect() if shards > 1 else []
    router = Router(np.array([row.point for row in sample], dtype=np.int64).view(np.uint64), shards)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            number, shard = router.route(values.view(np.uint64), max_bits)
            yield pa.RecordBatch.from_pydict({"shard": shard, "point": values[number]})

    routed = points.select("point").mapInArrow(route, "shard long, point long")
    routed = routed.repartition(router.shards, "shard")  # a task each: few bytes, but much work
    return routed.groupBy("shard").applyInPandas(_link_shard(max_bits), "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """node, root: for each node of the edges the smallest node that it is connected to (itself not listed as a root)."""
    edges = written(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct())
    while True:
        repeated = edges.groupBy("node").count().where("count > 1").select("node")
        chained = edges.join(edges.select(F.col("node").alias("root")), "root", "left_semi").select("node")
        if repeated.union(chained).isEmpty():
            return edges
        both = edges.union(edges.select("root", "node")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large.where("u <> v"))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select("v", "m").where("v <> m").union(smallest.select("u", "m"))
        edges = written(small.toDF("node", "root").distinct())


def _components(rows: DataFrame, max_bits: int) -> DataFrame:
    """point, root (the smallest point it is connected to), component_id, component_size. rows: doc_id, point."""
    points = written(rows.groupBy("point").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")))
    links = connected(shard_links(points, max_bits))
    rooted = points.join(links.withColumnRenamed("node", "point"), "point", "left")
    rooted = written(rooted.withColumn("root", F.coalesce("root", "point")))
    components = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("copies").alias("component_size"))
    return rooted.select("point", "root").join(components, "root")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id reachable), component_size."""
    rows = written(fingerprints(docs, words))
    placed = _components(rows, max_bits).drop("root")
    fingerprint = F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint")
    return rows.join(placed, "point").select("doc_id", fingerprint, "component_id", "component_size")


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with the columns of docs.

    Rows are told apart by doc_id and text, so that of two texts under one doc_id, in different components, neither is
    lost. Rows without doc_id stay, as no decision can name them.
    """
    rows = written(fingerprints(docs.select("doc_id", "text"), words, with_content=True))
    joined = rows.where("doc_id IS NOT NULL").join(_components(rows, max_bits).select("point", "root"), "point")
    least = joined.groupBy("root").agg(F.min(F.struct("doc_id", "content")).alias("least"))
    own, kept_id, kept_content = (fresh_name(docs, name) for name in ("own_content", "kept_id", "kept_content"))
    kept = least.select(F.col("least.doc_id").alias(kept_id), F.col("least.content").alias(kept_content))
    named = docs.where("doc_id IS NOT NULL").withColumn(own, content(F.col("text")))
    same = (F.col("doc_id") == F.col(kept_id)) & (F.col(own) == F.col(kept_content))
    stay = named.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
    return stay.unionByName(docs.where("doc_id IS NULL"))
