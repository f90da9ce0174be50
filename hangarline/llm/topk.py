"""Exact top-k by inner product with best-first search in M-trees.

Each shard of vectors becomes an M-tree. The inner product is turned into a metric by one more coordinate, which gives
all vectors of a shard the same length; nearer then means a larger product. A node is a page of entries: vectors in
leaves, routing objects with covering radii above, each with its distance to the page's parent. A query opens pages in the order of
their lower bounds and ends when the next bound exceeds its k-th distance. Before a distance is computed, the stored
parent distance must not rule the entry out by the triangle inequality. Scores are exact integers.

Scale: a shard holds a bounded number of vectors and is one task's tree, kept as one row of binary pages; queries come in blocks of
bounded size, and each (shard, block) is a task. A shard returns k rows for a query, which are cut to k again before
and after the last shuffle.

Vectors that are null, or hold null or non-finite components, and rows without vec_id take no part. Rows that repeat a vec_id
are candidates each, for each other too: only one row equal to the query in id and vector is its own. Rows equal in both are one entry with
a number of copies, so a row repeated without end is no hot shard. Queries equal in both are one query; queries that share an id
alone are answered each, under that id. Products are computed in floating point where they stay exact, else in whole numbers; scores are 64-bit. Vectors of different lengths are not compared; empty
vectors are compared with each other, with score 0. Ties go to the smaller
vec_id. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hangarline.llm.common import shards_for, written

K = 5
SCALE = 256
QUERY_EVERY = 50
PAGE_ENTRIES = 256
FAN_OUT = 64
VECTORS_PER_SHARD = 1 << 13
QUERIES_PER_BLOCK = 1 << 12
#: Slack of the bounds for rounding; products are exact, square roots are not.
SLACK = 1e-6
#: Whole numbers up to this are exact in floating point.
EXACT = 2.0**53


def quantized(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector: floor(SCALE * x) of each component, for rows that take part."""
    value = F.col("embedding").cast("array<double>")
    fine = F.forall(value, lambda x: F.isnotnull(x) & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    scaled = F.transform(value, lambda x: F.floor(F.lit(float(SCALE)) * x).cast("long"))
    return rows.select(F.col("vec_id").cast("long"), scaled.alias("vector"))


class MTree:
    """Pages of a tree over the rows of an integer matrix; the product with a query is the measure of nearness."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray | None = None):
        self.ids, self.whole, self.vectors = ids, vectors.astype(np.int64), vectors.astype(np.float64)
        self.copies = np.ones(len(ids), dtype=np.int64) if copies is None else copies
        norms = (self.vectors**2).sum(axis=1)
        self.norm = float(norms.max())
        self.extra = np.sqrt(self.norm - norms)
        self.pages: list[tuple[bool, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.root = self._build(np.arange(len(ids)), None)
        self.matrices = [self.vectors[page[1]] for page in self.pages]

    def _distances(self, rows: np.ndarray, to: int) -> np.ndarray:
        products = self.vectors[rows] @ self.vectors[to] + self.extra[rows] * self.extra[to]
        return np.sqrt(np.maximum(0.0, 2 * self.norm - 2 * products))

    def _page(self, leaf: bool, rows: np.ndarray, radii: np.ndarray, children: np.ndarray, parent: int | None) -> int:
        to_parent = self._distances(rows, parent) if parent is not None else np.zeros(len(rows))
        self.pages.append((leaf, rows, radii, children, to_parent))
        return len(self.pages) - 1

    def _build(self, rows: np.ndarray, parent: int | None) -> int:
        if len(rows) <= PAGE_ENTRIES:
            return self._page(True, rows, np.zeros(len(rows)), np.zeros(len(rows), dtype=np.int64), parent)
        fan_out = min(FAN_OUT, -(-len(rows) // (PAGE_ENTRIES // 2)))
        routing = rows[np.linspace(0, len(rows) - 1, fan_out).astype(np.int64)]
        nearest = np.argmin(np.stack([self._distances(rows, to) for to in routing]), axis=0)
        groups = [rows[nearest == i] for i in range(fan_out)]
        if max(map(len, groups)) == len(rows):  # all alike
            groups = np.array_split(rows, fan_out)
        kept = [(to, group) for to, group in zip(routing.tolist(), groups, strict=True) if len(group)]
        radii = np.array([self._distances(group, to).max() for to, group in kept])
        children = np.array([self._build(group, to) for to, group in kept], dtype=np.int64)
        return self._page(False, np.array([to for to, _ in kept], dtype=np.int64), radii, children, parent)

    def _others(self, rows: np.ndarray, own_id: int, query: np.ndarray, k: int) -> np.ndarray:
        """How many copies of each row can be among the k best of the query, which itself is one copy of its row."""
        copies = self.copies[rows]
        own = np.flatnonzero(self.ids[rows] == own_id)
        if len(own):
            copies = copies.copy()
            copies[own] -= (self.whole[rows[own]] == query).all(axis=1)
        return np.minimum(copies, k)

    def search(self, own_id: int, whole: np.ndarray, k: int) -> tuple[list[tuple[int, int]], int]:
        """The k best (score, id), ties to the smaller id, without one row equal to the query; and how many products were computed."""
        query, computed = whole.astype(np.float64), 0
        length = float(query @ query)
        exact = length * self.norm < EXACT**2  # no product, and no part of its sum, is larger than the product of the lengths
        best_scores, best_ids = np.empty(0), np.empty(0, dtype=np.int64)
        reach = np.inf
        queue = [(0.0, 0, self.root, np.nan)]  # lower bound, order, page, distance to the page's parent
        pushed = 1
        while queue:
            bound, _, number, to_parent = heapq.heappop(queue)
            if bound > reach:
                break
            leaf, rows, radii, children, parent_distances = self.pages[number]
            vectors = self.matrices[number]
            if to_parent == to_parent and reach < np.inf:
                open_ = np.abs(to_parent - parent_distances) - radii <= reach
                if not open_.all():
                    rows, radii, children, vectors = rows[open_], radii[open_], children[open_], vectors[open_]
            products = vectors @ query
            computed += len(rows)
            if leaf:
                if not exact:
                    products = self.whole[rows].astype(object) @ whole.astype(object)
                if len(best_scores) == k:
                    better = products >= best_scores[-1]
                    if not better.any():
                        continue
                    products, rows = products[better], rows[better]
                copies = self._others(rows, own_id, whole, k)
                scores = np.concatenate([best_scores, np.repeat(products, copies)])
                ids = np.concatenate([best_ids, np.repeat(self.ids[rows], copies)])
                order = np.lexsort((ids, -scores))[:k] if exact else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
                best_scores, best_ids = scores[order], ids[order]
                if len(best_scores) == k:
                    reach = np.sqrt(max(0.0, length + self.norm - 2 * float(best_scores[-1]))) * (1 + SLACK)
                    reach += SLACK * (1 + np.sqrt(length + self.norm))
            else:
                distances = np.sqrt(np.maximum(0.0, length + self.norm - 2 * products))
                bounds = np.maximum(0.0, distances - radii)
                for low, child, distance in zip(bounds.tolist(), children.tolist(), distances.tolist(), strict=True):
                    if low <= reach:
                        heapq.heappush(queue, (low, pushed, child, distance))
                        pushed += 1
        return list(zip(map(int, best_scores.tolist()), best_ids.tolist(), strict=True)), computed

    def to_row(self) -> dict:
        """The pages end to end, as binary columns."""
        names = ("rows", "radii", "children", "to_parent")
        return {
            "ids": self.ids.astype(np.int64).tobytes(),
            "copies": self.copies.astype(np.int64).tobytes(),
            "vectors": self.whole.tobytes(),
            "root": self.root,
            "leaves": np.array([page[0] for page in self.pages]).tobytes(),
            "sizes": np.array([len(page[1]) for page in self.pages], dtype=np.int64).tobytes(),
        } | {name: np.concatenate([page[i] for page in self.pages]).tobytes() for i, name in enumerate(names, start=1)}

    @classmethod
    def from_row(cls, row: pd.Series) -> MTree:
        tree = cls.__new__(cls)
        tree.ids = np.frombuffer(row["ids"], dtype=np.int64)
        tree.copies = np.frombuffer(row["copies"], dtype=np.int64)
        tree.whole = np.frombuffer(row["vectors"], dtype=np.int64).reshape(len(tree.ids), int(row["dimension"]))
        tree.vectors = tree.whole.astype(np.float64)
        tree.norm, tree.root = float((tree.vectors**2).sum(axis=1).max()), int(row["root"])
        leaves = np.frombuffer(row["leaves"], dtype=bool)
        cuts = np.cumsum(np.frombuffer(row["sizes"], dtype=np.int64))[:-1]
        kinds = {"rows": np.int64, "radii": np.float64, "children": np.int64, "to_parent": np.float64}
        columns = [np.split(np.frombuffer(row[name], dtype=kind), cuts) for name, kind in kinds.items()]
        tree.pages = list(zip(leaves.tolist(), *columns, strict=True))
        tree.matrices = [tree.vectors[page[1]] for page in tree.pages]
        return tree


INDEX_SCHEMA = (
    "dimension int, shard long, ids binary, copies binary, vectors binary, root long, leaves binary, sizes binary, rows binary, "
    "radii binary, children binary, to_parent binary"
)


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id", kind="stable")
    dimension = int(pdf["dimension"].iloc[0])
    vectors = np.array(pdf["vector"].tolist(), dtype=np.int64).reshape(len(pdf), dimension)
    tree = MTree(pdf["vec_id"].to_numpy(np.int64), vectors, pdf["copies"].to_numpy(np.int64))
    return pd.DataFrame([{"dimension": dimension, "shard": pdf["shard"].iloc[0]} | tree.to_row()])


def build_index(vectors: DataFrame, shards: int) -> DataFrame:
    """One tree for each shard and vector length, of vec_id, vector, copies; kept as a written table by `top_k`."""
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards))
    placed = vectors.withColumn("dimension", F.size("vector")).withColumn("shard", shard)
    return placed.groupBy("dimension", "shard").applyInPandas(_build_shard, INDEX_SCHEMA)


def _search_shard(k: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, row in index.iterrows():
            tree = MTree.from_row(row)
            for query, query_id, vector in zip(queries["query"].tolist(), queries["query_id"].tolist(), queries["vector"], strict=True):
                best, computed = tree.search(query_id, np.asarray(vector, dtype=np.int64), k)
                found += [(query, query_id, vec_id, score, computed) for score, vec_id in best]
        return pd.DataFrame(found, columns=["query", "query_id", "vec_id", "score", "computed"])

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, vectors_per_shard: int = VECTORS_PER_SHARD
) -> DataFrame:
    """query_id, rank, vec_id, score: of integer vectors (vec_id, vector), for queries of the same form."""
    entries = written(vectors.groupBy("vec_id", "vector").agg(F.count("*").alias("copies")))
    asked = queries.select(F.col("vec_id").alias("query_id"), "vector").distinct()
    asked = written(asked.withColumn("query", F.monotonically_increasing_id()))
    shards = shards_for(entries.count(), vectors_per_shard)
    blocks = shards_for(asked.count(), QUERIES_PER_BLOCK)
    index = written(build_index(entries, shards))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    asked = asked.withColumn("dimension", F.size("vector")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    trees = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys, tasks = ["dimension", "shard", "block"], shards * blocks  # a task each: few bytes, but much work
    asked = asked.withColumn("shard", F.col("shard").cast("long"))
    trees = trees.withColumn("block", F.col("block").cast("long")).repartition(tasks, *keys)
    answers = trees.groupBy(*keys).cogroup(asked.repartition(tasks, *keys).groupBy(*keys))
    rows = answers.applyInPandas(_search_shard(k), "query long, query_id long, vec_id long, score long, computed long")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def embedding_neighbours(embeddings: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """The k rows of the largest integer product for each row whose vec_id is a multiple of `every`."""
    vectors = quantized(embeddings)
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS own, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), a AS (SELECT vec_id, q, min(own) AS own FROM v WHERE vec_id % 50 = 0 GROUP BY vec_id, q
), s AS (
  SELECT a.own, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[]) AS BIGINT) AS score
  FROM a JOIN v b ON a.own <> b.own AND len(a.q) = len(b.q)
), r AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
