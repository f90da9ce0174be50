"""Merkle manifest of a data set: a root that vouches for every row, and a proof for each row.

Rows are leaves; those of one branch are ordered by a key, and runs of eight consecutive nodes become their parent until
one node, the subroot, is left. Subroots, in the order of their branches, become the root in the same way.

An aligned subtree of four levels of runs (4,096 leaves) is one block. A block's nodes lie in van Emde Boas order: the
upper half of its levels first, then each subtree of the lower half, each laid out in the same way. Where a node lies is
arithmetic on its depth and number alone, whatever the size of a cache line or page; the same arithmetic places the
nodes when a block is built and finds the siblings when a proof is read. The roots of blocks are the leaves of the next
round of blocks, until each branch has one block left. Proofs are read from the top round down: what a block's root
needs is known before its leaves are asked for.

Scale: texts are read once, by JVM functions, and not shuffled; what moves is two digests a row. Numbers within a branch
come from range partitions and one count for each partition and branch, so a branch with a third of all rows is spread
like any other. A task holds one block at a time, whatever the table's size; a round has 1/4,096 of the rows of the one
before. Only the number of leaves of the largest branch and that of the branches reach the driver.

Nulls in any column are told apart from empty values and are part of the digest. A null branch is the first one. Rows
without key come first in their branch. Repeated rows are leaves of their own, next to each other; equal leaves are
interchangeable. Rows with one key and different content are ordered by their digest. Very long texts are one digest
like any other. An empty table gives an empty result. Columns that are no part of the digest are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hangarline.llm.common import written

RUN = 8
BLOCK_HEIGHT = 4
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(value: Column) -> Column:
    """A value with its length in bytes, or `-` for null, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """SHA-256 of a row's fields, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def branch_key(value: Column) -> Column:
    """A key without nulls that sorts like the value, null first."""
    return F.coalesce(F.concat(F.lit(":"), value.cast("string")), F.lit("-"))


def block_levels(height: int) -> int:
    """How many nodes a complete subtree of this height has."""
    return (RUN ** (height + 1) - 1) // (RUN - 1)


def addresses(height: int, depth: int, numbers: np.ndarray) -> np.ndarray:
    """Where the nodes of these numbers at a depth lie in a subtree of this height, in van Emde Boas order."""
    if height == 0:
        return np.zeros_like(numbers)
    upper = (height + 1) // 2  # levels of the upper half; the lower half has the others
    if depth < upper:
        return addresses(upper - 1, depth, numbers)
    lower = height - upper
    tree, number = np.divmod(numbers, RUN ** (depth - upper))
    return block_levels(upper - 1) + tree * block_levels(lower) + addresses(lower, depth - upper, number)


def parent(children: bytes) -> bytes:
    """The digest, as hexadecimal text, of children's digests one after the other."""
    return sha256(children).hexdigest().encode()


class Block:
    """The nodes of one aligned subtree, 64 hexadecimal digits each, in van Emde Boas order."""

    def __init__(self, height: int, widths: list[int], nodes: np.ndarray):
        self.height, self.widths, self.nodes = height, widths, nodes

    @staticmethod
    def shape(leaves: int, is_top: bool) -> tuple[int, list[int]]:
        """Height and the number of nodes at each depth. A top block ends where one node is left; others are full height."""
        widths = [leaves]
        while widths[0] > 1 if is_top else len(widths) <= BLOCK_HEIGHT:
            widths.insert(0, -(-widths[0] // RUN))
        return len(widths) - 1, widths

    @classmethod
    def build(cls, leaves: np.ndarray, is_top: bool) -> Block:
        height, widths = cls.shape(len(leaves), is_top)
        block = cls(height, widths, np.zeros(block_levels(height), dtype="S64"))
        level = leaves
        for depth in range(height, -1, -1):
            block.nodes[addresses(height, depth, np.arange(widths[depth]))] = level
            text = level.tobytes()
            if depth:
                run = 64 * RUN
                level = np.array([parent(text[i : i + run]) for i in range(0, len(text), run)], dtype="S64")
        return block

    @classmethod
    def from_bytes(cls, leaves: int, is_top: bool, data: bytes) -> Block:
        height, widths = cls.shape(leaves, is_top)
        return cls(height, widths, np.frombuffer(data.hex().encode(), dtype="S64"))

    def to_bytes(self) -> bytes:
        return b"".join(bytes.fromhex(node.decode()) if node else bytes(32) for node in self.nodes.tolist())

    def level(self, depth: int) -> bytes:
        return self.nodes[addresses(self.height, depth, np.arange(self.widths[depth]))].tobytes()

    def root(self) -> bytes:
        return self.level(0)

    def siblings(self) -> list[list[tuple[bytes, bytes]]]:
        """For each depth, the leaves' first, what lies left and right of every node within its run."""
        found = []
        for depth in range(self.height, 0, -1):
            text, width, here = self.level(depth), self.widths[depth], []
            for number in range(width):
                low = number - number % RUN
                high = min(low + RUN, width)
                here.append((text[64 * low : 64 * number], text[64 * (number + 1) : 64 * high]))
            found.append(here)
        return found

    def path(self, siblings: list[list[tuple[bytes, bytes]]], leaf: int) -> list[tuple[bytes, bytes]]:
        """From a leaf to the block's root: what lies left and right of each node on the way."""
        return [here[leaf // RUN**up] for up, here in enumerate(siblings)]


def numbered(rows: DataFrame, branch: str, order: list[str]) -> DataFrame:
    """rows with `position`, from 0 within their branch in the given order, and the branch's `total`.

    Rows that agree in the order get a number of their own before they are dealt out, so that any number of copies
    is spread over tasks.
    """
    rows = written(rows.withColumn("own", F.monotonically_increasing_id()))
    keys = [branch, *order, "own"]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = written(dealt.select("*", F.spark_partition_id().alias("part"), within.alias("at")).drop("own"))
    parts = dealt.groupBy(branch, "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    of_branch = Window.partitionBy(branch)
    before = F.sum("n").over(of_branch.orderBy("part")) - F.col("n")
    starts = parts.select(branch, "part", (before - F.col("first")).alias("shift"), F.sum("n").over(of_branch).alias("total"))
    return dealt.join(written(starts), [branch, "part"]).withColumn("position", F.col("at") + F.col("shift")).drop("part", "at", "shift")


BLOCKS = "branch string, block long, total long, nodes binary, leaves int, root binary"
PAYLOAD = BLOCKS + ", keys array<long>, claims array<binary>"
LEAVES = RUN**BLOCK_HEIGHT


def _hexadecimal(digests: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()).hex().encode(), dtype="S64")


def _build(with_payload: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("position").combine_chunks()
        total = table["total"][0].as_py()
        block = Block.build(_hexadecimal(table["digest"]), total <= LEAVES)
        columns = {
            "branch": table["branch"].slice(0, 1),
            "block": table["block"].slice(0, 1),
            "total": table["total"].slice(0, 1),
            "nodes": pa.array([block.to_bytes()], pa.binary()),
            "leaves": pa.array([len(table)], pa.int32()),
            "root": pa.array([bytes.fromhex(block.root().decode())], pa.binary()),
        }
        if with_payload:
            columns["keys"] = pa.array([table["key"].to_pylist()], pa.list_(pa.int64()))
            columns["claims"] = pa.array([table["claim"].to_pylist()], pa.list_(pa.binary()))
        return pa.table(columns)

    return run


def grown(leaves: DataFrame, largest: int, with_payload: bool = False) -> tuple[list[DataFrame], DataFrame]:
    """Blocks by round, and the one node (branch, root) that is left of each branch.

    leaves: branch, position, total, digest; with payload also key and claim, which the first round's blocks keep.
    largest: the number of leaves of the largest branch.
    """
    rounds, tops, nodes = [], [], leaves
    while True:
        schema = PAYLOAD if with_payload and not rounds else BLOCKS
        grouped = nodes.withColumn("block", F.expr(f"position div {LEAVES}")).groupBy("branch", "block")
        blocks = written(grouped.applyInArrow(_build(schema == PAYLOAD), schema))
        rounds.append(blocks)
        tops.append(blocks.where(F.col("total") <= LEAVES).select("branch", "root"))
        if largest <= LEAVES:
            break
        largest = -(-largest // LEAVES)
        nodes = blocks.where(F.col("total") > LEAVES).select(
            "branch",
            F.col("block").alias("position"),
            F.expr(f"(total + {LEAVES - 1}) div {LEAVES}").alias("total"),
            F.col("root").alias("digest"),
        )
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    return rounds, roots


PATHS = "branch string, position long, lefts array<string>, rights array<string>, subroot string, root string"


def _paths(blocks: pa.Table, above: pa.Table) -> pa.Table:
    """What each leaf of a block needs up to the root; `above` is what the block's root needs."""
    schema = pa.schema(
        {
            "branch": pa.string(),
            "position": pa.int64(),
            "lefts": pa.list_(pa.string()),
            "rights": pa.list_(pa.string()),
            "subroot": pa.string(),
            "root": pa.string(),
        }
    )
    if not len(blocks) or not len(above):
        return schema.empty_table()
    row, over = blocks.to_pylist()[0], above.to_pylist()[0]
    block = Block.from_bytes(row["leaves"], row["total"] <= LEAVES, row["nodes"])
    siblings = block.siblings()
    paths = [block.path(siblings, leaf) for leaf in range(row["leaves"])]
    n = len(paths)
    return pa.table(
        {
            "branch": [row["branch"]] * n,
            "position": [row["block"] * LEAVES + leaf for leaf in range(n)],
            "lefts": [[left.decode() for left, _ in path] + over["lefts"] for path in paths],
            "rights": [[right.decode() for _, right in path] + over["rights"] for path in paths],
            "subroot": [over["subroot"]] * n,
            "root": [over["root"]] * n,
        },
        schema=schema,
    )


PROOFS = (
    "branch string, key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
    "verified boolean"
)


def _proofs(with_siblings: bool):
    def run(blocks: pa.Table, above: pa.Table) -> pa.Table:
        row, over = blocks.to_pylist()[0], above.to_pylist()[0]
        block = Block.from_bytes(row["leaves"], row["total"] <= LEAVES, row["nodes"])
        siblings, leaves = block.siblings(), block.level(block.height)
        higher = [(a.encode(), b.encode()) for a, b in zip(over["lefts"], over["rights"], strict=True)]
        found, proofs, folded = [], [], []
        for number, claim in enumerate(row["claims"]):
            path = block.path(siblings, number) + higher
            joined = [text for pair in path for text in pair]
            proofs.append(sha256(b"".join(joined)).hexdigest())
            node = leaves[64 * number : 64 * number + 64] if claim is None else claim.hex().encode()
            for left, right in path:
                node = parent(left + node + right)
            folded.append(node.decode())
            if with_siblings:
                text = b"".join(joined).decode()
                found.append([text[i : i + 64] for i in range(0, len(text), 64)])
        n = len(proofs)
        columns = {
            "branch": pa.array([row["branch"]] * n, pa.string()),
            "key": pa.array(row["keys"], pa.int64()),
            "leaf": pa.array([leaves[i : i + 64].decode() for i in range(0, len(leaves), 64)], pa.string()),
            "subroot": pa.array([over["subroot"]] * n, pa.string()),
            "root": pa.array([over["root"]] * n, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "folded_root": pa.array(folded, pa.string()),
            "verified": pa.array([x == over["root"] for x in folded], pa.bool_()),
        }
        if with_siblings:
            columns["siblings"] = pa.array(found, pa.list_(pa.string()))
        return pa.table(columns)

    return run


def _met(blocks: DataFrame, above: DataFrame, function, schema: str) -> DataFrame:
    """The function over each block and the one row of `above` for it."""
    return blocks.groupBy("branch", "block").cogroup(above.groupBy("branch", "position")).applyInArrow(function, schema)


def _descended(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """`above` for the blocks of the first round. tops: PATHS without position, one row for each branch."""
    paths = None
    for number in range(len(rounds) - 1, -1, -1):
        last = rounds[number].where(F.col("total") <= LEAVES).select("branch", F.col("block").alias("position"))
        above = last.join(tops, "branch")
        if paths is not None:
            above = above.unionByName(paths)
        above = written(above)
        if number == 0:
            return above
        paths = _met(rounds[number], above, _paths, PATHS)
    raise ValueError("no round of blocks")


def manifest(leaves: DataFrame, with_siblings: bool = False) -> DataFrame:
    """A proof for each leaf, checked against the root: one row for each row of leaves.

    leaves: branch (a string without nulls), key (long), digest (32 bytes), claim (the digest of the row as it is
    presented for checking, or null for the leaf's own). Result: branch, key, leaf, subroot, root, proof_sha256 (of the
    siblings from the leaf up to the root, left to right), folded_root (from the claim and the siblings), verified; on
    request the siblings themselves.
    """
    placed = written(numbered(leaves, "branch", ["key", "digest"]))
    branches = placed.groupBy("branch").agg(F.max("total").alias("total"))
    size = branches.agg(F.max("total").alias("largest"), F.count("*").alias("branches")).first()
    rounds, subroots = grown(placed, size.largest or 0, with_payload=True)
    subroots = written(subroots)
    ranked = numbered(subroots.select(F.lit("").alias("tree"), "branch", "root"), "tree", ["branch"])
    ranked = written(ranked)
    upper = ranked.select(F.lit("").alias("branch"), "position", "total", F.col("root").alias("digest"))
    upper_rounds, whole = grown(upper, size.branches)
    root = F.lower(F.hex("root"))
    top = whole.select(
        "branch",
        F.array().cast("array<string>").alias("lefts"),
        F.array().cast("array<string>").alias("rights"),
        F.lit("").alias("subroot"),
        root.alias("root"),
    )
    above = _descended(upper_rounds, top)
    places = _met(upper_rounds[0], above, _paths, PATHS).select("position", "lefts", "rights", "root")
    own = ranked.select("position", "branch", root.alias("subroot"))
    tops = written(own.join(places, "position").drop("position"))
    schema = PROOFS + (", siblings array<string>" if with_siblings else "")
    return _met(rounds[0], _descended(rounds, tops), _proofs(with_siblings), schema)


DOCUMENT_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def document_leaves(docs: DataFrame, claimed_text: Column) -> DataFrame:
    """Leaves of documents, by language and doc_id; the claim is that of the document with the claimed text."""
    columns = [F.col(name) for name in DOCUMENT_COLUMNS]
    claim = digest(*columns[:-1], claimed_text)
    return docs.select(
        branch_key(F.col("lang")).alias("branch"),
        F.col("doc_id").cast("long").alias("key"),
        digest(*columns).alias("digest"),
        claim.alias("claim"),
    )


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of documents, in which every row whose doc_id's crc32 is divisible by 3 is presented in lower case."""
    is_tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(is_tampered, F.translate(F.col("text"), UPPER, UPPER.lower())).otherwise(F.col("text"))
    leaves = document_leaves(docs, text)
    leaves = leaves.withColumn("claim", F.when(F.col("claim") != F.col("digest"), F.col("claim")))
    return manifest(leaves).drop("branch").withColumnRenamed("key", "doc_id")


def _oracle(levels: int = 8, branch_levels: int = 3) -> str:
    """The same rows in DuckDB's SQL, for up to 8**levels documents of a language and 8**branch_levels languages."""

    def fields(text: str) -> str:
        named = ["doc_id", "source", "lang", "n_chars", text]
        return " || ".join(f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')" for x in named)

    def tree(name: str, first: str, depth: int) -> list[str]:
        parts = [f"{name}0 AS ({first})"]
        for k in range(1, depth + 1):
            parts.append(
                f"{name}{k} AS (SELECT b, p // 8 AS p, any_value((n + 7) // 8) AS n, CASE WHEN any_value(n) = 1 THEN min(h) "
                f"ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h FROM {name}{k - 1} GROUP BY b, p // 8)"
            )
        for k in range(depth):
            run = "OVER (PARTITION BY b, p // 8 ORDER BY p ROWS BETWEEN"
            parts.append(
                f"{name}s{k} AS (SELECT b, p, n, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
            )
        return parts

    steps = [f"d{k}" for k in range(levels)] + [f"u{k}" for k in range(branch_levels)]
    joins = [f"JOIN ds{k} AS d{k} ON d{k}.b = q.b AND d{k}.p = q.p // {8**k}" for k in range(levels)]
    joins += [f"JOIN us{k} AS u{k} ON u{k}.p = v.p // {8**k}" for k in range(branch_levels)]
    folds, node = [], "claim"
    for k, step in enumerate(steps):
        folds.append(f"f{k} AS (SELECT *, CASE WHEN {step}n > 1 THEN sha256({step}l || {node} || {step}r) ELSE {node} END AS g{k} FROM {f'f{k - 1}' if k else 'j'})")
        node = f"g{k}"
    sides = ", ".join(f"{s}.n AS {s}n, {s}.l AS {s}l, {s}.r AS {s}r" for s in steps)
    proof = " || ".join(f"{s}l || {s}r" for s in steps)
    crc = (
        "list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0])), "
        "lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1)), 4294967295::BIGINT)"
    )
    lowered = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
    parts = [
        f"raw AS (SELECT doc_id, coalesce(':' || lang, '-') AS b, sha256({fields('text')}) AS leaf, "
        f"CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN sha256({fields(lowered)}) ELSE sha256({fields('text')}) END AS claim FROM documents)",
        "q AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY b) AS n FROM raw)",
        *tree("d", "SELECT b, p, n, leaf AS h FROM q", levels),
        f"v AS (SELECT b, h, row_number() OVER (ORDER BY b) - 1 AS p, count(*) OVER () AS n FROM d{levels})",
        *tree("u", "SELECT '' AS b, p, n, h FROM v", branch_levels),
        f"j AS (SELECT q.doc_id, q.leaf, q.claim, v.h AS subroot, w.h AS root, {sides} FROM q JOIN v ON v.b = q.b {' '.join(joins)} CROSS JOIN u{branch_levels} AS w)",
        *folds,
    ]
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, "
        f"{node} AS folded_root, {node} = root AS verified FROM f{len(steps) - 1}"
    )


ORACLE = _oracle()
