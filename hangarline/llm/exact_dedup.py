"""Exact deduplication against a minimal perfect hash over the digests seen so far.

The rows are read in order of arrival, which is the order of doc_id: ids up to a cutoff are the history, later ids
are new arrivals. The history's distinct digests are spread over shards by their first bytes; each shard holds a
minimal perfect hash whose slots carry the full digest and the locator of the document that stays. An arriving digest
is looked up by hash and compared byte by byte; members join the stored winner, the rest are grouped among themselves.

Scale: copies are counted before any shuffle of digests, so a text that makes up a third of all rows is one row per
task; shards hold a bounded number of digests whatever the table's size; the last join is between documents and
groups on the digest, which adaptive execution splits where one digest is hot. No text is shuffled.

Null text counts as empty. Equal texts: the smallest doc_id stays. Repeated rows with one doc_id are copies of each
other and are all returned, all marked as kept if that id stays. A null doc_id never stays unless its group has no
other id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangarline.llm.common import fresh_name, shards_for, written

DIGESTS_PER_SHARD = 1 << 15
#: Bits per key and level of the minimal perfect hash; more means fewer levels.
LEVEL_LOAD = 2.0


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each key for the given level."""
    h = keys + np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class MinimalPerfectHash:
    """Levels of bits: a key owns a bit of the first level where no other key meets it; its rank there is its slot."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ones = [int(np.bitwise_count(words).sum()) for words in levels]
        self.starts = np.concatenate([[0], np.cumsum(ones)]).astype(np.int64)
        self.ranks = [np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]) for words in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalPerfectHash:
        """keys: distinct unsigned 64-bit numbers."""
        levels, rest = [], keys
        while len(rest):
            words = max(1, -(-int(len(rest) * LEVEL_LOAD) // 64))
            bits = _mixed(rest, len(levels)) % np.uint64(words * 64)
            hits = np.bincount(bits.astype(np.int64), minlength=words * 64)
            levels.append(np.packbits(hits == 1, bitorder="little").view(np.uint64))
            rest = rest[hits[bits.astype(np.int64)] > 1]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys that cannot be members (others may get a slot that is not theirs)."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, words in enumerate(self.levels):
            bits = _mixed(keys[open_], level) % np.uint64(len(words) * 64)
            word, bit = (bits >> np.uint64(6)).astype(np.int64), bits & np.uint64(63)
            found = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slot = self.starts[level] + self.ranks[level][word] + np.bitwise_count(below)
            out[open_[found]] = slot[found]
            open_ = open_[~found]
        return out

    def to_bytes(self) -> list[bytes]:
        return [words.tobytes() for words in self.levels]

    @classmethod
    def from_bytes(cls, levels: list[bytes]) -> MinimalPerfectHash:
        return cls([np.frombuffer(level, dtype=np.uint64) for level in levels])


def _digest_bytes(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(len(digests), 32)


def _keys(digests: np.ndarray) -> np.ndarray:
    """The hash works on bytes 8 to 15; digests that agree there (never seen for SHA-256) are told apart by a chain."""
    return np.ascontiguousarray(digests[:, 8:16]).view(np.uint64).ravel()


def _build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """One index row: the hash, and per slot the digest, the locator of the winner and the number of copies.

    Digests that share a hash key go to the overflow list, which lookups compare in full.
    """
    digests = _digest_bytes(pdf["digest"])
    keys = _keys(digests)
    _, first = np.unique(keys, return_index=True)
    main = np.zeros(len(keys), dtype=bool)
    main[first] = True
    hashed = MinimalPerfectHash.build(keys[main])
    order = np.empty(int(main.sum()), dtype=np.int64)
    order[hashed.slots(keys[main])] = np.flatnonzero(main)
    order = np.concatenate([order, np.flatnonzero(~main)]).astype(np.int64)
    return pd.DataFrame(
        {
            "shard": [int(pdf["shard"].iloc[0])],
            "levels": [hashed.to_bytes()],
            "n_hashed": [int(main.sum())],
            "digests": [digests[order].tobytes()],
            "locators": [pdf["keep_id"].to_numpy(np.int64)[order].tobytes()],
            "absent": [pdf["absent"].to_numpy(bool)[order].tobytes()],
            "copies": [pdf["copies"].to_numpy(np.int64)[order].tobytes()],
        }
    )


INDEX_SCHEMA = (
    "shard long, levels array<binary>, n_hashed long, digests binary, locators binary, absent binary, copies binary"
)


def build_index(groups: DataFrame) -> DataFrame:
    """groups: distinct (shard, digest) with keep_id and copies. One row per shard."""
    return groups.groupBy("shard").applyInPandas(_build_shard, INDEX_SCHEMA)


ANSWER = ["digest", "keep_id", "absent", "copies", "member"]


def _look_up(index: pd.DataFrame, arrivals: pd.DataFrame) -> pd.DataFrame:
    """Rows of the history and of the arrivals; an arrival that is a member takes the stored locator."""
    if index.empty:
        return arrivals.assign(member=False)[ANSWER]
    row = index.iloc[0]
    digests = np.frombuffer(row["digests"], dtype=np.uint8).reshape(-1, 32)
    locators = np.frombuffer(row["locators"], dtype=np.int64)
    absent = np.frombuffer(row["absent"], dtype=bool)
    copies = np.frombuffer(row["copies"], dtype=np.int64)
    names = [digest.tobytes() for digest in digests]
    stored = pd.DataFrame({"digest": names, "keep_id": locators, "absent": absent, "copies": copies, "member": True})
    if arrivals.empty:
        return stored
    asked = _digest_bytes(arrivals["digest"])
    hashed, n_hashed = MinimalPerfectHash.from_bytes(list(row["levels"])), int(row["n_hashed"])
    slots = hashed.slots(_keys(asked))
    same = np.zeros(len(asked), dtype=bool)
    possible = slots >= 0
    same[possible] = (digests[slots[possible]] == asked[possible]).all(axis=1)
    for slot in range(n_hashed, len(digests)):
        equal = (asked == digests[slot]).all(axis=1)
        slots[equal], same[equal] = slot, True
    members = arrivals[same].assign(keep_id=locators[slots[same]], absent=absent[slots[same]], member=True)
    return pd.concat([stored, members[ANSWER], arrivals[~same].assign(member=False)[ANSWER]], ignore_index=True)


def exact_duplicates(docs: DataFrame, digests_per_shard: int = DIGESTS_PER_SHARD) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, and whether the digest was met in the history."""
    digests = written(docs.select("doc_id", F.unhex(F.sha2(normalized(F.col("text")), 256)).alias("digest")))
    size = digests.agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    cutoff = None if size.low is None else size.low + (size.high - size.low) // 2
    shards = shards_for(size.n, digests_per_shard)

    def groups(side: DataFrame) -> DataFrame:
        shard = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long") % shards
        counted = side.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
        keep_id, absent = F.coalesce("first", F.lit(0)).cast("long"), F.isnull("first")
        return counted.select(shard.alias("shard"), "digest", keep_id.alias("keep_id"), absent.alias("absent"), "copies")

    early = F.coalesce(F.col("doc_id") <= F.lit(cutoff), F.lit(False))
    index = build_index(groups(digests.where(early)))
    answers = (
        index.groupBy("shard")
        .cogroup(groups(digests.where(~early)).groupBy("shard"))
        .applyInPandas(_look_up, "digest binary, keep_id long, absent boolean, copies long, member boolean")
    )
    classes = answers.groupBy("digest").agg(
        F.min(F.when(~F.col("absent"), F.col("keep_id"))).alias("keep_id"),
        F.sum("copies").alias("group_size"),
        F.max("member").alias("in_history"),
    )
    classes = written(classes)  # so that nothing but the join reads its exchange, and a hot digest can be split
    return digests.join(classes, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "in_history",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with the columns of docs: of equal texts the row with the smallest doc_id, once.

    Rows are told apart by doc_id and text, so that of two texts under one doc_id neither is lost. Rows without
    doc_id stay, as no decision can name them.
    """
    own, kept_id, kept_digest = (fresh_name(docs, name) for name in ("own_digest", "kept_id", "kept_digest"))
    kept = exact_duplicates(docs.select("doc_id", "text")).where("kept AND doc_id IS NOT NULL")
    kept = kept.select(F.col("doc_id").alias(kept_id), F.unhex("text_sha256").alias(kept_digest)).distinct()
    rows = docs.where("doc_id IS NOT NULL").withColumn(own, F.unhex(F.sha2(normalized(F.col("text")), 256)))
    same = (F.col("doc_id") == F.col(kept_id)) & (F.col(own) == F.col(kept_digest))
    stay = rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
    return stay.unionByName(docs.where("doc_id IS NULL"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256),
p AS (SELECT min(doc_id) + (max(doc_id) - min(doc_id)) // 2 AS cutoff FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256, coalesce(keep_id <= cutoff, false) AS in_history
FROM d JOIN g USING (text_sha256), p
"""
