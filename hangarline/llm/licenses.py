"""License scans by diagonal voting.

Every run of three words of every document is hashed and joined to the runs of known phrases and notices. A hit votes for
the diagonal (document position minus template position); diagonals a few words apart are neighbours and make one span,
which covers insertions and omissions. Spans are then checked on the words themselves: phrases must stand word for
word, of longer notices most words must be there in order.

Scale: the runs' hashes meet a broadcast table whose size is fixed by the templates below, so the many rows are neither
shuffled nor sorted; only hits are, after their votes are counted. Texts go to their spans in one join, which adaptive
execution makes a broadcast where few documents have hits. Spans of one document are bounded by its length.

Null text counts as empty. Documents without a place have null first_word and last_word and empty label strings. Rows
that repeat a doc_id are each checked on their own text. Rows without doc_id get their votes by
a hash of their text. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hangarline.llm.common import text_parts

RUN_WORDS = 3
#: Diagonals of one template that are so many words apart or fewer are neighbours.
NEIGHBOUR_WORDS = 3
MIN_COVERAGE = 0.8
#: Of a notice's runs so many must have voted for a span; one changed word takes three runs' votes away.
MIN_VOTES = 0.25
PART_BYTES = 4 << 20

#: Phrases that count word for word, and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
#: Well-known notices, of which most words must be found in order.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("gnu general public license as published by the free software foundation", "gpl"),
    ("gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("all rights reserved", "all-rights-reserved"),
]
TEMPLATES = [(text.split(), label, True) for text, label in PHRASES] + [(t.split(), label, False) for t, label in NOTICES]

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased."""
    return WORD.findall(text.lower())


def _fold_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    for low, high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
        table[low:high] = np.arange(low, high)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


_FOLD = _fold_table()
_BASE = 0x100000001B3
_FACTORS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def _powers(count: int) -> np.ndarray:
    powers = np.full(max(1, count), _BASE, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def run_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run of words: its text, the position of its first word, its hash; and the words of each text."""
    joined = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    folded = _FOLD[joined]
    inside = folded != 0
    edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    lengths = ends - starts
    text_ends = np.cumsum([len(text) + 1 for text in texts])
    of_word = np.searchsorted(text_ends, starts, side="right")
    counts = np.bincount(of_word, minlength=len(texts))
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), counts
    in_word = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = folded[inside].astype(np.uint64) * _powers(int(lengths.max()))[in_word]
    hashes = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    hashes ^= hashes >> np.uint64(29)
    last = len(hashes) - RUN_WORDS + 1
    if last <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), counts
    runs = sum((hashes[i : last + i] * _FACTORS[i] for i in range(RUN_WORDS)), start=np.zeros(last, np.uint64))
    runs ^= runs >> np.uint64(32)
    whole = of_word[:last] == of_word[RUN_WORDS - 1 :]
    position = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
    return of_word[:last][whole], position[:last][whole], runs[whole].view(np.int64), counts


def _parts(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The texts some megabytes at a time, with the number of the first."""
    values = pc.cast(pc.fill_null(texts, ""), pa.binary())
    for low, high in text_parts(values, PART_BYTES):
        yield low, values.slice(low, high - low).to_pylist()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, texts in _parts(batch.column(1)):
            of_text, position, run, _ = run_hashes(texts)
            ids = batch.column(0).slice(low, len(texts)).take(pa.array(of_text))
            yield pa.RecordBatch.from_arrays([ids, pa.array(position.astype(np.int32)), pa.array(run)], ["doc_id", "position", "run"])


def template_runs(spark: SparkSession) -> DataFrame:
    """run, template, at, needed: each run of each template and the votes its span needs; a fixed number of rows."""
    rows = []
    for number, (words, _, exact) in enumerate(TEMPLATES):
        _, position, run, _ = run_hashes([" ".join(words).encode()])
        needed = len(run) if exact else max(1, round(MIN_VOTES * len(run)))
        rows += [(int(h), number, int(at), needed) for h, at in zip(run, position, strict=True)]
    return spark.createDataFrame(rows, "run long, template int, at int, needed int")


def voted_spans(docs: DataFrame) -> DataFrame:
    """doc_id, template, diagonals, votes: neighbouring diagonals as one span, if it got the votes that it needs."""
    runs = docs.where("doc_id IS NOT NULL").mapInArrow(_runs, "doc_id long, position int, run long")
    hits = runs.join(F.broadcast(template_runs(docs.sparkSession)), "run")
    diagonal = (F.col("position") - F.col("at")).alias("diagonal")
    votes = hits.groupBy("doc_id", "template", "needed", diagonal).agg(F.count("*").alias("votes"))
    along = Window.partitionBy("doc_id", "template").orderBy("diagonal")
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > NEIGHBOUR_WORDS, F.lit(True))
    spans = votes.withColumn("opens", opens.cast("int")).withColumn("span", F.sum("opens").over(along))
    merged = spans.groupBy("doc_id", "template", "span", "needed").agg(
        F.collect_list("diagonal").alias("diagonals"), F.sum("votes").alias("votes")
    )
    return merged.where("votes >= needed").select("doc_id", "template", "diagonals", "votes")


def _check(words: list[bytes], candidates: list) -> tuple[list[int], set[str], set[str], float, list[tuple]]:
    """Places and labels of phrases, all labels, the best share of a template found, and the spans.

    Of notices that overlap the one with the larger share stands (version 3 of a license also resembles its version 2).
    """
    places, base, exact_spans, notices = set(), set(), [], []
    for row in candidates:
        template, label, exact = TEMPLATES[row["template"]]
        pattern, diagonals = [word.encode() for word in template], row["diagonals"]
        if exact:
            starts = [d for d in set(diagonals) if d >= 0 and words[d : d + len(pattern)] == pattern]
            places.update((start, label) for start in starts)
            exact_spans += [(label, start, start + len(pattern)) for start in starts]
            base.update([label] * bool(starts))
            continue
        low = max(0, min(diagonals) - NEIGHBOUR_WORDS)
        window = words[low : max(diagonals) + len(pattern) + NEIGHBOUR_WORDS]
        blocks = [b for b in SequenceMatcher(None, pattern, window, autojunk=False).get_matching_blocks() if b.size]
        share = sum(block.size for block in blocks) / len(pattern)
        if share >= MIN_COVERAGE:
            notices.append((share, label, low + blocks[0].b, low + blocks[-1].b + blocks[-1].size))
    standing = [n for n in notices if not any(m[0] > n[0] and m[2] < n[3] and n[2] < m[3] for m in notices)]
    best = max([1.0 * bool(base), *(n[0] for n in standing)])
    found = sorted({*exact_spans, *(n[1:] for n in standing)})
    return sorted(start for start, _ in places), base, base | {n[1] for n in standing}, best, found


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label: string, first: long, after: long>>"
)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, texts in _parts(batch.column(1)):
            candidates = batch.column(2).slice(low, len(texts)).to_pylist()
            counts = run_hashes(texts)[3]
            checked = [_check(words_of(t), c) if c else ([], set(), set(), 0.0, []) for t, c in zip(texts, candidates, strict=True)]
            columns = [
                batch.column(0).slice(low, len(texts)),
                pa.array(counts.astype(np.int64)),
                pa.array([len(x[0]) for x in checked], pa.int64()),
                pa.array([x[0][0] if x[0] else None for x in checked], pa.int64()),
                pa.array([x[0][-1] if x[0] else None for x in checked], pa.int64()),
                pa.array([",".join(sorted(x[1])) for x in checked], pa.string()),
                pa.array([",".join(sorted(x[2])) for x in checked], pa.string()),
                pa.array([x[3] for x in checked], pa.float64()),
                pa.array(
                    [[{"label": a, "first": b, "after": c} for a, b, c in x[4]] for x in checked],
                    pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("after", pa.int64())])),
                ),
            ]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row for each document: its words, places and labels, and the spans [first, after) of words with their labels."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Equal texts without doc_id vote once, as their votes go to one key.
    unnamed = texts.where("doc_id IS NULL").select(F.xxhash64("text").alias("doc_id"), "text").dropDuplicates(["doc_id"])
    votes = voted_spans(texts).withColumn("by_text", F.lit(False))
    votes = votes.unionByName(voted_spans(unnamed).withColumn("by_text", F.lit(True)))
    row = F.struct("template", "diagonals").alias("row")
    by_document = votes.groupBy(F.col("doc_id").alias("voted_id"), "by_text").agg(F.collect_list(row).alias("candidates"))
    key = F.coalesce(texts["doc_id"], F.xxhash64(texts["text"]))
    joined = texts.join(by_document, (key == F.col("voted_id")) & (texts["doc_id"].isNull() == F.col("by_text")), "left")
    return joined.select("doc_id", "text", "candidates").mapInArrow(_verify, SCHEMA)
