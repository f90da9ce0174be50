r"""Ranked lexical search: the best documents for each item of a query table, by bag deduplication.

Documents are restricted to the terms that items hold. What an item's score needs of a document is then its counts of
those terms and one number m that stands for its length; documents that agree in both are one class. Classes are found
by a hash and verified by comparing counts and m in full. Each class is scored once against every item, and expanded to
its documents, smallest doc_id first, where results are listed.

Scale: texts are read once, in the tasks, and leave only counts of items' terms. Of a class no more than the best 50
members can be listed, so a class with a third of all rows is cut to that many in each task before anything is shuffled;
no score is lost by it, since members score alike. A task scores its classes in blocks, one postings list for each term,
and keeps the best 50 for each item; only those meet in the last window. Items are taken in blocks of a bounded number of
terms, so the vocabulary that tasks hold is bounded however many items there are; each block reads the texts again.
All sums are 64-bit integers.

Null text has no terms, as has text without letters, digits or characters beyond ASCII; such documents are not counted
and not found. An item without terms, or whose terms no document holds, has no rows. Items are rows: two rows of one
item_id are ranked apart. Documents without doc_id are found, behind others of their score; repeated rows are documents
of their own. Very long texts are counted whole, a batch of bounded bytes at a time. An empty table on either side gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from hangarline.llm.common import shards_for, text_parts, written

TOP = 50
#: Terms, with repeats in different items, that a block of items holds; its vocabulary is no larger.
TERMS_PER_BLOCK = 1 << 18
CLASSES_PER_BLOCK = 1 << 13
PART_BYTES = 16 << 20
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: One byte for each: separators become blanks, A-Z lower case; bytes of longer characters stay.
_PLAIN = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_PLAIN).split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.cast(pc.fill_null(batch.column(1), ""), pa.binary()).to_pylist()
        terms = [sorted({term.decode() for term in terms_of(text)}) for text in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.string()))], ["item_id", "terms"])


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, terms (distinct), and a number of its own for each row."""
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    rows = rows.mapInArrow(_item_terms, "item_id long, terms array<string>").where(F.size("terms") > 0)
    return rows.withColumn("item", F.monotonically_increasing_id())


def bags(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """doc_id, n (all terms), terms and counts: numbers of the vocabulary's terms (rising) and how often each occurs."""
    slots = {term.encode(): number for number, term in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.cast(pc.fill_null(batch.column(1), ""), pa.binary())
            for low, high in text_parts(texts, PART_BYTES):
                sizes, terms, counts = [], [], []
                for text in texts.slice(low, high - low):
                    words = terms_of(text.as_py())
                    found = sorted((slots[word], count) for word, count in Counter(words).items() if word in slots)
                    sizes.append(len(words))
                    terms.append(np.array([slot for slot, _ in found], dtype="<i4").tobytes())
                    counts.append(np.array([count for _, count in found], dtype="<i4").tobytes())
                columns = [batch.column(0).slice(low, high - low), pa.array(sizes, pa.int64())]
                columns += [pa.array(terms, pa.binary()), pa.array(counts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n long, terms binary, counts binary")


def _numbers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows one after the other, and how many each row has."""
    values = pa.concat_arrays([values])  # without the offset of a slice
    sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    return np.frombuffer(b"".join(values.to_pylist()), dtype="<i4").astype(np.int64), sizes


def document_frequencies(found: DataFrame, terms: int) -> DataFrame:
    """term, df: how many documents hold each term of the vocabulary. Counted within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0))[0], minlength=terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": held.astype(np.int64), "df": total[held]})

    partial = found.select("terms").mapInArrow(run, "term long, df long")
    return partial.groupBy("term").agg(F.sum("df").alias("df"))


def weight(documents: int, df: int) -> int:
    """A term's weight: never negative, since df is at most the number of documents."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def classes(found: DataFrame, documents: int, length: int, top: int = TOP) -> DataFrame:
    """terms, counts, m and `members`: of documents that agree in the three, the `top` smallest doc_ids, ascending.

    The hash decides where documents meet; grouping by the hash and by what it was made of is the comparison.
    """
    m = F.expr(f"cast(50 + ((50L * n * {documents}L) div {max(length, 1)}L) AS long)")
    rows = found.where("terms <> X''").select("doc_id", "terms", "counts", m.alias("m"))
    rows = rows.withColumn("hash", F.xxhash64("terms", "counts", "m"))
    same = ["hash", "terms", "counts", "m"]
    by_id = Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last())
    best = rows.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= top)
    member = F.struct(F.isnull("doc_id").alias("absent"), "doc_id")
    return best.groupBy(*same).agg(F.array_sort(F.collect_list(member)).alias("members")).select("terms", "counts", "m", "members.doc_id")


class _Best:
    """The best classes for one item so far: scores, smallest member and which class it is."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.empty(0, dtype=np.int64)
        self.first = np.empty(0, dtype=np.int64)
        self.absent = np.empty(0, dtype=bool)
        self.members: list[list[int | None]] = []

    def offer(self, scores: np.ndarray, first: np.ndarray, absent: np.ndarray, members: pa.Array) -> None:
        least = max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1
        better = np.flatnonzero(scores >= least)
        if len(better) > self.top:
            edge = np.partition(scores[better], len(better) - self.top)[len(better) - self.top]
            better = better[scores[better] >= edge]
        if not len(better):
            return
        scores, first = np.concatenate([self.scores, scores[better]]), np.concatenate([self.first, first[better]])
        absent = np.concatenate([self.absent, absent[better]])
        order = np.lexsort((first, absent, -scores))[: self.top]
        known = len(self.scores)
        self.members = [self.members[i] if i < known else members[int(better[i - known])].as_py() for i in order.tolist()]
        self.scores, self.first, self.absent = scores[order], first[order], absent[order]

    def documents(self) -> list[tuple[int, int | None]]:
        """(score, doc_id) of the best documents: a class behind `top` others has no document among the best `top`."""
        found = [(score, doc_id) for score, own in zip(self.scores.tolist(), self.members, strict=True) for doc_id in own]
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[: self.top]


def _scores(batch: pa.RecordBatch, weights: np.ndarray, items: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The scores of a block of classes, item by item, from postings of the block's terms."""
    terms, sizes = _numbers(batch.column(0))
    counts, _ = _numbers(batch.column(1))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    m = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)[owner]
    gains = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * m))
    order = np.argsort(terms, kind="stable")
    owner, gains = owner[order], gains[order]
    starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))
    for own in items:
        total = np.zeros(len(sizes), dtype=np.int64)
        for term in own.tolist():
            low, high = starts[term], starts[term + 1]
            total[owner[low:high]] += gains[low:high]  # a class holds a term once
        yield total


def _search_block(docs: DataFrame, items: list[Row], top: int) -> DataFrame:
    """item, item_id, doc_id, score: more than enough rows to hold each item's best."""
    vocabulary = sorted({term for row in items for term in row.terms})
    numbers = {term: number for number, term in enumerate(vocabulary)}
    item_slots = [np.array([numbers[term] for term in row.terms], dtype=np.int64) for row in items]
    names = [(row.item, row.item_id) for row in items]
    found = written(bags(docs, vocabulary))
    size = found.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for row in document_frequencies(found, len(vocabulary)).collect():
        weights[row.term] = weight(size.documents, row.df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(top) for _ in names]
        for batch in batches:
            for low in range(0, len(batch), CLASSES_PER_BLOCK):
                block = batch.slice(low, CLASSES_PER_BLOCK)
                members = block.column(3)
                first = pc.list_element(members, 0)
                absent = pc.is_null(first).to_numpy(zero_copy_only=False)
                first = pc.fill_null(first, 0).to_numpy(zero_copy_only=False)
                for kept, scores in zip(best, _scores(block, weights, item_slots), strict=True):
                    kept.offer(scores, first, absent, members)
        rows = [(*name, doc_id, score) for name, kept in zip(names, best, strict=True) for score, doc_id in kept.documents()]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        arrays = [pa.array(list(column), pa.int64()) for column in columns]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "item_id", "doc_id", "score"])

    grouped = classes(found, size.documents, size.length, top)
    return grouped.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, terms_per_block: int = TERMS_PER_BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of each row of items, equal scores by ascending doc_id."""
    queries = written(item_terms(items))
    total = queries.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = shards_for(total, terms_per_block)
    rows = None
    for number in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        if block:
            found = _search_block(docs, block, top)
            rows = found if rows is None else rows.unionByName(found)
    if rows is None:
        rows = docs.sparkSession.createDataFrame([], "item long, item_id long, doc_id long, score long")
    by_score = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = rows.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH words AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), asked AS (
  SELECT row_number() OVER () AS item, item_id, unnest(list_distinct(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark
), lengths AS (SELECT d, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY d),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
counted AS (SELECT d, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY d, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counted, whole GROUP BY term
), measured AS (SELECT d, doc_id, 100 - 50 + ((50 * n * docs) // total) AS m FROM lengths, whole),
gains AS (SELECT d, term, doc_id, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS gain FROM counted JOIN weights USING (term) JOIN measured USING (d)),
scored AS (SELECT item, item_id, d, doc_id, sum(gain)::BIGINT AS score FROM asked JOIN gains USING (term) GROUP BY item, item_id, d, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
