"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model predicts each byte from the three before it. Documents are cut into chunks; a chunk lists its distinct
four-byte grams and how often each occurs in trusted text. These counts are summed by gram, lower orders count
distinct continuations, and each order's probabilities come from joins of sharded count tables. Every chunk gets the
probabilities of its grams back and sums them for each document. Four fifths of the trusted documents train the model;
the others, scored by it, give the threshold of their language: a quantile of their length-adjusted perplexities.

Scale: texts are written once, compressed, to a table bucketed by chunk, and never shuffled. What is shuffled is one row
for each chunk and distinct gram, so counting is complete before anything moves, and a gram that occurs in every
document is one row a chunk. Chunks hold a bounded number of bytes (one longer document is a chunk of its own).
A task works on a bounded part of its chunk at a time, so its arrays take far less memory than a chunk at once would.
The counts, like the model, come from all trusted documents and grow with them; the model is never broadcast whole or collected.

Null text counts as empty: nothing speaks against it and it is kept. A null lang is a language of its own; languages
without held-out trusted documents use the threshold of all. Without any trusted document everything is kept and the
perplexity is null. Labels that contradict each other make a document untrusted. Repeated rows are scored one by one.
An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangarline.llm.common import fresh_name, shards_for, shared_folder, size_parts, text_parts, written

ORDER = 4
CHUNK_BYTES = 16 << 20
#: A task works on so many bytes of a chunk at a time, or on one longer document; its arrays take some 40 times that.
PART_BYTES = 1 << 20
DOCS_PER_BUCKET = 4096
#: Of a trusted document: pmod(xxhash64(doc_id), FOLDS) = 0 calibrates, the others train.
FOLDS = 5
KEPT_QUANTILE = 0.997
#: So many bytes of typical text are added to each document before its perplexity is compared, as few bytes say little.
PRIOR_BYTES = 50

CHUNK_SCHEMA = "chunk long, doc_ids array<long>, langs array<string>, sizes binary, text binary"


def _make_chunks(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        context = TaskContext.get()
        chunk = (context.partitionId() if context else 0) << 32
        for batch in batches:
            texts = pc.cast(pc.fill_null(batch.column(2), ""), pa.large_binary())
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            for low, high in text_parts(texts, chunk_bytes):
                part = texts.slice(low, high - low)
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([chunk], pa.int64()),
                        "doc_ids": pa.array([batch.column(0).slice(low, high - low).to_pylist()], pa.list_(pa.int64())),
                        "langs": pa.array([batch.column(1).slice(low, high - low).to_pylist()], pa.list_(pa.string())),
                        "sizes": pa.array([sizes[low:high].tobytes()], pa.binary()),
                        "text": pa.array([compressor.compress(b"".join(part.to_pylist()))], pa.binary()),
                    }
                )
                chunk += 1

    return run


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents as a table bucketed by chunk: jobs that group by chunk read it without a shuffle."""
    spark = docs.sparkSession
    columns = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    name = f"llm_chunks_{uuid.uuid4().hex}"
    buckets = min(shards_for(docs.count(), DOCS_PER_BUCKET), 100_000)
    writer = columns.mapInArrow(_make_chunks(chunk_bytes), CHUNK_SCHEMA).write.format("parquet")
    writer = writer.option("path", f"{shared_folder(spark)}/{name}").option("compression", "uncompressed")
    writer.bucketBy(buckets, "chunk").saveAsTable(name)
    return spark.table(name)


def _grams(sizes: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The four-byte grams of each document between zero bytes, one for each byte and the end; where each begins."""
    starts = np.concatenate([[0], np.cumsum(sizes + ORDER)])[:-1]
    padded = np.zeros(int((sizes + ORDER).sum()), dtype=np.uint8)
    filled = np.ones(len(padded), dtype=bool)
    for i in range(ORDER - 1):
        filled[starts + i] = False
    filled[starts + ORDER - 1 + sizes] = False
    padded[filled] = np.frombuffer(text, dtype=np.uint8)
    grams = np.zeros(len(padded) - ORDER + 1, dtype=np.uint32)
    for i in range(ORDER):
        grams <<= np.uint32(8)
        grams |= padded[i : len(grams) + i]
    inside = np.ones(len(padded), dtype=bool)
    ends = starts + sizes + 1
    for i in range(ORDER - 1):
        inside[ends + i] = False
    return grams[inside[: len(grams)]], np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]


def _chunk_parts(row: pd.Series) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Documents of a chunk in parts of PART_BYTES: first and after by position, their grams, and where each begins."""
    sizes = np.frombuffer(row["sizes"], dtype=np.int64)
    text = zstandard.ZstdDecompressor().decompress(row["text"], max_output_size=int(sizes.sum()) or 1) if sizes.sum() else b""
    text, ends = memoryview(text), np.concatenate([[0], np.cumsum(sizes)])
    for low, high in size_parts(sizes, PART_BYTES):
        yield low, high, *_grams(sizes[low:high], text[ends[low] : ends[high]])


GRAM_SCHEMA = "chunk long, gram long, trained long"


def _count_grams(chunk: pd.DataFrame, training: pd.DataFrame) -> pd.DataFrame:
    """A chunk's distinct grams and how often each occurs in its training documents, given by position."""
    out = []
    for _, row in chunk.iterrows():
        trains = np.zeros(len(row["doc_ids"]), dtype=bool)
        trains[training["position"].to_numpy(np.int64)] = True
        found, counts = [], []
        for low, high, grams, starts in _chunk_parts(row):
            codes, distinct = pd.factorize(grams)
            lengths = np.diff(np.append(starts, len(grams)))
            found.append(distinct.astype(np.int64))
            counts.append(np.bincount(codes[np.repeat(trains[low:high], lengths)], minlength=len(distinct)))
        codes, distinct = pd.factorize(np.concatenate(found))
        trained = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(trained, codes, np.concatenate(counts))
        out.append(pd.DataFrame({"chunk": row["chunk"], "gram": distinct, "trained": trained}))
    return pd.concat(out) if out else pd.DataFrame({"chunk": [], "gram": [], "trained": []})


def _mask(order: int) -> Column:
    return F.lit((1 << 8 * order) - 1).cast("long")


def _discounts(t1: int, t2: int, t3: int, t4: int) -> tuple[float, float, float]:
    """Discounts for counts of one, two, and three or more; fixed ones where the counts of counts are too few."""
    if min(t1, t2, t3, t4) == 0:
        return 0.5, 1.0, 1.5
    y = t1 / (t1 + 2 * t2)
    found = (1 - 2 * y * t2 / t1, 2 - 3 * y * t3 / t2, 3 - 4 * y * t4 / t3)
    return tuple(min(max(d, 0.01), limit - 0.01) for d, limit in zip(found, (1, 2, 3), strict=True))


def _count_tables(grams: DataFrame) -> dict[int, DataFrame]:
    """By order: gram and count; the highest order's occurrences, below it distinct continuations."""
    top = grams.where("trained > 0").groupBy("gram").agg(F.sum("trained").alias("count"))
    tables = {ORDER: written(top)}
    for order in range(ORDER - 1, 0, -1):
        longer = tables[order + 1]
        gram = F.col("gram").bitwiseAND(_mask(order))
        tables[order] = longer.groupBy(gram.alias("gram")).agg(F.count("*").alias("count"))
    return tables


def _counts_of_counts(tables: dict[int, DataFrame]) -> dict[int, tuple[float, float, float]]:
    rows = None
    for order, table in tables.items():
        counted = [F.count_if(F.col("count") == k).alias(f"t{k}") for k in (1, 2, 3, 4)]
        row = table.agg(*counted).withColumn("order", F.lit(order))
        rows = row if rows is None else rows.union(row)
    return {row["order"]: _discounts(row.t1, row.t2, row.t3, row.t4) for row in rows.collect()}


def gram_probabilities(grams: DataFrame) -> DataFrame:
    """gram, p: for each distinct gram of the documents the probability of its last byte after the others."""
    tables = _count_tables(grams)
    discounts = _counts_of_counts(tables)
    wanted = {ORDER: grams.select("gram").distinct()}
    for order in range(ORDER - 1, 0, -1):
        longer = wanted[order + 1]
        wanted[order] = longer.select(F.col("gram").bitwiseAND(_mask(order)).alias("gram")).distinct()
    known = wanted[1].select("gram", F.lit(1 / 256).alias("p"))
    for order in range(1, ORDER + 1):
        one, two, more = (F.lit(d) for d in discounts[order])
        context = F.shiftright("gram", 8).alias("context")
        contexts = tables[order].groupBy(context).agg(
            F.sum("count").alias("total"),
            sum(
                (F.count_if(when) * d for when, d in (
                    (F.col("count") == 1, one), (F.col("count") == 2, two), (F.col("count") > 2, more)
                )),
                start=F.lit(0.0),
            ).alias("held_back"),
        )
        if order > 1:
            suffix = F.col("gram").bitwiseAND(_mask(order - 1)).alias("suffix")
            asked = wanted[order].withColumn("suffix", suffix)
            known = asked.join(known.withColumnRenamed("gram", "suffix"), "suffix").drop("suffix")
        found = known.withColumn("context", context).join(tables[order], "gram", "left").join(contexts, "context", "left")
        count = F.coalesce("count", F.lit(0))
        discount = F.when(count == 0, 0.0).when(count == 1, one).when(count == 2, two).otherwise(more)
        seen = (count - discount) / F.col("total") + F.col("held_back") / F.col("total") * F.col("p")
        known = found.select("gram", F.when(F.isnull("total"), F.col("p")).otherwise(seen).alias("p"))
    return known


SCORE_SCHEMA = "doc_id long, lang string, n_bytes long, nats double"


def _score_chunk(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    out = [pd.DataFrame({"doc_id": [], "lang": [], "n_bytes": [], "nats": []})]
    answers = answers.sort_values("gram")
    known, logs = answers["gram"].to_numpy(np.int64), -np.log(answers["p"].to_numpy())
    for _, row in chunk.iterrows():
        sizes, nats = np.frombuffer(row["sizes"], dtype=np.int64), []
        for _, _, grams, starts in _chunk_parts(row):
            codes, distinct = pd.factorize(grams)
            at = np.searchsorted(known, distinct.astype(np.int64))
            if len(distinct) and (at.max() >= len(known) or (known[at] != distinct).any()):
                raise ValueError("a gram of the chunk has no probability")
            nats.append(np.add.reduceat(logs[at][codes], starts))
        ids = pd.array([None if x is None or x != x else int(x) for x in row["doc_ids"]], dtype="Int64")
        out.append(pd.DataFrame({"doc_id": ids, "lang": row["langs"], "n_bytes": sizes, "nats": np.concatenate(nats)}))
    return pd.concat(out[1:] or out)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of documents whose labels all say quality 1, and whether they calibrate instead of train."""
    agreed = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    calibrates = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    return agreed.where("low = 1 AND high = 1").select("doc_id", calibrates.alias("calibrates"))


def perplexities(docs: DataFrame, labels: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row for each document: doc_id, lang, n_bytes, nats (of its bytes and its end), calibrates (null: untrusted)."""
    chunks = chunked(docs, chunk_bytes)
    trusted = trusted_ids(labels.select(F.col("doc_id").cast("long"), "quality"))
    placed = chunks.select(F.col("chunk").alias("of_chunk"), F.posexplode("doc_ids").alias("position", "doc_id"))
    training = placed.join(trusted.where("NOT calibrates"), "doc_id").select("of_chunk", "position")
    both = chunks.groupBy("chunk").cogroup(training.groupBy("of_chunk"))
    grams = written(both.applyInPandas(_count_grams, GRAM_SCHEMA))
    answers = grams.select("chunk", "gram").join(gram_probabilities(grams), "gram").select("chunk", "gram", "p")
    scores = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_score_chunk, SCORE_SCHEMA)
    return scores.join(trusted, "doc_id", "left")


def quality_scores(
    docs: DataFrame, labels: DataFrame, quantile: float = KEPT_QUANTILE, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity (of a byte), adjusted, threshold (both in nats a byte), trusted, kept."""
    scores = written(perplexities(docs, labels, chunk_bytes))
    rate = F.col("nats") / (F.col("n_bytes") + 1)
    held_out = scores.where("calibrates").withColumn("rate", rate)
    typical = held_out.groupBy("lang").agg(F.percentile_approx("rate", F.lit(0.5), F.lit(10_000)).alias("typical"))
    overall = held_out.agg(F.percentile_approx("rate", F.lit(0.5), F.lit(10_000)).alias("typical")).first()["typical"]
    if overall is None:  # nothing to compare with
        plain = [F.lit(None).cast("double").alias(name) for name in ("perplexity", "adjusted", "threshold")]
        return scores.select("doc_id", "lang", "n_bytes", *plain, F.lit(False).alias("trusted"), F.lit(True).alias("kept"))

    def adjusted(rows: DataFrame) -> DataFrame:
        typical_ = typical.withColumnsRenamed({"lang": "lang_"})
        joined = rows.join(typical_, F.col("lang").eqNullSafe(F.col("lang_")), "left").drop("lang_")
        prior = F.coalesce("typical", F.lit(overall)) * PRIOR_BYTES
        return joined.withColumn("adjusted", (F.col("nats") + prior) / (F.col("n_bytes") + 1 + PRIOR_BYTES))

    limit = F.percentile_approx("adjusted", F.lit(quantile), F.lit(100_000)).alias("threshold")
    calibration = adjusted(scores.where("calibrates"))
    limits = calibration.groupBy(F.col("lang").alias("lang_")).agg(limit)
    general = calibration.agg(limit).first()["threshold"]
    judged = adjusted(scores).join(limits, F.col("lang").eqNullSafe(F.col("lang_")), "left").drop("lang_")
    threshold = F.coalesce("threshold", F.lit(general))
    return judged.select(
        "doc_id",
        "lang",
        "n_bytes",
        F.exp(rate).alias("perplexity"),
        "adjusted",
        threshold.alias("threshold"),
        F.isnotnull("calibrates").alias("trusted"),
        (F.col("adjusted") <= threshold).alias("kept"),
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with their own columns. Rows without a doc_id stay: no score names them.

    Scores name a doc_id and the length of its text; of texts that share both, all stay unless all are rejected.
    """
    rejected_id, rejected_bytes = fresh_name(docs, "rejected_id"), fresh_name(docs, "rejected_bytes")
    scores = quality_scores(docs.select("doc_id", "lang", "text"), labels).where("doc_id IS NOT NULL")
    judged = scores.groupBy(F.col("doc_id").alias(rejected_id), F.col("n_bytes").alias(rejected_bytes)).agg(F.max("kept").alias("any_kept"))
    rejected = judged.where("NOT any_kept").drop("any_kept")
    n_bytes = F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit("")))
    same = (F.col("doc_id") == F.col(rejected_id)) & (n_bytes == F.col(rejected_bytes))
    return docs.join(rejected, same, "left_anti")
