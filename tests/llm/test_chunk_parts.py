"""Chunks of the quality classifier are worked in parts: same counts and scores, in little memory."""

import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa

from hangarline.llm import quality

NO_TEXTS = ["", None, "ä", "abc" * 40, ""]


def chunk_of(texts):
    batch = pa.record_batch(
        {"doc_id": pa.array(range(len(texts)), pa.int64()), "lang": pa.array(["en"] * len(texts)), "text": pa.array(texts, pa.string())}
    )
    return pa.Table.from_batches(quality._make_chunks(16 << 20)(iter([batch]))).to_pandas()


def grams_of(text):
    padded = b"\0" * 3 + (text or "").encode() + b"\0"
    return [int.from_bytes(padded[i : i + 4], "big") for i in range(len(padded) - 3)]


def test_parts_count_and_score_like_whole_documents(monkeypatch):
    rng = np.random.default_rng(7)
    texts = NO_TEXTS + ["".join(rng.choice(list("ab é"), rng.integers(0, 30))) for _ in range(200)] + NO_TEXTS
    monkeypatch.setattr(quality, "PART_BYTES", 64)
    chunk, training = chunk_of(texts), pd.DataFrame({"position": np.arange(0, len(texts), 3)})
    got = quality._count_grams(chunk, training)
    want = Counter(g for text in texts[::3] for g in grams_of(text))
    assert len(chunk) == 1 and got["gram"].is_unique
    assert {g: n for g, n in zip(got["gram"], got["trained"], strict=True)} == {g: want[g] for text in texts for g in grams_of(text)}
    answers = pd.DataFrame({"chunk": 0, "gram": got["gram"], "p": rng.uniform(0.01, 1, len(got))})
    nats = dict(zip(answers["gram"], -np.log(answers["p"]), strict=True))
    scores = quality._score_chunk(chunk, answers)
    assert scores["doc_id"].tolist() == list(range(len(texts)))
    assert scores["n_bytes"].tolist() == [len((text or "").encode()) for text in texts]
    assert np.allclose(scores["nats"], [sum(nats[g] for g in grams_of(text)) for text in texts], rtol=1e-12)


def test_a_chunk_takes_a_few_times_its_bytes():
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    texts = [" ".join(rng.choice(words, 600)) for _ in range(3000)]
    total = sum(map(len, texts))
    chunk, training = chunk_of(texts), pd.DataFrame({"position": np.arange(0, len(texts), 2)})
    assert len(chunk) == 1 and total > 12e6

    def peak(work):
        tracemalloc.start()
        result = work()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return result, most

    grams, counting = peak(lambda: quality._count_grams(chunk, training))
    answers = pd.DataFrame({"chunk": 0, "gram": grams["gram"], "p": 0.5})
    _, scoring = peak(lambda: quality._score_chunk(chunk, answers))
    assert max(counting, scoring) < 8 * total
