"""Filtering stages on repeated ids, rows without id and clashing columns, against plain loops; the fit's optimum."""

import re
import warnings

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from hangarline.llm import exact_dedup, mixing, simhash
from hangarline.llm.common import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept_id long, own_digest string, own_content long, mixed_id long, rejected_id long, copy int"


def table(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, "x", 2, 3, 4, 5) for i, t in rows], SCHEMA)


ROWS = [(1, "a b"), (1, "c d e"), (2, "a b"), (3, None), (4, ""), (4, " x"), (5, "c  d e"), (5, "c d e"), (None, "a b"), (None, "z"), (7, "q"), (7, "q")]


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_exact_stage_keeps_every_text(spark):
    best = {}
    for i, text in ROWS:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        if i is not None and (key not in best or i < best[key][0]):
            best[key] = (i, text)
    want = [*best.values(), (None, "a b"), (None, "z")]
    stay = exact_dedup.without_copies(table(spark, ROWS))
    assert len(stay.columns) == 11
    assert [(i, re.sub(r"\s+", " ", t or "")) for i, t in kept(stay)] == [
        (i, re.sub(r"\s+", " ", t or "")) for i, t in sorted(want, key=str)
    ]


def test_near_stage_keeps_one_of_each_component(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words, 200)) for _ in range(6)]
    rows = [(i % 5, text) for i, text in enumerate(base)]  # the last shares an id with the first
    rows += [(10 + i, text + " more") for i, text in enumerate(base)] + [(None, base[0]), (20, None), (21, "")]
    prints = []
    for _, text in rows:
        found = (text or "").split()
        runs = [" ".join(found[k : k + 3]) for k in range(len(found) - 2)] if len(found) > 2 else [" ".join(found)] * bool(found)
        hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    label = list(range(len(rows)))
    for _ in rows:
        label = [min(label[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(rows))]
    want = [(None, base[0])]
    for component in set(label):
        own = [rows[i] for i in range(len(rows)) if label[i] == component and rows[i][0] is not None]
        least = min(i for i, _ in own)
        want.append(next(row for row in own if row[0] == least))
    assert kept(simhash.one_of_each(table(spark, rows))) == sorted(want, key=str)


def test_stages_take_empty_tables_and_clashing_columns(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 0, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, ROWS)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            result = stage(spark, docs, str(tmp_path))
            assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        if number < 4:
            assert result.columns == docs.columns and result.count() <= max(docs.count(), 1) * 16


def test_documents_without_id_are_mixed_apart(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    docs = table(spark, [(1, "good"), (2, "vile"), (None, "one"), (None, "two three"), (None, "two three")])
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        rows = mixing.mixed(docs, mixing.domain_labels(labels)).collect()
    assert sorted(r.tokens for r in rows if r.doc_id is None) == [1, 4]


def loss(p, tokens, rate, weights):
    masses, targets = tokens @ p**2, np.array(mixing.targets_of((tokens @ p).tolist(), weights))
    return (((tokens * rate) @ p - targets) ** 2 / np.maximum(masses, 1e-300))[masses > 0].sum()


@pytest.mark.parametrize(
    ("p", "tokens", "weights"),
    [
        ([[0.5, 0.5]], [40_000], [0.97, 0.03]),
        ([[0.5, 0.5], [0.45, 0.55]], [900, 40], [0.97, 0.03]),
        ([[0.7, 0.3], [0.6, 0.4]], [500, 500], [0.96, 0.04]),
    ],
)
def test_weights_that_cannot_be_met_give_the_least_squares_optimum(spark, p, tokens, weights):
    p, tokens = np.array(p), np.array(tokens)
    rows = [(*map(float, x), int(t)) for x, t in zip(p, tokens, strict=True)]
    cells = spark.createDataFrame(rows, "p0 double, p1 double, tokens long")
    with pytest.warns(UserWarning, match="cannot be met"):
        rate = cells.select(mixing.fitted_rate(cells, weights, 16.0).alias("rate")).collect()
    rate = np.array([r.rate for r in rate])
    grid = np.linspace(0, 1, 401)
    mesh = np.array(np.meshgrid(*[grid] * len(tokens))).reshape(len(tokens), -1).T
    best = min(loss(p, tokens, x, weights) for x in mesh)
    assert loss(p, tokens, rate, weights) <= best * (1 + 2e-3) + 1e-9 and rate.max() > 0.3
