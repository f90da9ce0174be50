"""Corpus operators against brute force on small tables with nulls, ties, repeated rows and clashing columns."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

from hangarline.llm import exact_dedup, html, language, licenses, mixing, packing, quality, simhash, topk, toxicity
from hangarline.llm.common import ship_package
from hangarline.llm.queries import TOKENIZER

DATA = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, point string, bucket int"
LABEL_SCHEMA = "doc_id long, quality int, toxic int"


def docs_of(spark, texts, first=1, lang="en"):
    rows = [(first + i, text, lang, "s", 0, "x", "y", 1) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


AWKWARD = [None, "", "  \t\n", "one", "one two three", "One  two\nthree", "under the MIT License", "é" * 50, "word " * 40_000]


@pytest.fixture(scope="module")
def awkward(spark):
    ship_package(spark)
    docs = docs_of(spark, AWKWARD)
    return docs.union(docs.where("doc_id = 5")).union(spark.createDataFrame([(None, "one", None, None, 0, "x", "y", 1)], DOC_SCHEMA))


@pytest.fixture(scope="module")
def sample(spark):
    ship_package(spark)
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_every_operator_takes_awkward_rows_and_empty_tables(spark, awkward, sample):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (None, 1, 1), (5, None, 1), (6, 1, 0), (7, 1, 1)], LABEL_SCHEMA)
    operators = [
        exact_dedup.exact_duplicates,
        lambda d: packing.pack(d, TOKENIZER),
        lambda d: quality.quality_scores(d, labels),
        lambda d: mixing.mixed(d, mixing.domain_labels(labels)),
        lambda d: toxicity.toxicity(d, labels),
        licenses.license_scan,
        simhash.near_duplicates,
        language.identify,
    ]
    per_row = [True, False, True, False, True, True, True, True]
    for operator, one_for_one in zip(operators, per_row, strict=True):
        found = operator(awkward).collect()
        assert len(found) == awkward.count() if one_for_one else {r.doc_id for r in found} == {*range(1, 10), None}
        assert operator(awkward.limit(0)).count() == 0


def test_exact_dedup_equals_sql(sample):
    docs, _ = sample
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = con.execute(exact_dedup.ORACLE).df().sort_values("doc_id")
    got = exact_dedup.exact_duplicates(docs, digests_per_shard=16).toPandas().sort_values("doc_id")[want.columns]
    assert (want.astype(str).to_numpy() == got.astype(str).to_numpy()).all()


def test_perfect_hash_is_minimal_and_finds_members():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 5000, dtype=np.uint64))
    hashed = exact_dedup.MinimalPerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(len(keys)))


def test_copies_and_rows_without_id(spark, awkward):
    stay = exact_dedup.without_copies(awkward).select("doc_id").collect()
    assert sorted(r.doc_id for r in stay if r.doc_id) == [1, 3, 4, 5, 6, 7, 8, 9]
    assert sum(r.doc_id is None for r in stay) == 1


def test_pieces_hold_each_id_once(sample):
    docs, _ = sample
    pieces = packing.pack(docs, TOKENIZER, with_ids=True).toPandas()
    whole = packing.WordIds(TOKENIZER).whole
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for doc_id, own in pieces.sort_values("start").groupby("doc_id"):
        ids = [x for piece in own["ids"] for x in piece]
        assert ids == [*whole.encode(texts[doc_id], add_special_tokens=False).ids, 1]
        assert (own["start"] == own["length"].cumsum() - own["length"]).all()
        assert all(zlib.crc32(np.array(p, dtype="<u4").tobytes()) == c for p, c in zip(own["ids"], own["ids_crc32"], strict=True))
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        size = own["length"].sum()
        assert (own["offset"] == own["length"].cumsum() - own["length"]).all() and size & (size - 1) == 0 and size <= 2048
    assert set(pieces["doc_id"]) == set(texts)


def test_special_and_unusual_words_have_the_tokenizers_ids():
    import pyarrow as pa

    encoder = packing.WordIds(TOKENIZER)
    texts = ["a<|endoftext|>b I'll\x1cx 3½ ÀÉ ñ ÿ’s İx Σας", "<|ENDOFTEXT|> don't", "", "ª² µ Å ﬁ a'S"]
    ids, starts = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == [*encoder.whole.encode(text, add_special_tokens=False).ids, 1]


def test_perplexity_equals_a_direct_model(sample):
    docs, labels = sample
    scores = {r.doc_id: r for r in quality.perplexities(docs, labels, chunk_bytes=20_000).collect()}
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    training = [texts[i] for i, r in scores.items() if r.calibrates is False]

    def grams(text):
        padded = b"\0" * (quality.ORDER - 1) + text + b"\0"
        return [padded[i : i + quality.ORDER] for i in range(len(text) + 1)]

    tables = {quality.ORDER: Counter(g for text in training for g in grams(text))}
    for order in range(quality.ORDER - 1, 0, -1):
        tables[order] = Counter(g[1:] for g in tables[order + 1])
    discounts = {n: quality._discounts(*[sum(c == k for c in t.values()) for k in (1, 2, 3, 4)]) for n, t in tables.items()}
    totals, held = {n: Counter() for n in tables}, {n: Counter() for n in tables}
    for n, table in tables.items():
        for gram, count in table.items():
            totals[n][gram[:-1]] += count
            held[n][gram[:-1]] += discounts[n][min(count, 3) - 1]

    def probability(gram):
        p = 1 / 256
        for n in range(1, quality.ORDER + 1):
            g = gram[-n:]
            if total := totals[n][g[:-1]]:
                count = tables[n][g]
                p = ((count - discounts[n][min(count, 3) - 1] if count else 0) + held[n][g[:-1]] * p) / total
        return p

    for doc_id in sorted(texts)[:25]:
        want = -sum(np.log(probability(g)) for g in grams(texts[doc_id]))
        assert scores[doc_id].nats == pytest.approx(want, rel=1e-9)


def test_quality_keeps_trusted_and_drops_junk(sample):
    docs, labels = sample
    judged = quality.quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    assert judged[judged.quality == 1].kept.mean() > 0.95 and judged[judged.quality == 0].kept.mean() < 0.4


def test_top_k_equals_brute_force_with_ties(spark):
    rng = np.random.default_rng(5)
    vectors = rng.integers(-4, 5, (700, 6))
    vectors[::3] = vectors[0]
    rows = [(i, [float(x) / 256 for x in v]) for i, v in enumerate(vectors)]
    rows += [(None, [0.0] * 6), (9_001, None), (9_050, [float("nan")] * 6), (9_100, [None] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ship_package(spark)
    quantized = topk.quantized(table)
    found = topk.top_k(quantized, quantized.where("vec_id % 50 = 0"), 5, vectors_per_shard=300).collect()
    got = {(r.query_id, r["rank"]): (r.score, r.vec_id) for r in found}
    for query in range(0, 700, 50):
        best = sorted((-int(v @ vectors[query]), i) for i, v in enumerate(vectors) if i != query)[:5]
        assert [got[query, n + 1] for n in range(5)] == [(-score, i) for score, i in best]
    assert len(got) == 14 * 5


def test_main_text_of_marked_and_constant_regions(spark):
    page = (
        "<html><head><title>T{0}</title></head><body><div class='top menu'><a>x</a></div><article><h1>H{0}</h1><p>a &amp; b{0}<br>c"
        "<p>Always the same<p>x{0}</article><div id=comments>no</div><footer>f{0}</footer></body>"
    )
    texts = html.extract_group([page.format(i) for i in range(12)])
    assert texts == [f"H{i}\na & b{i} c\nx{i}" for i in range(12)]
    rows = [(1, "http://h/a", page.format(1)), (2, None, None), (3, "x", "<div>" * 3000 + "deep"), (1, "http://h/a", page.format(1))]
    ship_package(spark)
    got = html.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = ["", "H1\na & b1 c\nAlways the same\nx1", "H1\na & b1 c\nAlways the same\nx1", "deep"]
    assert sorted(r.text for r in got) == want and all(r.n_chars == len(r.text) for r in got)


def test_rates_minimize_the_misses(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.05, 0.05, 0.05], 400)
    tokens = rng.integers(1, 900, 400)
    rows = [(*map(float, x), int(t)) for x, t in zip(p, tokens, strict=True)]
    cells = spark.createDataFrame(rows, "p0 double, p1 double, p2 double, tokens long")
    weights = [0.8, 0.15, 0.05]
    rate = np.array([r.rate for r in cells.select(mixing.fitted_rate(cells, weights, 1.0).alias("rate")).collect()])
    available, masses = tokens @ p, tokens @ p**2
    targets = np.array(mixing.targets_of(available.tolist(), weights))

    def loss(r):
        return ((((tokens * r) @ p - targets) ** 2 / masses).sum() + mixing.PULL * (tokens * (r - 1) ** 2).sum()) / tokens.sum()

    best = np.ones(400)
    for _ in range(20_000):
        misses = ((tokens * best) @ p - targets) / masses
        best = np.clip(best - (p @ misses + mixing.PULL * (best - 1)) / 4, 0, 1)
    assert ((rate >= 0) & (rate <= 1)).all()
    assert loss(rate) <= loss(best) + 0.01 * (loss(np.ones(400)) - loss(best))


def test_mixing_keeps_clean_documents_and_counts_rows_once(sample):
    docs, labels = sample
    rows = mixing.mixed(docs, mixing.domain_labels(labels)).toPandas()
    assert rows["doc_id"].is_unique and len(rows) == docs.count()
    assert rows[rows["domain"] == "clean"]["rate"].mean() > rows[rows["domain"] != "clean"]["rate"].mean()


def test_segments_equal_the_recursive_definition():
    rng = np.random.default_rng(0)

    def split(scores, low, high):
        best, sums = None, np.concatenate([[0.0], np.cumsum(scores[low:high])])
        for i in range(high - low):
            for j in range(i + 1, high - low + 1):
                if sums[j] - sums[i] > 1e-12 and (best is None or sums[j] - sums[i] > best[0] + 1e-12):
                    best = (sums[j] - sums[i], low + i, low + j)
        return [] if best is None else split(scores, low, best[1]) + [best[1:]] + split(scores, best[2], high)

    for _ in range(200):
        scores = rng.normal(-0.3, 1, rng.integers(0, 14))
        assert [s[:2] for s in toxicity.maximal_segments(scores)] == split(scores, 0, len(scores))


def test_toxic_words_are_found_in_held_out_documents(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words, 80)) + (" vile vile" if i % 5 == 0 else "") for i in range(400)]
    labels = spark.createDataFrame([(i + 1, 1, int(i % 5 == 0)) for i in range(400)], LABEL_SCHEMA)
    ship_package(spark)
    got = toxicity.toxicity(docs_of(spark, texts), labels).toPandas()
    assert (got.predicted == (got.doc_id % 5 == 1)).all() and got.held_out.any()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(got.doc_id, got.held_out, strict=True))


def test_license_places_equal_a_scan(sample, spark):
    docs, _ = sample
    extra = ["cc by nc cc by nc, Under the MIT-license", "apache license 2", "Licensed under the Apache License, Version 2.0.", "all RIGHTS reserved"]
    docs = docs.select("doc_id", "text").union(docs_of(spark, extra, 10**6).select("doc_id", "text"))
    got = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    for row in docs.collect():
        text = re.sub("[A-Z]", lambda m: m[0].lower(), row.text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        places, labels = [], set()
        for phrase, label in licenses.PHRASES:
            parts = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            places, labels = places + at, labels | ({label} if at else set())
        r = got[row.doc_id]
        ends = (min(places), max(places)) if places else (None, None)
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ends and labels <= set(r.labels.split(",")) | {""} - {""}
    assert got[10**6 + 3].labels == "all-rights-reserved" and got[10**6 + 1].labels == ""


def test_fingerprints_and_components_equal_brute_force(sample):
    docs, _ = sample
    got = simhash.near_duplicates(docs).toPandas().sort_values("doc_id")
    prints = {}
    for row in docs.collect():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (row.text or "").encode().lower())
        runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
        prints[row.doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    component = {i: i for i in prints}
    for _ in range(10):
        for i in prints:
            component[i] = min(component[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 3)
    assert got.fingerprint.tolist() == [f"{prints[i]:016x}" for i in got.doc_id]
    assert got.component_id.tolist() == [component[i] for i in got.doc_id]


def test_dense_and_scattered_points_are_linked_as_by_brute_force(spark):
    rng = np.random.default_rng(2)
    flips = lambda x: int(x) ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 6))})
    points = np.unique(np.array([flips(c) for c in rng.integers(0, 1 << 62, 12) for _ in range(150)], dtype=np.uint64))
    table = spark.createDataFrame(pd.DataFrame({"point": points.view(np.int64)}))
    ship_package(spark)
    links = simhash.connected(simhash.shard_links(table, 3, points_per_shard=200)).collect()
    root = {r.node: r.root for r in links}
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    labels = np.arange(len(points))
    for _ in range(64):
        labels = np.where(near, labels[None, :], len(points)).min(axis=1)
    groups = {frozenset(points[labels == x].view(np.int64).tolist()) for x in set(labels)}
    found = {}
    for point in points.view(np.int64).tolist():
        found.setdefault(root.get(point, point), set()).add(point)
    assert groups == {frozenset(g) for g in found.values()}


def test_languages_are_told_apart_on_held_out_documents(sample, awkward):
    docs, _ = sample
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95
    awkward_ = language.identify(awkward).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in awkward_ if r.n_characters == 0)
