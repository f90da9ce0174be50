"""Ranked search against a direct scoring of all documents for all items."""

import math
import random
import re
from collections import Counter

import pytest

from hangarline.llm import lexical
from hangarline.llm.common import ship_package

DOCS = "doc_id long, text string, item_id long, score string, hash int"
ITEMS = "item_id long, text string, doc_id long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, top=50):
    bags = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    bags = [(doc_id, bag, sum(bag.values())) for doc_id, bag in bags if bag]
    count, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(term for _, bag, _ in bags for term in bag)
    for item_id, text in items:
        scores = []
        for doc_id, bag, n in bags:
            m = 100 - 50 + (50 * n * count) // length
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in set(terms(text))
                if t in bag
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:top], 1):
            yield item_id, rank, doc_id, -score


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, docs, items, **more):
    ship_package(spark)
    table = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], DOCS)
    asked = spark.createDataFrame([(*i, 5) for i in items], ITEMS)
    got = sorted(map(tuple, lexical.search(table, asked, **more).collect()), key=key)
    assert got == sorted(ranked(docs, items, more.get("top", 50)), key=key)


@pytest.mark.parametrize("more", [{}, {"top": 3, "terms_per_block": 8}])
def test_copies_ties_and_awkward_rows(spark, more):
    rng = random.Random(7)
    words = ["the", "The", "of", "é", "42", "x_y", "Ünder", "zeta", "漢字", "alpha", "beta"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 9)))) for i in range(300)]
    docs += [(1000 - i, "the same of alpha") for i in range(200)]
    docs += [(None, "the same of alpha"), (None, None), (7, "beta " * 30_000), (7, "beta"), (7, "beta"), (2**60, "zeta\x00zeta"), (5000, "!!! \t")]
    items = [(1, "The alpha, the beta"), (1, "zeta 漢字"), (2, None), (3, "..."), (None, "of 42 é"), (4, "unheard"), (5, "the same of alpha")]
    check(spark, docs, items, **more)


def test_empty_tables(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a")], [])


def test_a_block_of_many_classes_keeps_the_best(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(f"w{int(rng.expovariate(0.2))}" for _ in range(rng.randint(1, 30)))) for i in range(3000)]
    check(spark, docs, [(i, f"w{i} w{i + 3} w{2 * i}") for i in range(12)])
