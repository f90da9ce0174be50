"""Every row but the query's own is a candidate, and scores are exact whatever the size of the components."""

import random

from hangarline.llm import topk
from hangarline.llm.common import ship_package


def by_trial(rows, k=5):
    """For each distinct query the (id, score) of its best rows, in order."""
    found = []
    for query_id, vector in sorted(set(rows)):
        if query_id % 50 == 0:
            others = list(rows)
            others.remove((query_id, vector))
            scores = [(-sum(a * b for a, b in zip(vector, other, strict=True)), i) for i, other in others]
            found.append((query_id, [(i, -s) for s, i in sorted(scores)[:k]]))
    return sorted(found)


def by_operator(spark, rows, **sizes):
    table = spark.createDataFrame([(i, list(v)) for i, v in rows], "vec_id long, vector array<long>").repartition(3)
    got = topk.top_k(table, table.where("vec_id % 50 = 0"), 5, **sizes).collect()
    assert len(got) == sum(len(best) for _, best in by_trial(rows))
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def as_rows(found):
    return sorted((q, n, i, s) for q, best in found for n, (i, s) in enumerate(best, start=1))


def test_rows_that_repeat_an_id_are_candidates_each(spark):
    ship_package(spark)
    rng = random.Random(4)
    rows = [(rng.randrange(0, 120), tuple(rng.randint(-40, 40) for _ in range(6))) for _ in range(600)]
    rows += [rows[0]] * 9 + [(50, (30, 30, 30, 30, 30, 30))] * 3 + [(7, (256, 0, 0, 0, 0, 0)), (7, (40, 40, 40, 40, 40, 40))]
    assert by_operator(spark, rows, vectors_per_shard=150) == as_rows(by_trial(rows))


def test_large_components_give_whole_scores(spark):
    ship_package(spark)
    rng = random.Random(5)
    rows = [(i, tuple(rng.randint(200_000_000, 260_000_000) for _ in range(8))) for i in range(400)]
    assert by_operator(spark, rows) == as_rows(by_trial(rows))
