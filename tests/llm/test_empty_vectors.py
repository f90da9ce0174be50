"""Empty vectors are compared with each other and do not end the query."""

from hangarline.llm import topk
from hangarline.llm.common import ship_package


def test_empty_vectors_are_built_and_searched(spark):
    ship_package(spark)
    rows = [(50, []), (51, []), (52, []), (100, [1.0, 0.0]), (101, [0.5, 0.5])]
    got = topk.embedding_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    found = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    assert found == [(50, 1, 51, 0), (50, 2, 52, 0), (100, 1, 101, 128 * 256)]
