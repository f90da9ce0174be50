"""Rows without doc_id are matched like all others."""

from hangarline.llm import licenses
from hangarline.llm.common import ship_package


def test_rows_without_doc_id_are_matched(spark):
    ship_package(spark)
    texts = ["code under the MIT license here", "code under the MIT license here", "nothing", None]
    named = licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).drop("doc_id")
    unnamed = licenses.license_scan(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string"))
    found = unnamed.collect()
    assert all(r.doc_id is None for r in found) and sorted(r.n_base for r in found) == [0, 0, 1, 1]
    assert sorted(map(str, unnamed.drop("doc_id").collect())) == sorted(map(str, named.collect()))
