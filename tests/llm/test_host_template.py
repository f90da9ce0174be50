"""Constant texts are those of the whole host, whatever its titles and however its pages are dealt."""

import pytest

from hangarline.llm import html
from hangarline.llm.common import ship_package

SCHEMA = "page_id long, url string, html string"
PAGE = "<html><head>{1}</head><body><div class=x1>Buy now at our shop</div><div class=x2><p>Story {0}</p></div></body></html>"


@pytest.mark.parametrize("title", ["", "<title>One title</title>"])
def test_hosts_of_one_title_have_a_template(spark, title):
    ship_package(spark)
    rows = [(i, f"http://h/{i}", PAGE.format(i, title)) for i in range(20)]
    got = html.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == {i: f"Story {i}" for i in range(20)}


def test_copies_do_not_hide_the_template_from_the_buckets(spark):
    ship_package(spark)
    rows = [(i, f"http://h/{i}", PAGE.format(max(i, 300), f"<title>T{max(i, 300)}</title>")) for i in range(330)]
    got = html.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == {i: f"Story {max(i, 300)}" for i in range(330)}
