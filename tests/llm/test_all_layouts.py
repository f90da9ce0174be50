"""Every layout of a host takes part in its template, in batches too."""

import json

from hangarline.llm import html
from hangarline.llm.common import ship_package

SCHEMA = "page_id long, url string, html string"
LETTERS = "abcdefghij"


def name(i):
    return "".join(LETTERS[int(x)] for x in str(i))


def page(i, layout, notice):
    """Pages of one layout share the class of their story."""
    above = "<div>Buy now at our shop</div>" if notice else ""
    return f"<html><head><title>T{i}</title></head><body>{above}<section><i class={name(layout)}>Story {i}</i></section></body></html>"


def pages():
    """40 layouts of two pages without the notice, 800 of one page with it: the frequent layouts lack what 90 % have."""
    found = [page(i, i // 2, False) for i in range(80)]
    return found + [page(i, i, True) for i in range(80, 880)]


def test_frequent_layouts_do_not_hide_what_the_others_share(spark):
    ship_package(spark)
    rows = [(i, f"http://h/{i}", text) for i, text in enumerate(pages())]
    rows += [(1000 + i, f"http://small/{i}", page(i, 0, True)) for i in range(20)]
    got = {r.page_id: r.text for r in html.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"Story {i % 1000}" for i, _, _ in rows}
    assert html.extract_group(pages()) == [f"Story {i}" for i in range(880)]


def test_templates_on_tables_equal_those_in_memory(spark):
    ship_package(spark)
    layouts = {}
    for i in range(1, 1500):  # each tag stands in a share of the layouts of its own, some in nearly half of them
        tags = [tag for k, tag in enumerate(("nav", "main", "aside", "table", "ul", "form")) if i * (2 * k + 3) % 16 < 6 + k]
        body = [f"{tag} class={name(i) if k % 2 else 'x'}" for k, tag in enumerate(tags)]
        layouts[json.dumps(["#root ", [["html ", [["body ", [[kind, []] for kind in body]]]]]])] = 1 + i % 9 * (i % 7)
    rows = [("h", n, n, layout) for layout, weight in layouts.items() for n in range(weight)] + [("few", n, n, "[\"#root \", []]") for n in range(9)]
    kinds = spark.createDataFrame(rows, "host string, title long, content long, layout string")
    hosts = spark.createDataFrame([("h", 100), ("few", 9), ("none", 3)], "host string, pages long")
    got = {r.host: json.loads(r.template) for r in html.host_templates(kinds, hosts).collect()}
    assert got == {"h": html.host_template(layouts).layout(), "few": ["#root ", []]}
    tags = [kind.partition(" ")[0] for kind, _ in got["h"][1][0][1][0][1]]
    whole = sum(layouts.values())
    shares = {t: sum(n for layout, n in layouts.items() if f'"{t} ' in layout) / whole for t in ("nav", "main", "aside", "table", "ul", "form")}
    assert sorted(tags) == sorted(t for t, share in shares.items() if share >= 0.5)
    assert any(0.4 < share < 0.5 for share in shares.values()) and any(0.5 <= share < 0.6 for share in shares.values())

