"""Templates are induced by tree matching: against all matchings of small trees, and on hosts whose pages carry ids of their own."""

import random
from itertools import combinations

import duckdb

from hangarline.llm import html
from hangarline.llm.common import ship_package

SCHEMA = "page_id long, url string, html string"


def random_layout(rng, depth=3):
    kind = rng.choice("ab") + " " + rng.choice(["", "class=x"])
    return [kind, [random_layout(rng, depth - 1) for _ in range(rng.randint(0, 3))] if depth else []]


def best_by_trial(a, b):
    """The weight of the best matching of two layouts, over all ordered choices of equally many children."""
    if a[0].partition(" ")[0] != b[0].partition(" ")[0]:
        return 0
    best = 0
    for k in range(min(len(a[1]), len(b[1])) + 1):
        for left in combinations(a[1], k):
            for right in combinations(b[1], k):
                best = max(best, sum(best_by_trial(x, y) for x, y in zip(left, right, strict=True)))
    return best + html.PAIR + (a[0] == b[0])


def test_matching_equals_trial_of_all_matchings():
    rng = random.Random(3)
    for _ in range(200):
        a, b = random_layout(rng), random_layout(rng)
        weight, pairs = html.tree_match(html._place(a), html._place(b))
        assert weight == best_by_trial(a, b)
        assert pairs == sorted(pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
        if weight:
            own = html.PAIR + (a[0] == b[0])
            assert weight == own + sum(best_by_trial(a[1][i], b[1][j]) for i, j in pairs)


PAGE = (
    "<html><body class='postid-{0} {1}'><div class='{1}'><div class='{2}'>Buy now at our shop</div>{3}<p>Story {0}</p></div>"
    "<div>All rights with us</div></body></html>"
)


def word(rng):
    return "".join(rng.choices("abcdefghij", k=8))


def own_pages(number=24, seed=1):
    """Pages whose every class is their own, some with one more node before the story."""
    rng = random.Random(seed)
    return [PAGE.format(i, word(rng), word(rng), f"<ul><li>Note {i}</li></ul>" if i % 3 == 0 else "") for i in range(number)]


def expected(i):
    return f"Note {i}\nStory {i}" if i % 3 == 0 else f"Story {i}"


def test_constants_are_found_by_position_whatever_the_classes(monkeypatch):
    monkeypatch.setattr(html, "DROPPED_CLASSES", frozenset())
    assert html.extract_group(own_pages()) == [expected(i) for i in range(24)]


def test_without_matching_the_constants_stay(monkeypatch):
    monkeypatch.setattr(html, "tree_match", lambda place, tree, known=None: (0, []))
    assert all("Buy now" in text for text in html.extract_group(own_pages()))


def test_spark_equals_the_host_at_once(spark):
    ship_package(spark)
    pages = own_pages(40)
    rows = [(i, f"http://h/{i}", page) for i, page in enumerate(pages)]
    rows += [(100, None, None), (101, "http://other/", pages[0]), (102, "http://h/0", pages[0]), (None, "x", "")]
    got = html.main_texts(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    found = {r.page_id: r.text for r in got}
    assert {i: found[i] for i in range(40)} == {i: expected(i) for i in range(40)}
    assert found[100] == found[None] == "" and found[102] == expected(0)
    assert found[101].startswith("Buy now at our shop")  # alone on its host, nothing is constant
    assert html.main_texts(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0


def test_pages_of_many_own_nodes_end():
    rng = random.Random(2)
    page = "<html><body><p>Buy now</p>{0}</body></html>"
    pages = [page.format("".join(f"<p id={word(rng)}>t{i}.{k}</p>" for k in range(500))) for i in range(64)]
    texts = html.extract_group(pages)
    assert all(len(text.split("\n")) == 500 and "Buy" not in text for text in texts)


def test_given_pages_do_not_depend_on_the_class_words(monkeypatch):
    pages = duckdb.sql("SELECT html FROM '/root/testdata/sf0.001/pages.parquet' ORDER BY page_id").fetchall()
    pages = [page for (page,) in pages]
    whole = html.extract_group(pages)
    monkeypatch.setattr(html, "DROPPED_CLASSES", frozenset())
    assert html.extract_group(pages) == whole
