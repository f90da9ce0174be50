"""The Merkle manifest against a direct tree, its block layout, and awkward rows."""

import zlib
from hashlib import sha256

import numpy as np
import pytest

from hangarline.llm import merkle
from hangarline.llm.common import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, branch string, total string, own int"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    parts = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h("".join("-" if p is None else f"{len(p.encode())}:{p}" for p in parts))


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(leaves):
    """The root, and for each leaf the siblings on the way, left and right."""
    paths, places, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for path, i in zip(paths, places, strict=True):
            run = level[i - i % 8 : i - i % 8 + 8]
            path.append((run[: i % 8], run[i % 8 + 1 :]))
        level = [h("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        places = [i // 8 for i in places]
    return level[0], paths


def expected(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of rows (doc_id, text, lang, source, n_chars)."""
    branches = {}
    for row in rows:
        branches.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(*row), row))
    order = sorted(branches, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in order:
        branches[lang].sort(key=lambda x: x[:3])
        trees[lang] = tree([x[2] for x in branches[lang]])
    root, upper = tree([trees[lang][0] for lang in order])
    out = []
    for lang, above in zip(order, upper, strict=True):
        for (_, _, leaf, row), path in zip(branches[lang], trees[lang][1], strict=True):
            doc_id, text, *rest = row
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
            node = leaf_of(doc_id, lowered(text), *rest) if tampered else leaf
            steps = path + above
            for left, right in steps:
                node = h("".join(left) + node + "".join(right))
            proof = h("".join("".join(left) + "".join(right) for left, right in steps))
            out.append((doc_id, leaf, trees[lang][0], root, proof, node, node == root))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(spark, rows):
    ship_package(spark)
    table = spark.createDataFrame([(*row, "x", "y", 7) for row in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.tampered_manifest(table).select(COLUMNS).collect()), key=key)


def test_awkward_rows(spark):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(70)]
    rows += [(i, "A", lang, None, None) for i, lang in enumerate(["zz", "", None, "éa", "ab", "aB", "a", "b", "c", "d"])]
    rows += [(5, "Text 5", "en", "s", 5), (5, "other", "en", "s", 5), (None, None, None, None, None), (None, "", "en", "", 0)]
    rows += [(900, "LONG Word " * 30_000, "de", "s", -3), (-7, "Ärger", "de", "s", 0)]
    assert found(spark, rows) == sorted(expected(rows), key=key)


def test_one_row_and_no_rows(spark):
    assert found(spark, [(0, "Abc", "en", "s", 3)]) == expected([(0, "Abc", "en", "s", 3)])
    assert found(spark, []) == []


def test_several_rounds_of_blocks(spark, monkeypatch):
    ship_package(spark)
    rows = [(i, f"T{i}", "en" if i % 9 else "fr", "s", 1) for i in range(9 * merkle.LEAVES // 8 + 13)]
    assert found(spark, rows) == sorted(expected(rows), key=key)


@pytest.mark.parametrize("height", [0, 1, 2, 3, 4, 5])
def test_layout_gives_each_node_a_place_and_keeps_subtrees_together(height):
    places = [merkle.addresses(height, depth, np.arange(8**depth)) for depth in range(height + 1)]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.block_levels(height)))
    upper = (height + 1) // 2
    if height:  # the upper half comes first, then each lower subtree in one stretch
        assert sorted(np.concatenate(places[:upper]).tolist()) == list(range(merkle.block_levels(upper - 1)))
        lower = height - upper
        for root in range(8**upper):
            own = [places[upper + d][root * 8**d : (root + 1) * 8**d] for d in range(lower + 1)]
            first = merkle.block_levels(upper - 1) + root * merkle.block_levels(lower)
            assert sorted(np.concatenate(own).tolist()) == list(range(first, first + merkle.block_levels(lower)))


def test_siblings_fold_to_the_root(spark):
    ship_package(spark)
    table = spark.createDataFrame([(i, "T", "en", "s", 1, "x", "y", 1) for i in range(20)], SCHEMA)
    leaves = merkle.document_leaves(table, merkle.F.lit("t")).withColumn("claim", merkle.F.lit(None).cast("binary"))
    for row in merkle.manifest(leaves, with_siblings=True).collect():
        assert row.verified and h("".join(row.siblings)) == row.proof_sha256
