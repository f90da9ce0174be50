"""The mix has the stated shares: scarce domains are repeated, overlapping posteriors are fitted until they are met."""

import numpy as np
import pytest

from hangarline.llm import mixing
from hangarline.llm.common import ship_package


def fitted_shares(spark, p, tokens, weights, max_rate=mixing.MAX_RATE):
    rows = [(*map(float, x), int(t)) for x, t in zip(p, tokens, strict=True)]
    cells = spark.createDataFrame(rows, "p0 double, p1 double, p2 double, tokens long")
    rate = np.array([r.rate for r in cells.select(mixing.fitted_rate(cells, weights, max_rate).alias("rate")).collect()])
    totals = (tokens * rate) @ p
    return rate, totals / totals.sum()


@pytest.mark.parametrize("scarce", [(0.01, 0.005), (0.1, 0.0011), (0.4, 0.3)])
def test_scarce_and_plentiful_domains_get_their_share(spark, scarce):
    p = np.eye(3)
    tokens = np.array([round(1e6 * (1 - sum(scarce))), round(1e6 * scarce[0]), round(1e6 * scarce[1])])
    rate, shares = fitted_shares(spark, p, tokens, [0.96, 0.03, 0.01])
    assert shares == pytest.approx([0.96, 0.03, 0.01], abs=1e-4)
    assert rate[0] * tokens[0] >= 0.9 * tokens[0]


@pytest.mark.parametrize("max_rate", [1.0, 16.0])
def test_overlapping_posteriors_are_fitted_to_the_shares(spark, max_rate):
    rng = np.random.default_rng(8)
    p = rng.dirichlet([2.0, 0.3, 0.05], 400)
    rate, shares = fitted_shares(spark, p, rng.integers(1, 900, 400), [0.96, 0.03, 0.01], max_rate)
    assert shares == pytest.approx([0.96, 0.03, 0.01], abs=1e-4) and rate.min() >= 0 and rate.max() <= max_rate


def test_shares_that_cannot_be_met_are_told(spark):
    p = np.array([[0.7, 0.3, 0.0], [0.6, 0.4, 0.0]])
    with pytest.warns(UserWarning, match="cannot be met"):
        rate, _ = fitted_shares(spark, p, np.array([500, 500]), [0.96, 0.04, 0.0])
    assert rate.max() <= 1


def test_achieved_shares_of_documents(spark):
    ship_package(spark)
    words = {"clean": "plain", "toxic": "vile", "low_quality": "junk"}
    kinds = ["clean"] * 960 + ["toxic"] * 30 + ["low_quality"] * 4
    docs = spark.createDataFrame([(i, f"{words[x]} {words[x]}s the") for i, x in enumerate(kinds)], "doc_id long, text string")
    domains = spark.createDataFrame(list(enumerate(kinds)), "doc_id long, domain string")
    shares = {r.domain: r for r in mixing.achieved_shares(mixing.mixed(docs, domains)).collect()}
    for name, weight in mixing.TARGET_WEIGHTS.items():
        assert shares[name].wanted == weight and shares[name].achieved == pytest.approx(weight, abs=1e-4)
        assert shares[name].copied == pytest.approx(weight, abs=0.02)
    assert shares["low_quality"].present < 0.006
