"""Mixing to target weights by soft membership.

A naive Bayes classifier, learned from the labelled table, gives each document a probability for each domain. Rates are
fitted by projected gradient: from rate 1 on, each step lowers the squares of the domains' misses and is cut to
[0, max_rate], with momentum that is dropped where it points uphill. The misses are those of the stated shares, so the size
of the mix is free; steps go on until no share misses its weight by more than TOLERANCE. Weights that only a mix of fewer
than LEAST of the tokens could have cannot be met: the squares are then those of token totals, at the stated weights
and as large as the domain of the largest weight allows without repeats, down to a stated bound on what is left to gain
(GAP); there is a warning with the shares that this optimum has. A document's rate is the same steps taken for its
own probabilities. `achieved_shares` gives wanted, present and achieved shares. All steps are DataFrame expressions and aggregates.

Scale: words meet a broadcast table of fixed size (a row for each hash bucket) inside one pass over the texts; a document's
sums are complete before they are shuffled. Log-odds lie on a grid, so that rare domains keep their small
probabilities, and the steps run over one row for each posterior; the driver sees a few numbers a step. Rates
reached are written every REPLAY steps, so that no plan grows with their number. The classifier learns from a
bounded sample of labelled rows (`max_rows`, the smallest hashes of doc_id), whose ids are broadcast.

Null text counts as empty: no tokens, the prior as posterior. Rows that repeat a doc_id are one document whose words
add up; rows without doc_id are told apart by their text. Labels that contradict each other, or are null, teach nothing. Without labels the
posteriors are null and all rates 1. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangarline.llm.common import fresh_name, written

#: Domains of the labelled table and the weights that a mix should have.
TARGET_WEIGHTS = {"clean": 0.96, "toxic": 0.03, "low_quality": 0.01}
MAX_ROWS = 20_000
BUCKETS = 1 << 15
#: A bucket says something of a domain if its texts there differ from the expected number by so many deviations.
SIGNIFICANCE = 3.0
#: Log-odds to the likeliest domain are rounded to one part in GRID and end at FLOOR.
GRID = 16
FLOOR = -14.0
STEPS = 400
REPLAY = 10
#: A fit is met if no domain's share of tokens misses its weight by more.
TOLERANCE = 1e-5
#: A least squares fit ends where no rates can lower its value by more than this part of it.
GAP = 1e-3
#: The pull of each rate to 1 in that fit, which settles rates that the totals leave open.
PULL = 1e-3
MAX_RATE = 16.0
LEAST = 0.1


def domain_labels(labels: DataFrame) -> DataFrame:
    """doc_id, domain, of the table of quality and toxicity labels."""
    domain = F.when(F.col("quality") == 0, "low_quality").when(F.col("toxic") == 1, "toxic")
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    return known.select(F.col("doc_id").cast("long"), domain.otherwise("clean").alias("domain"))


def own_hash() -> Column:
    """What stands for a document without doc_id: a hash of its text. Equal texts are one document."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def _words(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id and the other columns, with a row for each word and its bucket; one row without a bucket for empty texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    word = F.explode(F.split(text, r"[\x20\x09-\x0D]+")).alias("word")
    rows = docs.select(F.col("doc_id").cast("long"), own_hash().alias("own"), *others, word)
    bucket = F.pmod(F.hash(F.lower(F.btrim("word", F.lit(".,;:")))), F.lit(BUCKETS))
    return rows.select("doc_id", "own", *others, F.when(F.col("word") != "", bucket).alias("bucket"))


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def learned_weights(docs: DataFrame, domains: DataFrame, max_rows: int = MAX_ROWS) -> tuple[list[str], list[float], DataFrame]:
    """The domains; the log-odds of a text in which no telling word occurs; for each bucket what a word adds (w0, w1, ...)."""
    agreed = domains.groupBy("doc_id").agg(F.min("domain").alias("domain"), F.max("domain").alias("high"))
    sample = agreed.where("domain = high").select("doc_id", "domain").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    labelled = docs.select("doc_id", "text").join(F.broadcast(sample.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))
    present = _words(labelled, "domain").drop("own").where("bucket IS NOT NULL").distinct()  # a text counts a bucket once
    counts = written(present.groupBy("bucket", "domain").count())
    sizes = labelled.groupBy("domain").agg(F.count_distinct("doc_id").alias("n")).collect()
    totals = {row["domain"]: row["n"] for row in sizes}
    names, everything = sorted(totals), sum(totals.values())
    weights, absences = [], []
    for i, name in enumerate(names):
        count = F.coalesce(F.sum(F.when(F.col("domain") == name, F.col("count"))), F.lit(0))
        share = F.sum("count") / (everything + 1)
        own = (count + share) / (totals[name] + 1)
        expected = share * totals[name]
        differs = F.abs(count - expected) >= SIGNIFICANCE * F.sqrt(expected + 1)
        odds = F.log(own / (1 - own)) - F.log(share / (1 - share))
        weights.append(F.when(differs, odds).otherwise(0.0).alias(f"w{i}"))
        absences.append(F.when(differs, F.log((1 - own) / (1 - share))).otherwise(0.0).alias(f"a{i}"))
    if not names:
        return [], [], counts
    table = counts.groupBy("bucket").agg(*weights, *absences)
    absent = table.agg(*[F.sum(f"a{i}").alias(f"a{i}") for i in range(len(names))]).first()
    biases = [math.log(totals[name] / everything) + float(absent[i] or 0) for i, name in enumerate(names)]
    return names, biases, table.drop(*[f"a{i}" for i in range(len(names))])


def posteriors(docs: DataFrame, domains: DataFrame, max_rows: int = MAX_ROWS) -> tuple[list[str], DataFrame]:
    """The domains, and doc_id, own, tokens, p0, p1, ...: each document's words and its probabilities on a grid."""
    names, priors, weights = learned_weights(docs, domains, max_rows)
    words = _words(docs)
    if not names:
        return names, words.groupBy("doc_id", "own").agg(F.count("bucket").alias("tokens"))
    k = range(len(names))
    joined = words.join(F.broadcast(weights), "bucket", "left")
    sums = joined.groupBy("doc_id", "own").agg(F.count("bucket").alias("tokens"), *[F.sum(f"w{i}").alias(f"s{i}") for i in k])
    logits = [F.lit(priors[i]) + F.coalesce(F.col(f"s{i}"), F.lit(0.0)) for i in k]
    rows = sums.select("doc_id", "own", "tokens", *[logit.alias(f"l{i}") for i, logit in enumerate(logits)])
    rows = rows.withColumn("high", F.greatest(*[F.col(f"l{i}") for i in k]) if len(names) > 1 else F.col("l0"))
    odds = [F.greatest(F.lit(FLOOR), F.round((F.col(f"l{i}") - F.col("high")) * GRID) / GRID) for i in k]
    mass = _sum([F.exp(o) for o in odds])
    return names, rows.select("doc_id", "own", "tokens", *[(F.exp(o) / mass).alias(f"p{i}") for i, o in enumerate(odds)])


def targets_of(available: list[float], weights: list[float]) -> list[float]:
    """Token targets at the given weights, as large as the domain of the largest weight allows without repeats."""
    largest = max(range(len(weights)), key=lambda i: weights[i])
    whole = available[largest] / weights[largest] if weights[largest] else 0.0
    return [w * whole for w in weights]


def _stepped(features: list[str], steps: list[list[float]], cap: float, start: str = "named_struct('r', 1.0D, 'y', 1.0D)") -> str:
    """SQL for the rate `r`, and for the point `y` that the next step starts from, after the given steps.

    A step: for each feature what it takes off the rate, the momentum, and how far the rate is pulled to 1.
    """
    if not steps:
        return start
    rows = ", ".join("array(" + ", ".join(f"{x!r}D" for x in step) + ")" for step in steps)
    taken = " + ".join(f"({feature}) * s[{i}]" for i, feature in enumerate(features))
    last = len(features)
    rate = f"greatest(0.0D, least({float(cap)!r}D, a.y - ({taken}) - s[{last + 1}] * (a.y - 1.0D)))"
    moved = f"transform(array({rate}), r -> named_struct('r', r, 'y', r + s[{last}] * (r - a.r)))[0]"
    return f"aggregate(array({rows}), {start}, (a, s) -> {moved})"


def _projected(
    cells: DataFrame, features: list[str], goals: np.ndarray, metric: np.ndarray, cap: float, pull: float, ended
) -> tuple[list[list[float]], np.ndarray]:
    """Steps of projected gradient, and the sums tokens * rate * feature they reach.

    They lower misses * metric * misses + pull * (sum of tokens * (rate - 1)^2); misses: these sums less the goals. ended(steps, sums, gap): whether to stop; gap() bounds how much lower the value
    can get, by the best that any rates in [0, cap] promise along the slope.
    """
    k = range(len(features))
    start = "named_struct('r', 1.0D, 'y', 1.0D)"
    state = cells.selectExpr("CAST(tokens AS DOUBLE) AS t", *[f"{f} AS f{i}" for i, f in enumerate(features)], f"{start} AS a")
    own = [f"f{i}" for i in k]
    products = [f"sum(t * f{i} * f{j})" for i in k for j in k]
    gram = np.array([float(x or 0) for x in state.agg(*map(F.expr, products)).first()]).reshape(len(features), -1)
    root = np.linalg.cholesky(metric + 1e-12 * np.trace(metric) * np.eye(len(features)))
    rate = 1 / max(float(np.linalg.eigvalsh(root.T @ gram @ root).max()) + pull, 1e-300)
    steps: list[list[float]] = []
    recent: list[list[float]] = []
    speed, sums = 1.0, np.zeros(len(features))
    while True:
        if len(recent) == REPLAY:
            state = written(state.selectExpr("t", *own, f"{_stepped(own, recent, cap, 'a')} AS a"))
            recent = []
        now = state.selectExpr("t", *own, f"{_stepped(own, recent, cap, 'a')} AS a")
        at = {"r": [f"sum(t * a.r * f{i})" for i in k], "y": [f"sum(t * a.y * f{i})" for i in k]}
        found = np.array([float(x or 0) for x in now.agg(*map(F.expr, at["r"] + at["y"])).first()])
        previous, sums, ahead = sums, found[: len(features)], found[len(features) :]

        def gap(now: DataFrame = now, sums: np.ndarray = sums) -> float:
            slope = " + ".join(f"f{i} * {x!r}D" for i, x in enumerate((metric @ (sums - goals)).tolist()))
            slope += f" + {pull!r}D * (a.r - 1.0D)"
            bound = now.selectExpr("t", "a.r AS r", f"{slope} AS h").agg(F.expr(f"sum(t * (h * r - least(h * {float(cap)!r}D, 0.0D)))"))
            return 2 * float(bound.first()[0] or 0)

        if len(steps) >= STEPS or ended(len(steps), sums, gap):
            return steps, sums
        uphill = metric @ (ahead - goals)
        if steps and uphill @ (sums - previous) > 0:  # the momentum points uphill
            speed = 1.0
        faster = (1 + math.sqrt(1 + 4 * speed * speed)) / 2
        step = [*(rate * uphill).tolist(), (speed - 1) / faster, rate * pull]
        speed = faster
        steps.append(step)
        recent.append(step)


def fitted_rate(cells: DataFrame, weights: list[float], max_rate: float) -> Column:
    """The rate of a posterior as an expression over p0, p1, ...; cells: p0, p1, ..., tokens. See the module's text."""
    k = range(len(weights))
    totals = cells.agg(*[F.expr(f"sum(tokens * p{i})") for i in k], *[F.expr(f"sum(tokens * p{i} * p{i})") for i in k]).first()
    available, masses = [float(x or 0) for x in totals[: len(weights)]], [float(x or 0) for x in totals[len(weights) :]]
    whole = sum(available)
    weights = [w if a else 0.0 for w, a in zip(weights, available, strict=True)]
    if not sum(weights):
        return F.lit(1.0)
    weights = [w / sum(weights) for w in weights]
    targets = np.array(targets_of(available, weights))

    # What a token adds to the misses of the shares, and to the size of the mix.
    shares = [f"(p{i} - {w!r}D)" for i, w in enumerate(weights)]
    rows = cells.selectExpr("CAST(tokens AS DOUBLE) AS t", *[f"{x} AS f{i}" for i, x in enumerate(shares)])
    products = rows.agg(*[F.expr(f"sum(t * f{i} * f{j})") for i in k for j in k]).first()
    gram = np.array([float(x or 0) for x in products]).reshape(len(weights), -1)
    metric = np.linalg.pinv(gram, rcond=1e-10)

    # The size of the mix takes part as a feature without goal: its row of the metric is zero.
    sized, wide = [*shares, "1.0D"], np.zeros((len(weights) + 1, len(weights) + 1))
    wide[:-1, :-1] = metric
    state = {"met": False}

    def shares_met(steps: int, sums: np.ndarray, gap) -> bool:
        size = float(sums[-1])
        state["met"] = size >= LEAST * min(whole, targets.sum()) and float(np.abs(sums[:-1]).max()) <= TOLERANCE * size
        return state["met"] or size < LEAST * min(whole, targets.sum())

    steps, _ = _projected(cells, sized, np.zeros(len(sized)), wide, max_rate, 0.0, shares_met)
    if state["met"]:
        return F.expr(f"{_stepped(sized, steps, max_rate)}.r")

    plain = [f"p{i}" for i in k]
    metric = np.diag([1 / m if m else 0.0 for m in masses])

    def lowest(steps: int, sums: np.ndarray, gap) -> bool:
        value = float((sums - targets) @ metric @ (sums - targets))
        if value <= TOLERANCE**2 * float(targets @ metric @ targets):
            return True
        return steps % REPLAY == 0 and gap() <= GAP * value

    cap = min(1.0, max_rate)  # what cannot have its shares is not repeated either
    steps, sums = _projected(cells, plain, targets, metric, cap, PULL, lowest)
    got = [round(float(x) / (float(sums.sum()) or 1), 5) for x in sums]
    ends = "" if len(steps) < STEPS else f" after {STEPS} steps"
    warnings.warn(f"mixing: shares {[round(w, 5) for w in weights]} cannot be met, achieved {got}{ends}", stacklevel=2)
    return F.expr(f"{_stepped(plain, steps, cap)}.r")


def mixed(
    docs: DataFrame,
    domains: DataFrame,
    weights: Mapping[str, float] = TARGET_WEIGHTS,
    max_rate: float = MAX_RATE,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """doc_id, own, tokens, domain, posteriors, rate, copies: the whole part of the rate, and one more by a hash of doc_id.

    own: the hash of the text of a document without doc_id.
    """
    names, scored = posteriors(docs, domains, max_rows)
    if not names:
        none = F.lit(None)
        return scored.select(
            "doc_id", "own", "tokens", none.cast("string").alias("domain"), none.cast("map<string,double>").alias("posteriors"),
            F.lit(1.0).alias("rate"), F.lit(1).alias("copies"),
        )
    scored = written(scored)
    p = [F.col(f"p{i}") for i in range(len(names))]
    cells = written(scored.groupBy(*p).agg(F.sum("tokens").alias("tokens")))
    rate = fitted_rate(cells, [weights.get(name, 0.0) for name in names], max_rate)
    rated = scored.withColumn("rate", rate)
    best = F.greatest(*p) if len(p) > 1 else p[0]
    domain = F.coalesce(*[F.when(p[i] == best, F.lit(name)) for i, name in enumerate(names)])
    uniform = F.pmod(F.xxhash64("doc_id", "own", F.lit("copies")), F.lit(1 << 53)) / float(1 << 53)
    copies = F.floor("rate") + (uniform < F.col("rate") - F.floor("rate")).cast("int")
    named = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*p))
    return rated.select(
        "doc_id", "own", "tokens", domain.alias("domain"), named.alias("posteriors"), "rate", copies.cast("int").alias("copies")
    )


def achieved_shares(rows: DataFrame, weights: Mapping[str, float] = TARGET_WEIGHTS) -> DataFrame:
    """domain, wanted, present, achieved, copied: shares of tokens; before, after the rates, and after whole copies. rows: of `mixed`."""
    parts = rows.select("tokens", "rate", "copies", F.explode("posteriors").alias("domain", "p"))
    amounts = {"present": F.lit(1.0), "achieved": F.col("rate"), "copied": F.col("copies")}
    sums = parts.groupBy("domain").agg(*[F.sum(F.col("tokens") * F.col("p") * x).alias(name) for name, x in amounts.items()])
    whole = sums.agg(*[F.sum(name).alias(f"_{name}") for name in amounts])
    stated = rows.sparkSession.createDataFrame(list(weights.items()), "domain string, wanted double")
    shares = [F.coalesce(F.col(name) / F.nullif(F.col(f"_{name}"), F.lit(0.0)), F.lit(0.0)).alias(name) for name in amounts]
    return stated.join(sums, "domain", "full").crossJoin(whole).select("domain", F.coalesce("wanted", F.lit(0.0)).alias("wanted"), *shares)


def mixed_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with their own columns, each as often as its copies say."""
    mixed_id, mixed_own, own, copy = (fresh_name(docs, name) for name in ("mixed_id", "mixed_own", "own_hash", "copy"))
    copies = mixed(docs.select("doc_id", "text"), domain_labels(labels)).where("copies > 0")
    each = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(copy)
    copies = copies.select(F.col("doc_id").alias(mixed_id), F.col("own").alias(mixed_own), each).drop(copy)
    rows = docs.withColumn(own, own_hash())
    same = F.col("doc_id").eqNullSafe(F.col(mixed_id)) & F.col(own).eqNullSafe(F.col(mixed_own))
    return rows.join(copies, same).drop(mixed_id, mixed_own, own)
