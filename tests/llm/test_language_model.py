"""The language model equals a plain Kneser-Ney model, whatever the script, the number of languages and the sharding."""

import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from hangarline.llm import language
from hangarline.llm.common import ship_package

SCHEMA = "doc_id long, text string, lang string"
ALPHABETS = {
    "zh": [chr(0x4E00 + 37 * i) for i in range(400)],
    "ru": [chr(0x430 + i) for i in range(32)],
    "el": [chr(0x3B1 + i) for i in range(24)],
    "ar": [chr(0x627 + i) for i in range(19)],
    "en": list("abcdefghijklmnopqrstuvwxyz"),
    "gothic": [chr(0x10330 + i) for i in range(20)],
}


def texts_of(letters, number, rng):
    words = ["".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(40)]
    return [" ".join(rng.choices(words, k=rng.randint(1, 30))) + rng.choice(["", "!", " 12"]) for _ in range(number)]


def grams_of(text):
    kept = re.sub(r"\0+", "\0", "".join(c if c.isalpha() else "\0" for c in text.lower()))
    if not kept.strip("\0"):
        return []
    kept = kept.lstrip("\0").rstrip("\0") + ("\0" if kept.endswith("\0") else "")
    padded = "\0\0\0" + kept + "\0"
    return [padded[i : i + 4] for i in range(len(padded) - 3)]


def plain_model(texts):
    """A function: nats of a gram's last character."""
    counts = {4: Counter(g for text in texts for g in grams_of(text))}
    for order in (3, 2, 1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    orders = {}
    for order, table in counts.items():
        t = Counter(table.values())
        discount = [0.0, *language._discounts(t[1], t[2], t[3], t[4])]
        followers = defaultdict(list)
        for gram, count in table.items():
            followers[gram[:-1]].append(count)
        orders[order] = (table, discount, followers)

    def probability(gram):
        if not gram:
            return 1 / language.ALPHABET
        table, discount, followers = orders[len(gram)]
        below, seen = probability(gram[1:]), followers.get(gram[:-1])
        if not seen:
            return below
        count = table[gram]
        held_back = sum(discount[min(c, 3)] for c in seen)
        return (max(0.0, count - discount[min(count, 3)]) + held_back * below) / sum(seen)

    return lambda gram: -math.log(probability(gram))


def scripts(spark, number=30):
    rng, rows = random.Random(5), []
    for lang, letters in ALPHABETS.items():
        rows += [(len(rows) + i, text, lang) for i, text in enumerate(texts_of(letters, number, rng))]
    return spark.createDataFrame(rows, SCHEMA)


def test_entropies_equal_a_plain_model(spark):
    ship_package(spark)
    docs = scripts(spark).repartition(3)
    trains = ~language.held_out(F.col("doc_id"))
    taught = docs.withColumn("lang", F.when(trains, F.col("lang")))
    rows = taught.collect()
    models = {
        lang: plain_model([r.text for r in rows if r.lang == lang]) for lang in sorted({r.lang for r in rows if r.lang})
    }
    for chunk_bytes, counts_per_shard in ((1 << 20, 1 << 16), (2_000, 300)):
        got = {r.doc_id: r for r in language.scores(taught, chunk_bytes, counts_per_shard).collect()}
        assert len(got) == len(rows)
        for row in rows:
            grams = grams_of(row.text)
            assert got[row.doc_id].n_characters == len(grams)
            entropies = {lang: sum(map(nats, grams)) / len(grams) for lang, nats in models.items()}
            best = min(entropies, key=entropies.get)
            assert got[row.doc_id].lang_pred == best
            assert abs(got[row.doc_id].entropy - entropies[best]) < 1e-9


def test_scripts_beyond_latin_are_told_apart(spark):
    ship_package(spark)
    docs = scripts(spark)
    got = language.identify(docs, chunk_bytes=5_000).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert got and all(r.lang_pred == r.lang for r in got)


def test_grams_of_one_context_that_differ_in_the_last_character_stay_apart():
    contexts, lasts, sizes = language.letter_grams(["ab", "a\U00010330", "", "5"])
    assert sizes.tolist() == [3, 3, 0, 0]
    known, ends, codes = language.distinct_grams(contexts, lasts)
    assert len(known) == 5 and known[codes].tolist() == contexts.tolist() and ends[codes].tolist() == lasts.tolist()


def test_without_learning_rows_everything_is_undetermined(spark):
    ship_package(spark)
    rows = [(None, "some words", "en"), (1, "some words", None), (2, None, "en"), (3, "7 8", "en")]
    got = language.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 4 and all(r.lang_pred == "und" and r.score == 0 and not (r.n_characters and r.entropy) for r in got)
