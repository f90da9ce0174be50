"""Personal data against Python's regular expressions and direct checks."""

import hashlib
import random
import re

from hangarline.llm import pii

SCHEMA = "doc_id long, text string, spans string, _text string, n_email int"
PLAIN = {"email": pii.EMAIL, "ip": pii.IP, "card": pii.CARD, "phone": pii.PHONE}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    for kind, pattern in PLAIN.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            valid = {
                "email": True,
                "ip": all(int(x) <= 255 for x in match[0].split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if valid:
                yield f"{kind}:{match.start()}:{match.end()}"


def scan(spark, texts):
    rows = [(i, text, "a", "b", 3) for i, text in enumerate(texts)]
    return {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}


def check(spark, texts):
    found = scan(spark, texts)
    for i, text in enumerate(texts):
        want = list(base_spans(text))
        row = found[i]
        assert [s for s in row.spans.split(",") if s and s.split(":")[0] in PLAIN] == want, text
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        kinds = [w.split(":")[0] for w in want]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [kinds.count(k) for k in PLAIN]


def test_texts_made_of_telling_parts(spark):
    rng = random.Random(4)
    parts = ["a@b.c", "@", ".", "-", " ", "+", "1", "42", "255", "256", "0001", "4111111111111111", "x%y", "é", "😀", "(", ")", "\n"]
    parts += ["1.2.3.4", "a.b@c-d.e", "+1 (555) 555-5555", "4111 1111 1111 1111", "word", "A1"]
    check(spark, ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(1500)])


def test_awkward_texts(spark):
    long_word, many = "a" * 4_000, " 12" * 20_000 + " 1.2.3.4 " + "x@y.zz " * 3000
    check(spark, [None, "", " ", "a@b.c.%x@y.z", "1.2.3.4.5.6.7.8", "+1" + " " * 5_000, long_word, long_word + "@b.c", many, "9" * 3_000, "1." * 50_000])


def test_a_word_of_a_million_letters_takes_time_in_proportion(spark):
    """The plain pattern would look at each letter once for each letter before it."""
    word = "a" * 1_000_000
    found = scan(spark, [word, word + "@b.c " + word, "7" * 1_000_000])
    assert [found[i].spans for i in range(3)] == ["", "email:0:1000004", ""]


def test_added_kinds_need_their_checks_or_words(spark):
    found = scan(
        spark,
        [
            "IBAN DE89 3704 0044 0532 0130 00 is mine",
            "IBAN DE89 3704 0044 0532 0130 01 is not",
            "GB82WEST12345698765432",
            "my SSN is 123-45-6789.",
            "part 123-45-6789",
            "social security 666-45-6789",
            "mail me: a@b.cd",
        ],
    )
    assert [found[i].spans for i in range(7)] == ["iban:5:32", "", "iban:0:22", "ssn:10:21", "", "", "email:9:15"]
    assert found[6].score == 1.0 and found[1].score == 0.0


def test_rows_without_id_repeated_rows_and_an_empty_table(spark):
    table = spark.createDataFrame([(None, "a@b.c", "", "", 0), (1, "a@b.c", "", "", 0), (1, "a@b.c", "", "", 0)], SCHEMA)
    assert sorted((r.doc_id or 0, r.n_email) for r in pii.personal_data(table).collect()) == [(0, 1), (1, 1), (1, 1)]
    assert pii.personal_data(table.limit(0)).count() == 0


def test_spans_hold_the_text(spark):
    text = "é😀 call +1 (555) 555-5555 now"
    (row,) = pii.find_spans(spark.createDataFrame([(1, text, "", "", 0)], SCHEMA)).collect()
    (span,) = row.spans
    assert text[span.start : span.end] == span.text == "+1 (555) 555-5555" and span.points == 90
