r"""Personal data in texts: regular expressions propose spans, checksums and ranges confirm them, words before them count.

Each kind has a pattern, a check of what it matched, and words that make a match more or less credible when they stand
in the 48 characters before it (and after the previous match of the kind). A match that fails its check is dropped and not
tried again from a later start. E-mail addresses, IP addresses, card numbers (Luhn) and phone numbers are kept whatever
their score; bank accounts (IBAN, mod 97) and social security numbers only from a score of 50 of 100 on, which the latter
reach by their context alone.

Everything is one projection of Spark functions: no Python worker, no shuffle. Positions are not given by Spark's
functions, so they are running sums of the lengths of matches and of what lies between them, taken within chunks and then
over the chunks' totals: a text with very many matches does not cost the square of their number. The patterns are
possessive and start only where a match can start, which finds what the plain patterns find, in time linear in the text
even if that is one word of a million letters.

Null text counts as empty, without spans. Every row gives one row, repeated ones and those without doc_id too. Spans of
different kinds may overlap; matches of one kind do not. An empty table gives an empty result. Columns other than the id
and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARACTERS = 48
CONTEXT_POINTS = 30
LEAST_POINTS = 50
#: How many lengths are summed one after the other before the next level of sums.
CHUNK = 256


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Every second digit from the right counts twice, its digits summed; the total is a multiple of 10."""

    def step(total: Column, place: Column) -> Column:
        digit = F.substr(digits, place, F.lit(1)).cast("int")
        twice = F.floor(digit * 2 / 10).cast("int") + digit * 2 % 10
        return total + F.when((F.length(digits) - place) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def passes_mod97(account: Column) -> Column:
    """The first four characters put last, and letters read as 10 to 35, the number leaves 1 when divided by 97."""
    moved = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def step(rest: Column, character: Column) -> Column:
        code = F.ascii(character)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def _is_ip(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^(?:{part}\.){{3}}{part}$")


def _is_card(match: Column) -> Column:
    digits = _digits(match)
    return F.when(F.length(digits).between(13, 19), passes_luhn(digits)).otherwise(F.lit(False))


@dataclass(frozen=True)
class Kind:
    """pattern: what Spark looks for. plain: the same matches in an expression without possessive or look-behind parts.

    quick: what a text must hold for the pattern to be worth trying. points: the score of a confirmed match.
    """

    name: str
    pattern: str
    plain: str
    quick: Callable[[Column], Column]
    check: Callable[[Column], Column]
    points: int
    likely: str
    unlikely: str = ""
    always: bool = True


#: The patterns of the four kinds that are always kept.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
SOCIAL = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"

KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        EMAIL,
        lambda text: text.contains("@"),
        lambda match: F.lit(True),
        70,
        "mail|contact|write|correo|courriel|schreib",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
        IP,
        lambda text: text.contains("."),
        _is_ip,
        50,
        "ip|address|host|server|login|adresse",
        "version|release|section|chapter",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        CARD,
        lambda text: text.rlike("[0-9]"),
        _is_card,
        60,
        "card|visa|credit|debit|payment|carte|tarjeta|karte",
        "isbn|order|serial",
    ),
    Kind(
        "phone",
        PHONE,
        PHONE,
        lambda text: text.contains("+"),
        lambda match: F.length(_digits(match)).between(9, 15),
        60,
        "phone|call|tel|mobile|fax|whatsapp",
    ),
    Kind(
        "iban",
        IBAN,
        IBAN,
        lambda text: text.rlike("[A-Z]{2}[0-9]{2}"),
        lambda match: passes_mod97(F.replace(match, F.lit(" "), F.lit(""))),
        80,
        "iban|account|bank|konto|compte|cuenta",
        always=False,
    ),
    Kind(
        "ssn",
        SOCIAL,
        SOCIAL,
        lambda text: text.rlike("[0-9]-[0-9]{2}-[0-9]"),
        lambda match: ~match.rlike("^(?:000|666|9..)|-00-|-0000$"),
        30,
        "ssn|social security|social insurance",
        "order|part no|serial",
        always=False,
    ),
)
BASE = tuple(kind.name for kind in KINDS if kind.always)


def _running(sizes: Column) -> Column:
    """0 and the sums of the first sizes, of the first two, and so on."""
    start = F.array(F.lit(0).cast("long"))
    return F.aggregate(sizes, start, lambda sums, size: F.concat(sums, F.array(F.element_at(sums, -1) + size)))


def _chunk_sums(sizes: str) -> Column:
    numbers = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int"))
    return F.transform(numbers, lambda n: _running(F.slice(F.col(sizes), n * CHUNK + 1, CHUNK)))


def _joined_sums(sums: str, before: str) -> Column:
    def without_total(sums: Column) -> Column:
        return F.slice(sums, 1, F.size(sums) - 1)

    pairs = F.arrays_zip(F.col(sums).alias("own"), without_total(F.col(before)).alias("start"))
    placed = F.transform(pairs, lambda p: F.transform(without_total(p.own), lambda x: x + p.start))
    return F.flatten(placed)


def _spans(kind: Kind, proposals: str, starts: str) -> Column:
    """The confirmed matches with their places and points, in the order of the text."""
    rows = F.arrays_zip(F.col(proposals).alias("found"), F.col(starts).alias("at"))
    rows = F.filter(rows, lambda row: row.found.match.isNotNull() & F.coalesce(kind.check(row.found.match), F.lit(False)))

    def span(row: Column) -> Column:
        context = F.lower(F.right(row.found.before, F.lit(CONTEXT_CHARACTERS)))
        points = F.lit(kind.points) + F.when(context.rlike(kind.likely), CONTEXT_POINTS).otherwise(0)
        if kind.unlikely:
            points = points - F.when(context.rlike(kind.unlikely), CONTEXT_POINTS).otherwise(0)
        start = row.at + F.length(row.found.before)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            start.alias("start"),
            (start + F.length(row.found.match)).alias("end"),
            F.least(points, F.lit(100)).alias("points"),
            row.found.match.alias("text"),
        )

    found = F.transform(rows, span)
    return found if kind.always else F.filter(found, lambda s: s.points >= LEAST_POINTS)


def find_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and `spans`: kind, start, end (code points, end exclusive), points (0 to 100) and text of each span.

    Spans are ordered by kind as in KINDS, then by start. Each step is a projection of its own, so that nothing is
    evaluated once for each element of an array that was meant to be evaluated once for each row.
    """
    text, names = F.col("_text"), [kind.name for kind in KINDS]
    rows = docs.select(F.col(id_column), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_text"))

    def proposals(kind: Kind) -> Column:
        before = F.split(text, kind.pattern, -1).alias("before")
        match = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("match")
        return F.when(kind.quick(text), F.arrays_zip(before, match)).alias(f"_{kind.name}")

    def stage(previous: DataFrame, keep: str, made: dict[str, Callable[[str], Column]]) -> DataFrame:
        columns = [F.col(f"_{name}{suffix}") for name in names for suffix in keep.split("|")]
        return previous.select(id_column, *columns, *[f(n).alias(f"_{n}{s}") for s, f in made.items() for n in names])

    def sizes(name: str) -> Column:
        return F.transform(f"_{name}", lambda p: (F.length(p.before) + F.coalesce(F.length(p.match), F.lit(0))).cast("long"))

    rows = rows.select(id_column, *[proposals(kind) for kind in KINDS])
    # Most texts hold no match of a kind: its proposals are the text alone and go no further.
    rows = rows.select(id_column, *[F.when(F.size(f"_{n}") > 1, F.col(f"_{n}")).alias(f"_{n}") for n in names])
    rows = stage(rows, "", {"_sizes": sizes})
    rows = stage(rows, "", {"_sums": lambda n: _chunk_sums(f"_{n}_sizes")})
    rows = stage(rows, "|_sums", {"_before": lambda n: _running(F.transform(f"_{n}_sums", lambda s: F.element_at(s, -1)))})
    rows = stage(rows, "", {"_starts": lambda n: _joined_sums(f"_{n}_sums", f"_{n}_before")})
    spans = [_spans(kind, f"_{kind.name}", f"_{kind.name}_starts") for kind in KINDS]
    return rows.select(id_column, F.flatten(F.filter(F.array(*spans), lambda s: s.isNotNull())).alias("spans"))


def _listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """For each document the number of spans of each kind, all spans as text, and the highest score (0 to 1)."""
    rows = find_spans(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s.kind.isin(*BASE))

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == name)).cast("long").alias(f"n_{name}")

    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s.points)), F.lit(0)) / 100
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *map(count, BASE),
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        best.alias("score"),
    )


def _oracle() -> str:
    """The same rows in DuckDB's SQL, from the plain patterns."""
    luhn = (
        "list_sum(list_transform(list_reverse(string_split(digits, '')), lambda c, i: "
        "CASE WHEN i % 2 = 0 THEN (c::INT * 2) // 10 + (c::INT * 2) % 10 ELSE c::INT END)) % 10 = 0"
    )
    moved = "replace(m, ' ', '')"
    rest = (
        f"list_reduce(list_transform(string_split({moved}[5:] || {moved}[:4], ''), lambda c: CASE WHEN ascii(c) < 58 THEN ascii(c) - 48 ELSE ascii(c) - 55 END::BIGINT), "
        "lambda a, v: CASE WHEN v < 10 THEN (a * 10 + v) % 97 ELSE (a * 100 + v) % 97 END, 0::BIGINT) = 1"
    )
    checks = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(m, '.'), lambda x: coalesce(try_cast(x AS HUGEINT) <= 255, false)))",
        "card": f"CASE WHEN length(digits) BETWEEN 13 AND 19 THEN {luhn} ELSE false END",
        "phone": "length(digits) BETWEEN 9 AND 15",
        "iban": rest,
        "ssn": "NOT regexp_matches(m, '^(?:000|666|9..)|-00-|-0000$')",
    }
    parts, spans = ["t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents)"], []
    for order, kind in enumerate(KINDS):
        n, pattern = kind.name, kind.plain
        points = f"{kind.points} + CASE WHEN regexp_matches(c, '{kind.likely}') THEN {CONTEXT_POINTS} ELSE 0 END"
        if kind.unlikely:
            points += f" - CASE WHEN regexp_matches(c, '{kind.unlikely}') THEN {CONTEXT_POINTS} ELSE 0 END"
        parts += [
            f"{n}0 AS (SELECT r, unnest(regexp_extract_all(text, '{pattern}')) AS m, unnest(string_split_regex(text, '{pattern}')) AS b, "
            f"generate_subscripts(string_split_regex(text, '{pattern}'), 1) AS i FROM t WHERE regexp_matches(text, '{pattern}'))",
            f"{n}1 AS (SELECT *, sum(length(b) + coalesce(length(m), 0)) OVER (PARTITION BY r ORDER BY i) AS e, "
            f"regexp_replace(m, '[^0-9]', '', 'g') AS digits, lower(right(b, {CONTEXT_CHARACTERS})) AS c FROM {n}0)",
        ]
        spans.append(
            f"SELECT r, {order} AS k, '{n}' AS kind, (e - length(m))::BIGINT AS s, e::BIGINT AS e, least({points}, 100) AS points "
            f"FROM {n}1 WHERE m IS NOT NULL AND {checks[n]}" + ("" if kind.always else f" AND {points} >= {LEAST_POINTS}")
        )
    listed = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s)"
    counts = ", ".join(f"count(*) FILTER (kind = '{n}') AS n_{n}" for n in BASE)
    base = ", ".join(f"'{n}'" for n in BASE)
    parts.append("a AS (" + " UNION ALL ".join(spans) + ")")
    parts.append(f"g AS (SELECT r, {counts}, {listed} FILTER (kind IN ({base})) AS base, {listed} AS spans, max(points) AS points FROM a GROUP BY r)")
    found = ", ".join(f"coalesce(n_{n}, 0) AS n_{n}" for n in BASE)
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, {found}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, "
        "coalesce(points, 0) / 100 AS score FROM t LEFT JOIN g USING (r)"
    )


ORACLE = _oracle()
