"""Language identification: one interpolated Kneser-Ney model of characters for each language.

Texts are lower-cased; letters stay, each run of other characters becomes one break. Four-character grams of code points
are counted for each language over all learning rows; lower orders count distinct continuations. A gram is its context
(up to three code points of 21 bits) and its last character, both whole, so that no two grams share a count. The model
is a table of shards by order and context: each holds its contexts and grams in sorted arrays, with the counts of the languages that
have them. A text gets the language with the lowest cross-entropy for each character; `accepted` tells whether that
entropy is within the range of the language's own held-back texts.

Scale: the model grows with the corpus, is complete, and is in no place whole. Texts are written once, in chunks of bounded
bytes (a longer text is a chunk of its own), to a table bucketed by chunk, and never shuffled. A chunk asks each shard for its distinct grams in one
binary row; a shard answers bounded groups of chunks, each group a task, so a gram that all chunks ask for is no hot
key: it is one entry of each of their rows. A context has at most as many grams as there are letters, which bounds what one context adds to a shard.
The driver gets four numbers for each language and order. Memory of a task grows with the number of languages; groups shrink by it.

Null text and texts without letters get `und`, score 0, not accepted. Rows with a null lang or doc_id teach nothing.
Without learning rows every text gets `und`. Very long texts are scored whole. Repeated rows are predicted one by one.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hangarline.llm.common import shards_for, written
from hangarline.llm.quality import chunked

ORDER = 4
#: Unicode code points have 21 bits.
POINT_BITS = 21
#: An unknown character counts as one of so many, about the letters that Unicode has.
ALPHABET = 1 << 17
HELD_OUT_OF, HELD_OUT_IS = 3, 1
#: Of the learning rows: pmod(xxhash64(doc_id), FOLDS) = 0 calibrates, the others train.
FOLDS = 10
ACCEPTED_QUANTILE = 0.999
#: The score counts evidence up to about so many characters, as neighbouring characters are not independent.
SCORE_CHARACTERS = 30
CHUNK_BYTES = 8 << 20
COUNTS_PER_SHARD = 1 << 16
#: A task answers about so many chunks' worth of grams, divided by the number of languages.
CHUNKS_PER_TASK = 64
UNDETERMINED = "und"


def held_out(doc_id: Column) -> Column:
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF
    return F.coalesce(remainder == HELD_OUT_IS, F.lit(False))


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point to itself if it is a letter, else to 0."""
    if not _LETTERS:
        letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        _LETTERS.append(np.where(letters, np.arange(0x110000), 0).astype(np.int32))
    return _LETTERS[0]


def letter_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts and last characters of the grams, one for each letter or break of each text and one for its end; how
    many each text has. A text without letters has none.
    """
    lowered = [text.lower() for text in texts]
    points = _letters()[np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    sizes = np.array([len(text) for text in lowered], dtype=np.int64)
    firsts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    before = np.concatenate([[0], points[:-1]]) if len(points) else points
    before[firsts[firsts < len(before)]] = 0
    stays = (points != 0) | (before != 0)
    kept = np.add.reduceat(np.append(stays, False).astype(np.int64), firsts) if len(sizes) else sizes
    kept[sizes == 0] = 0
    points = points[stays]
    starts = np.concatenate([[0], np.cumsum(kept + ORDER)])[:-1]
    padded = np.zeros(int((kept + ORDER).sum()), dtype=np.int64)
    own = np.concatenate([[0], np.cumsum(kept)])[:-1]
    padded[np.arange(len(points)) + np.repeat(starts + ORDER - 1 - own, kept)] = points
    counts = np.where(kept > 0, kept + 1, 0)
    at = np.arange(int(counts.sum())) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
    contexts = np.zeros(len(at), dtype=np.int64)
    for i in range(ORDER - 1):
        contexts = (contexts << POINT_BITS) | padded[at + i]
    return contexts, padded[at + ORDER - 1], counts


def distinct_grams(contexts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct grams, sorted, and the number of each given gram among them."""
    of_context, known = pd.factorize(contexts, sort=True)
    codes, keys = pd.factorize((of_context.astype(np.int64) << POINT_BITS) | lasts, sort=True)
    return known[keys >> POINT_BITS], keys & ((1 << POINT_BITS) - 1), codes


def shorter(contexts: np.ndarray, order: int) -> np.ndarray:
    """Contexts of an order without what that order does not see."""
    return contexts & ((1 << (order - 1) * POINT_BITS) - 1)


def gram_levels(contexts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The number of each gram among the distinct ones; by order those, and the number of each in the order below."""
    contexts, lasts, codes = distinct_grams(contexts, lasts)
    levels = {}
    for order in range(ORDER, 0, -1):
        below = distinct_grams(shorter(contexts, order - 1), lasts) if order > 1 else (None, None, None)
        levels[order] = (contexts, lasts, below[2])
        contexts, lasts = below[:2]
    return codes, levels


def _texts(row: pd.Series) -> list[str]:
    sizes = np.frombuffer(row["sizes"], dtype=np.int64)
    whole = zstandard.ZstdDecompressor().decompress(row["text"], max_output_size=int(sizes.sum())) if sizes.sum() else b""
    ends = np.cumsum(sizes).tolist()
    return [whole[low:high].decode("utf-8", "surrogatepass") for low, high in zip([0, *ends], ends)]


COUNT_SCHEMA = "lang string, context long, last long, count long"
ASKED_SCHEMA = "chunk long, grams int, contexts binary, lasts binary, `order` int"
GRAM_SCHEMA = f"{ASKED_SCHEMA}, {COUNT_SCHEMA}"


def _chunk_grams(table: pa.Table) -> pa.Table:
    """A chunk's distinct grams of each order in one row each, and the counts of its learning documents by language."""
    found = []
    for row in table.to_pylist():
        contexts, lasts, sizes = letter_grams(_texts(row))
        codes, levels = gram_levels(contexts, lasts)
        for order, (level, ends, _) in levels.items():
            asked = {"grams": len(level), "contexts": level.tobytes(), "lasts": ends.astype(np.int32).tobytes()}
            found.append({"chunk": row["chunk"], "order": order} | asked)
        of_row, langs = pd.factorize(np.array(row["langs"], dtype=object))
        spread, (level, ends, _) = np.repeat(of_row, sizes), levels[ORDER]
        taught = [pa.Table.from_pylist(found, _ARROW)]
        for number, lang in enumerate(langs):
            counts = np.bincount(codes[spread == number], minlength=len(level))
            seen = np.flatnonzero(counts)
            columns = {f.name: pa.nulls(len(seen), f.type) for f in _ARROW}
            columns |= {"lang": pa.array([lang] * len(seen), pa.string()), "context": level[seen]}
            columns |= {"last": ends[seen], "count": counts[seen]}
            taught.append(pa.table(columns, schema=_ARROW))
    return pa.concat_tables(taught)


_ARROW = pa.schema(
    [("chunk", pa.int64()), ("grams", pa.int32()), ("contexts", pa.binary()), ("lasts", pa.binary()), ("order", pa.int32())]
    + [("lang", pa.string()), ("context", pa.int64()), ("last", pa.int64()), ("count", pa.int64())]
)


def _discounts(t1: float, t2: float, t3: float, t4: float) -> tuple[float, float, float]:
    if min(t1, t2, t3, t4) <= 0:
        return 0.5, 1.0, 1.5
    y = t1 / (t1 + 2 * t2)
    found = (1 - 2 * y * t2 / t1, 2 - 3 * y * t3 / t2, 3 - 4 * y * t4 / t3)
    return tuple(min(max(d, 0.01), limit - 0.01) for d, limit in zip(found, (1, 2, 3), strict=True))


def count_tables(counted: DataFrame) -> DataFrame:
    """order, lang, context, last, count of all orders: occurrences in the highest, distinct continuations below."""
    table = written(counted.groupBy("lang", "context", "last").agg(F.sum("count").alias("count")))
    parts = table.withColumn("order", F.lit(ORDER))
    for order in range(ORDER - 1, 0, -1):
        context = F.col("context").bitwiseAND(F.lit((1 << (order - 1) * POINT_BITS) - 1).cast("long")).alias("context")
        table = table.groupBy("lang", context, "last").agg(F.count("*").alias("count"))
        parts = parts.unionByName(table.withColumn("order", F.lit(order)))
    return written(parts)


def _entries(found: np.ndarray, of: np.ndarray, lang: np.ndarray, values: np.ndarray, languages: int) -> np.ndarray:
    """For each wanted number (-1: unknown) a row of values by language, from entries sorted by number."""
    out = np.zeros((len(found), languages, values.shape[1]), dtype=np.int64)
    low, high = np.searchsorted(of, found, "left"), np.searchsorted(of, found, "right")
    sizes = high - low
    at = np.arange(int(sizes.sum())) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
    out[np.repeat(np.arange(len(found)), sizes), lang[at]] = values[at]
    return out


class Shard:
    """Sorted arrays of contexts and of grams of one order, with counts by language for those that have any."""

    def __init__(self, rows: pd.DataFrame, languages: list[str]):
        self.languages = len(languages)
        lang = pd.Categorical(rows["lang"], categories=languages).codes.astype(np.int64)
        context, last, count = (rows[c].to_numpy(np.int64) for c in ("context", "last", "count"))
        self.contexts, of_context = np.unique(context, return_inverse=True)
        self.grams, of_gram = np.unique((of_context << POINT_BITS) | last, return_inverse=True)
        by_gram = np.argsort(of_gram, kind="stable")
        self.of_gram, self.gram_lang, self.counts = of_gram[by_gram], lang[by_gram], count[by_gram][:, None]
        pairs, of_pair = np.unique(of_context * max(1, self.languages) + lang, return_inverse=True)
        self.of_context, self.context_lang = pairs // max(1, self.languages), pairs % max(1, self.languages)
        self.stats = np.zeros((len(pairs), 4), dtype=np.int64)
        for column, values in enumerate((count, count == 1, count == 2, count > 2)):
            np.add.at(self.stats[:, column], of_pair, values.astype(np.int64))

    @staticmethod
    def _number(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[at] == keys, at, -1)

    def answer(self, contexts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the grams by language; total and how often counts are 1, 2, more by context and language."""
        different, of = np.unique(contexts, return_inverse=True)
        numbers = self._number(self.contexts, different)
        keys = np.where(numbers[of] < 0, -1, (numbers[of] << POINT_BITS) | lasts)
        counts = _entries(self._number(self.grams, keys), self.of_gram, self.gram_lang, self.counts, self.languages)
        return counts[:, :, 0], _entries(numbers, self.of_context, self.context_lang, self.stats, self.languages)


ANSWER_SCHEMA = "chunk long, `order` int, shard int, counts binary, stats binary"


def _answer_chunks(languages: list[str]):
    def run(model: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        shard, out = Shard(model, languages), []
        for row in asked.to_dict("records"):
            contexts, lasts = np.frombuffer(row["contexts"], np.int64), np.frombuffer(row["lasts"], np.int32).astype(np.int64)
            counts, stats = shard.answer(contexts, lasts)
            out.append((row["chunk"], row["order"], row["shard"], counts.tobytes(), stats.tobytes()))
        return pd.DataFrame(out, columns=["chunk", "order", "shard", "counts", "stats"])

    return run


def _deal(shards: int):
    """Grams of one order that a chunk asks for, one row for each shard."""

    def run(table: pa.Table) -> pa.Table:
        found = []
        for row in table.to_pylist():
            contexts, lasts = np.frombuffer(row["contexts"], np.int64), np.frombuffer(row["lasts"], np.int32)
            shard = contexts % shards
            for number in np.unique(shard).tolist():
                mine = shard == number
                grams = {"contexts": contexts[mine].tobytes(), "lasts": lasts[mine].tobytes()}
                found.append({"chunk": row["chunk"], "order": row["order"], "shard": number} | grams)
        return pa.Table.from_pylist(found, _DEALT)

    return run


_DEALT = pa.schema(
    [("chunk", pa.int64()), ("order", pa.int32()), ("shard", pa.int32()), ("contexts", pa.binary()), ("lasts", pa.binary())]
)
DEALT_SCHEMA = "chunk long, `order` int, shard int, contexts binary, lasts binary"


def probabilities(count: np.ndarray, stats: np.ndarray, discounts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """One order of the interpolation, for grams and languages. discounts: by count up to 3, and language."""
    total, n1, n2, n3 = np.moveaxis(stats, 2, 0)
    held_back = discounts[1] * n1 + discounts[2] * n2 + discounts[3] * n3
    discount = np.take_along_axis(discounts, np.minimum(count, 3), axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        seen = (np.maximum(count - discount, 0) + held_back * below) / total
    return np.where(total > 0, seen, below)


class ChunkModel:
    """What a chunk needs of the model: the answers to its own grams."""

    def __init__(self, languages: list[str], discounts: dict[int, np.ndarray], shards: int, answers: pd.DataFrame):
        self.languages, self.discounts, self.shards = languages, discounts, shards
        self.answers = {(r["order"], r["shard"]): (r["counts"], r["stats"]) for r in answers.to_dict("records")}

    def _order(self, order: int, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and context statistics of a chunk's grams, from the shards' answers."""
        n = len(self.languages)
        counts, stats = np.zeros((len(contexts), n), dtype=np.int64), np.zeros((len(contexts), n, 4), dtype=np.int64)
        shard = contexts % self.shards
        for number in np.unique(shard).tolist():
            mine = np.flatnonzero(shard == number)
            found = self.answers.get((order, number))
            if found is None:  # the model has no such shard: none of its grams was learned
                continue
            counts[mine] = np.frombuffer(found[0], np.int64).reshape(-1, n)
            of = np.unique(contexts[mine], return_inverse=True)[1]
            stats[mine] = np.frombuffer(found[1], np.int64).reshape(-1, n, 4)[of]
        return counts, stats

    def entropies(self, contexts: np.ndarray, lasts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each text and language the nats for a character."""
        codes, levels = gram_levels(contexts, lasts)
        p = np.full((len(levels[1][0]), len(self.languages)), 1.0 / ALPHABET)
        for order in range(1, ORDER + 1):
            own, _, below = levels[order]
            p = probabilities(*self._order(order, own), self.discounts[order], p if order == 1 else p[below])
        nats = -np.log(p)
        out = np.full((len(sizes), len(self.languages)), np.inf)
        full = np.flatnonzero(sizes)
        if len(full):
            starts = (np.cumsum(sizes) - sizes)[full]
            for lang in range(len(self.languages)):
                out[full, lang] = np.add.reduceat(nats[:, lang][codes], starts) / sizes[full]
        return out


SCORE_SCHEMA = "doc_id long, lang_pred string, score double, entropy double, n_characters long"


def _score_chunk(languages: list[str], discounts: dict[int, np.ndarray], shards: int):
    def run(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({name: [] for name in ("doc_id", "lang_pred", "score", "entropy", "n_characters")})]
        for _, row in chunk.iterrows():
            contexts, lasts, sizes = letter_grams(_texts(row))
            n = len(sizes)
            lang, score, entropy = np.full(n, UNDETERMINED, dtype=object), np.zeros(n), np.full(n, np.nan)
            full = np.flatnonzero(sizes)
            if languages and len(full):
                found = ChunkModel(languages, discounts, shards, answers).entropies(contexts, lasts, sizes)[full]
                best = found.argmin(axis=1)
                entropy[full] = found[np.arange(len(full)), best]
                weight = sizes[full] / (1 + sizes[full] / SCORE_CHARACTERS)
                score[full] = 1 / np.exp(-(found - entropy[full, None]) * weight[:, None]).sum(axis=1)
                lang[full] = np.array(languages, dtype=object)[best]
            ids = pd.array([None if x is None or x != x else int(x) for x in row["doc_ids"]], dtype="Int64")
            out.append(pd.DataFrame({"doc_id": ids, "lang_pred": lang, "score": score, "entropy": entropy, "n_characters": sizes}))
        return pd.concat(out[1:] or out)

    return run


def scores(rows: DataFrame, chunk_bytes: int = CHUNK_BYTES, counts_per_shard: int = COUNTS_PER_SHARD) -> DataFrame:
    """doc_id, lang_pred, score, entropy, n_characters. rows: doc_id, text, and lang where the row trains, else null."""
    chunks = chunked(rows, chunk_bytes)
    grams = written(chunks.groupBy("chunk").applyInArrow(_chunk_grams, GRAM_SCHEMA))
    model = count_tables(grams.where("lang IS NOT NULL").select("lang", "context", "last", "count"))
    kinds = [F.count_if(F.col("count") == k).alias(f"t{k}") for k in (1, 2, 3, 4)]
    found = model.groupBy("lang", "order").agg(F.count("*").alias("n"), *kinds).collect()
    languages = sorted({row.lang for row in found})
    discounts = {order: np.zeros((4, len(languages))) for order in range(1, ORDER + 1)}
    for row in found:
        discounts[row.order][1:, languages.index(row.lang)] = _discounts(row.t1, row.t2, row.t3, row.t4)
    shards = shards_for(sum(row.n for row in found), counts_per_shard) | 1  # odd: no character decides alone
    groups = shards_for(chunks.count(), max(1, CHUNKS_PER_TASK // max(1, len(languages))) * shards)
    group = F.pmod(F.xxhash64("chunk"), F.lit(groups))
    asked = grams.where("lang IS NULL AND grams > 0").select("chunk", "order", "contexts", "lasts")
    asked = asked.groupBy("chunk", "order").applyInArrow(_deal(shards), DEALT_SCHEMA).withColumn("group", group)
    placed = model.withColumn("shard", (F.col("context") % shards).cast("int"))
    placed = placed.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    keys = ("order", "shard", "group")
    answers = placed.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_answer_chunks(languages), ANSWER_SCHEMA)
    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return scored.applyInPandas(_score_chunk(languages, discounts, shards), SCORE_SCHEMA)


def identify(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, counts_per_shard: int = COUNTS_PER_SHARD) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, n_characters, accepted."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    calibrates = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    trains = F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")) & ~calibrates
    taught = rows.select("doc_id", F.when(trains, F.col("lang")).alias("lang"), "text")
    scored = written(scores(taught, chunk_bytes, counts_per_shard))
    own = scored.where((F.col("n_characters") > 0) & ~held_out(F.col("doc_id")) & calibrates)
    limit = F.percentile_approx("entropy", F.lit(ACCEPTED_QUANTILE), F.lit(100_000))
    limits = own.groupBy(F.col("lang_pred").alias("limited")).agg(limit.alias("limit"))
    joined = scored.join(limits, F.col("lang_pred") == F.col("limited"), "left")
    accepted = (F.col("n_characters") > 0) & F.coalesce(F.col("entropy") <= F.col("limit"), F.lit(True))
    return joined.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "entropy", "n_characters",
        accepted.alias("accepted"),
    )
