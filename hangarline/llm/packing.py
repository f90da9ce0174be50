"""Packing of documents into training sequences of several context sizes.

A document becomes the ids of its text and a closing id. Whole windows of the largest size are cut off first. What is
left is routed to the smallest context size that holds it. Each size, from the largest down, opens a window with its
longest piece and fills the gap with the longest pieces of shorter sizes that still fit; a last piece is cut so that the
window is full. The few ids at the end of a group are dealt into sequences whose lengths are powers of two, which
need no padding either. Sequences are then dealt, longest first, to step groups of an equal number of ids.

Scale: one pass over the scan and no shuffle. A group is part of one Arrow batch of one input partition and bounded
in bytes, so memory does not depend on the number of documents; a repeated task gives the same pieces, because the
batch's documents are taken in the scan's order. Sequence and step ids carry the partition's number.

Null text counts as empty and gives the closing id alone. Documents keep their doc_id, null or repeated, as it is.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hangarline.llm.common import text_parts

CONTEXTS = (2048, 1024, 512, 256)
STEP_TOKENS = 8 * 2048
GROUP_BYTES = 32 << 20
CLOSING_ID = 1
MAX_CACHED_PIECES = 1 << 20
#: Fixed value: how the vocabulary marks the last token of a piece.
PIECE_END = "</w>"
#: Words whose normal form is plain, for which the tokenizer file's normalizer can be skipped but for lower
#: case, and the pieces that the file cuts lower-cased words of these characters into.
PLAIN_WORD = r"^[\x21-\x7eÀ-ÖØ-öø-ÿ]*$"
PIECES = r"('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+)"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones themselves, others from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _gathered(ids: np.ndarray, starts: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of slots one after the other, and how many each has. Slot i holds ids[starts[i] : starts[i + 1]]."""
    counts = np.diff(starts)[slots]
    before = np.concatenate([[0], np.cumsum(counts)])
    within = np.arange(int(before[-1])) - np.repeat(before[:-1], counts)
    return ids[np.repeat(starts[slots], counts) + within], counts


class _Growing:
    """An array that grows by doubling."""

    def __init__(self, kind: type, first: list[int]):
        self.room, self.size = np.array(first + [0], dtype=kind), len(first)

    def extend(self, more: np.ndarray) -> None:
        if self.size + len(more) > len(self.room):
            room = np.empty(max(2 * len(self.room), self.size + len(more)), dtype=self.room.dtype)
            room[: self.size] = self.room[: self.size]
            self.room = room
        self.room[self.size : self.size + len(more)] = more
        self.size += len(more)

    def values(self) -> np.ndarray:
        return self.room[: self.size]


class WordIds:
    """Ids of texts: each distinct word of a batch is cut into pieces once, each piece encoded once for a worker.

    Pieces recur where words do not, with other punctuation or capitals around them. The number of remembered pieces is
    bounded: when there are too many, those that came back in the current batch stay.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)
        self.letters = _byte_letters()
        vocabulary = self.whole.get_vocab()
        self.ends_piece = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_piece[[number for token, number in vocabulary.items() if token.endswith(PIECE_END)]] = True
        self._forget([])

    def _forget(self, kept: list[str]) -> None:
        """Forgets all pieces but these."""
        if kept:
            slots = np.array([self.index[piece] for piece in kept], dtype=np.int64)
            ids, counts = _gathered(self.ids.values(), self.starts.values(), slots)
        else:
            kept, ids, counts = [""], np.empty(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        self.index = {piece: slot for slot, piece in enumerate(kept)}
        self.ids, self.starts = _Growing(np.uint32, []), _Growing(np.int64, [0])
        self.ids.extend(ids)
        self.starts.extend(np.cumsum(counts))

    def _learn(self, pieces: list[str]) -> None:
        lettered = [x if x.isascii() else x.encode().decode("latin-1").translate(self.letters) for x in pieces]
        for low in range(0, len(pieces), 4096):
            part = lettered[low : low + 4096]
            (encoding,) = self.bare.encode_batch_fast([part], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(encoding.ids, dtype=np.uint32)
            ends = np.flatnonzero(self.ends_piece[ids]) + 1
            if len(ends) != len(part):  # a piece that ends otherwise: the slower call tells pieces apart
                slow = self.bare.encode(part, is_pretokenized=True, add_special_tokens=False)
                ends = np.cumsum(np.bincount(np.array(slow.word_ids, dtype=np.int64), minlength=len(part)))
            self.starts.extend(self.ids.size + ends)
            self.ids.extend(ids)
        self.index.update(zip(pieces, range(len(self.index), len(self.index) + len(pieces)), strict=True))

    def _plain_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words one after the other, and how many each has."""
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(words), PIECES, r"\1 "))
        coded = pc.dictionary_encode(cut.flatten())
        pieces = coded.dictionary.to_pylist()
        if len(self.index) + len(pieces) > MAX_CACHED_PIECES:
            self._forget(sorted({piece for piece in pieces if piece in self.index} | {""}))
        self._learn([piece for piece in pieces if piece not in self.index])
        slots = np.fromiter((self.index[piece] for piece in pieces), dtype=np.int64, count=len(pieces))
        slots = slots[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else slots
        ids, counts = _gathered(self.ids.values(), self.starts.values(), slots)
        ends = np.cumsum(cut.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        before = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(np.concatenate([[0], before[ends]]))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and where each word's begin, with the end."""
        plain = pc.match_substring_regex(words, PLAIN_WORD)
        plain = pc.and_(plain, pc.invert(pc.match_substring(words, "<|")))
        ids, counts = self._plain_words(words.filter(plain))
        is_plain = plain.to_numpy(zero_copy_only=False).astype(bool)
        if is_plain.all():
            return ids, np.concatenate([[0], np.cumsum(counts)])
        others = words.filter(pc.invert(plain)).to_pylist()
        whole = [e.ids for e in self.whole.encode_batch_fast(others, add_special_tokens=False)]
        starts = np.concatenate([[0], np.cumsum(counts), ids.size + np.cumsum([len(e) for e in whole])]).astype(np.int64)
        ids = np.concatenate([ids, np.array([x for e in whole for x in e], dtype=np.uint32)])
        order = np.empty(len(words), dtype=np.int64)  # where a word was put: plain ones first
        order[is_plain], order[~is_plain] = np.arange(len(counts)), len(counts) + np.arange(len(others))
        ids, counts = _gathered(ids, starts, order)
        return ids, np.concatenate([[0], np.cumsum(counts)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with the closing id after each text; and where each text's ids begin, with the end."""
        texts = pc.fill_null(texts, "")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)  # the tokenizer does so itself, but for its special tokens
        split = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(split.flatten())
        ids, starts = self._words(coded.dictionary)
        of_word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        found, counts = _gathered(ids, starts, of_word)
        bounds = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        before = np.concatenate([[0], np.cumsum(counts)])[bounds]
        out = np.full(len(found) + len(texts), CLOSING_ID, dtype=np.uint32)
        out[np.arange(len(found)) + np.repeat(np.arange(len(texts)), np.diff(before))] = found
        return out, before + np.arange(len(bounds))


class _Pool:
    """Pieces (length, order, document, start) in the order of their length."""

    def __init__(self, pieces: list[tuple[int, int, int, int]]):
        self.pieces = sorted(pieces)

    def __len__(self) -> int:
        return len(self.pieces)

    def longest(self, at_most: int) -> tuple[int, int, int, int] | None:
        at = bisect_right(self.pieces, (at_most, 1 << 62, 0, 0))
        return self.pieces.pop(at - 1) if at else None

    def put(self, piece: tuple[int, int, int, int]) -> None:
        insort(self.pieces, piece)


def packed(doc_tokens: list[int], contexts: tuple[int, ...] = CONTEXTS) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document's number, start, length) that hold each id of each document once.

    Every sequence is full: its length is a context size, or a smaller power of two for the last ids.
    """
    largest = contexts[0]
    sequences: list[list[tuple[int, int, int]]] = []
    routed: dict[int, list[tuple[int, int, int, int]]] = {size: [] for size in contexts}
    for number, tokens in enumerate(doc_tokens):
        sequences += [[(number, start, largest)] for start in range(0, tokens - largest + 1, largest)]
        rest = tokens % largest
        if rest:
            routed[min(size for size in contexts if size >= rest)].append((rest, -number, number, tokens - rest))
    pools = {size: _Pool(pieces) for size, pieces in routed.items()}
    last: list[tuple[int, int, int]] = []
    for tier, size in enumerate(contexts):
        fillers = [pools[shorter] for shorter in contexts[tier + 1 :]] + [pools[size]]
        while pools[size]:
            piece = pools[size].longest(size)
            window, gap = [(piece[2], piece[3], piece[0])], size - piece[0]
            while gap:
                piece = next((found for pool in fillers if (found := pool.longest(gap))), None)
                if piece is None:
                    piece = next((found for pool in fillers if (found := pool.longest(size))), None)
                    if piece is None:
                        break
                    length, order, number, start = piece
                    rest = (length - gap, order, number, start + gap)
                    pools[min(s for s in contexts if s >= rest[0])].put(rest)
                    piece = (gap, order, number, start)
                window.append((piece[2], piece[3], piece[0]))
                gap -= piece[0]
            if gap:
                last += window
            else:
                sequences.append(window)
    return sequences + _powers_of_two(last, largest)


def _powers_of_two(pieces: list[tuple[int, int, int]], largest: int) -> list[list[tuple[int, int, int]]]:
    """The pieces in their order, cut into sequences of the largest size and then of falling powers of two."""
    left, sequences, queue = sum(length for _, _, length in pieces), [], list(reversed(pieces))
    while left:
        size = largest if left >= largest else 1 << (left.bit_length() - 1)
        left -= size
        window: list[tuple[int, int, int]] = []
        while size:
            number, start, length = queue.pop()
            taken = min(length, size)
            window.append((number, start, taken))
            size -= taken
            if taken < length:
                queue.append((number, start + taken, length - taken))
        sequences.append(window)
    return sequences


_WORD_IDS: dict[str, WordIds] = {}
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "context long, step_id long"
)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    for batch in batches:
        for low, high in text_parts(batch.column(1), GROUP_BYTES):
            yield batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low)


def _pack_batches(path: str, contexts: tuple[int, ...], step_tokens: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _WORD_IDS:
            _WORD_IDS[path] = WordIds(path)
        encoder = _WORD_IDS[path]
        context = TaskContext.get()
        sequence = step = (context.partitionId() if context else 0) << 36
        for doc_ids, texts in _groups(batches):
            ids, starts = encoder.encode(texts)
            doc_tokens = np.diff(starts)
            sequences = sorted(packed(doc_tokens.tolist(), contexts), key=lambda s: -sum(piece[2] for piece in s))
            rows: list[tuple[int, int, int, int, int, int, int]] = []
            in_step = 0
            for pieces in sequences:
                size = sum(piece[2] for piece in pieces)
                if in_step + size > step_tokens:
                    step, in_step = step + 1, 0
                in_step += size
                offset = 0
                for number, start, length in pieces:
                    rows.append((number, start, length, sequence, offset, size, step))
                    offset += length
                sequence += 1
            step += 1
            table = np.array(rows, dtype=np.int64).reshape(-1, 7)
            number, begin = table[:, 0], starts[table[:, 0]] + table[:, 1]
            cut = [ids[b : b + n] for b, n in zip(begin.tolist(), table[:, 2].tolist(), strict=True)]
            columns = {
                "doc_id": doc_ids.take(pa.array(number)).cast(pa.int64()),
                "start": table[:, 1],
                "length": table[:, 2],
                "ids_crc32": np.array([zlib.crc32(piece) for piece in cut], dtype=np.int64),
                "doc_tokens": doc_tokens[number],
                "sequence_id": table[:, 3],
                "offset": table[:, 4],
                "context": table[:, 5],
                "step_id": table[:, 6],
            }
            if with_ids:
                columns["ids"] = pa.array([piece.astype(np.int32) for piece in cut], type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    contexts: tuple[int, ...] = CONTEXTS,
    step_tokens: int = STEP_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece of a document, with the sequence and step group it lies in; on request with its ids.

    contexts: powers of two, the largest first. tokenizer: a tokenizer file, on every executor.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(_pack_batches(tokenizer, tuple(contexts), step_tokens, with_ids), schema)
