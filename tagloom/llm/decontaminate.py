"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

The CGK random walk embeds a string so that a small edit distance becomes a small
Hamming distance: at step j it emits its current symbol and moves on if a random
bit of (j, symbol) is set. Symbols here are normalised words. A few sampled
positions of an embedded window form an LSH key; repetitions over several walks
and samples reach the target recall; an exact edit distance decides.

Windows begin at words that have the least hash of some ``MINIMISER`` neighbours,
in texts and in items alike, so a copied passage has the same windows as the item.
Items that are too short for such a window are found exactly: with k edits allowed,
one of k + 1 pieces of the item is in the text unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import coded, decoded, hash_spans, materialise, mix, sized, text_slices

#: Consecutive words of which one at least begins a window.
MINIMISER = 6
#: Items, and words of items, whose keys one pass over the texts holds.
BLOCK_ITEMS = 20_000
BLOCK_WORDS = 1 << 20
#: Window lengths: each about half as long again as the one before.
WINDOWS = (8, 12, 18, 27, 40, 60, 90, 135, 202, 303, 454, 681, 1021)
#: Items of fewer words are found by their pieces; from here on a window starts early enough to fit.
MIN_WORDS = 13
#: Items of fewer words are reported, but no text is dropped for one: such words meet by chance.
MIN_ITEM_WORDS = 5

LEAKS = "doc_id long, text_key long, item_id long, edit_distance int, item_words int, similarity double, at_word long"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[0x80:] = True
for _a, _b in (("0", "9"), ("a", "z")):
    _WORD_BYTE[ord(_a) : ord(_b) + 1] = True
#: Code points of scripts without blanks, each character of which is a word: kana and Han, Thai and Lao, Burmese, Khmer.
_UNSPACED = ((0x3005, 0x3007), (0x3021, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF), (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF))
#: General punctuation, currency, arrows to dingbats, punctuation of these scripts and full-width forms.
_STOPS = ((0x2000, 0x206F), (0x20A0, 0x20CF), (0x2190, 0x2BFF), (0x2E00, 0x2E7F), (0x3000, 0x3004), (0x3008, 0x3020), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))


def folded_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of UTF-8 text in lower case, and which of them belong to words."""
    raw = _FOLD[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) + 1  # Latin-1 capitals in UTF-8
    capital = lead[(raw[lead] >= 0x80) & (raw[lead] <= 0x9E) & (raw[lead] != 0x97)]
    raw[capital] += 0x20
    inside = _WORD_BYTE[raw]
    # signs of two bytes: no-break space to inverted question mark but for three letters, times, divided by
    lead = np.flatnonzero((raw[:-1] == 0xC2) & ~np.isin(raw[1:], (0xAA, 0xB5, 0xBA)) | (raw[:-1] == 0xC3) & np.isin(raw[1:], (0x97, 0xB7)))
    inside[lead] = inside[lead + 1] = False
    return raw, inside


def _long_characters(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, code point and bytes of the characters of three or four bytes."""
    lead = np.flatnonzero(raw >= 0xE0)
    size = np.where(raw[lead] >= 0xF0, 4, 3)
    lead, size = lead[lead + size <= len(raw)], size[lead + size <= len(raw)]
    code = raw[lead].astype(np.int64) & np.where(size == 4, 0x07, 0x0F)
    for k in (1, 2, 3):
        code = np.where(k < size, code << 6 | raw[np.minimum(lead + k, len(raw) - 1)] & 0x3F, code)
    return lead, code, size


def _among(code: np.ndarray, ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    return reduce(np.logical_or, ((code >= a) & (code <= b) for a, b in ranges))


def normalised_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of letters and digits, case folded; first word per text.

    In scripts without blanks every character is a word.
    """
    raw, inside = folded_words(raw)
    lead, code, size = _long_characters(raw)
    stop = _among(code, _STOPS)
    for k in range(3):
        inside[lead[stop] + k] = False
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    alone = _among(code, _UNSPACED)
    begins = np.concatenate([offsets[:-1], lead[alone], lead[alone] + size[alone]])
    begins = begins[begins < len(raw)]
    first[begins] |= inside[begins]
    last[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(first)
    return hash_spans(raw, starts, np.flatnonzero(last) + 1) | np.uint64(1), np.searchsorted(starts, offsets)


def window_starts(words: np.ndarray) -> np.ndarray:
    """Words that are the least of some MINIMISER consecutive ones."""
    n = len(words) - MINIMISER + 1
    if n < 1:
        return np.arange(min(1, len(words)))
    least = reduce(np.minimum, (words[k : k + n] for k in range(MINIMISER)))
    most = np.zeros(len(words), np.uint64)
    for k in range(MINIMISER):
        np.maximum(most[k : k + n], least, out=most[k : k + n])
    return np.flatnonzero(most == words)


def window_class(words: int) -> int:
    """The longest window that fits into an item of so many words from each of its first MINIMISER - 1 words on."""
    return max(0, int(np.searchsorted(WINDOWS, words - MINIMISER + 1, side="right")) - 1)


class Walks:
    """Random walks and the positions each LSH key samples."""

    def __init__(self, classes: list[int], walks: int, keys: int, samples: int, seed: int):
        self.classes, self.walks, self.keys = classes, walks, keys
        steps = [3 * n // 2 for n in WINDOWS]
        self.steps = {c: steps[c] for c in classes}
        rng = np.random.default_rng(seed)
        odd = lambda *shape: rng.integers(0, 1 << 63, shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        # drawn for every class, so that keys do not depend on which classes occur
        self.turns = odd(walks, steps[-1])
        self.uses: list[dict[int, list[tuple[int, int, np.uint64]]]] = []
        self.salts = odd(walks, len(WINDOWS), keys)
        for _ in range(walks):
            use: dict[int, list] = {}
            for c, n in enumerate(steps):
                for t in range(keys):
                    at = rng.choice(n, samples, replace=False)
                    for position, factor in zip(at, odd(len(at)), strict=True):
                        if c in self.steps:
                            use.setdefault(int(position), []).append((c, t, factor))
            self.uses.append(use)
        self.pad = max(self.steps.values()) + 1

    def run(self, padded: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(class, keys) of the windows at ``starts``, per walk and sample."""
        for w in range(self.walks):
            at = starts.copy()
            sums = {(c, t): np.full(len(starts), self.salts[w, c, t]) for c in self.classes for t in range(self.keys)}
            symbol, product = np.empty(len(starts), np.uint64), np.empty(len(starts), np.uint64)
            for j in range(max(self.steps.values())):
                np.take(padded, at, out=symbol, mode="clip")
                for c, t, factor in self.uses[w].get(j, ()):
                    sums[c, t] += np.multiply(symbol, factor, out=product)
                np.multiply(symbol, self.turns[w, j], out=product)
                at += np.right_shift(product, np.uint64(63), out=product).view(np.int64)
            for (c, _), key in sums.items():
                yield c, key


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words."""
    n = max(0, len(words) - length + 1)
    total = np.full(n, length, np.uint64)
    for k in range(length):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
    return mix(total)


class Pieces(NamedTuple):
    """Sorted hashes of pieces of one length; item and offset of each."""

    keys: np.ndarray
    numbers: np.ndarray
    offsets: np.ndarray


def build_pieces(items: list[tuple[int, np.ndarray]], max_share: float) -> dict[int, Pieces]:
    """{length: pieces} of the items of fewer than MIN_WORDS words."""
    found: dict[int, list[tuple[np.ndarray, int, int]]] = {}
    for number, (_, words) in enumerate(items):
        if len(words) < MIN_WORDS:
            cuts = min(len(words), int(len(words) * max_share) + 1)
            edges = [len(words) * k // cuts for k in range(cuts + 1)]
            for low, high in zip(edges, edges[1:], strict=False):
                found.setdefault(high - low, []).append((run_hashes(words[low:high], high - low)[0], number, low))
    pieces = {}
    for length, rows in found.items():
        keys, numbers, offsets = (np.array(x, t) for x, t in zip(zip(*rows, strict=True), (np.uint64, np.int64, np.int64), strict=True))
        order = np.argsort(keys, kind="stable")
        pieces[length] = Pieces(keys[order], numbers[order], offsets[order])
    return pieces


class Index(NamedTuple):
    """Keys of a block of items; bounded by BLOCK_ITEMS and BLOCK_WORDS."""

    pieces: dict[int, Pieces]
    walks: Walks | None
    items: list[tuple[int, np.ndarray]]
    keys: dict[int, np.ndarray]
    entries: dict[int, tuple[np.ndarray, np.ndarray]]
    marks: dict[int, np.ndarray]
    shift: dict[int, np.uint64]


def build_index(items: list[tuple[int, np.ndarray]], walks: int, keys: int, samples: int, seed: int, max_share: float = 0.2 + 1e-9) -> Index:
    pieces = build_pieces(items, max_share)
    classes = sorted({window_class(len(words)) for _, words in items if len(words) >= MIN_WORDS})
    if not classes:
        return Index(pieces, None, items, {}, {}, {}, {})
    walk = Walks(classes, walks, keys, samples, seed)
    found: dict[int, list] = {c: [] for c in classes}
    for number, (_, words) in enumerate(items):
        if len(words) < MIN_WORDS:
            continue
        own = window_class(len(words))
        starts = window_starts(words)
        starts = starts[starts <= len(words) - WINDOWS[own]]
        padded = np.concatenate([words, np.zeros(walk.pad, np.uint64)])
        for c, key in walk.run(padded, starts):
            if c == own:
                found[c].append((key, np.full(len(starts), number), starts))
    index = Index(pieces, walk, items, {}, {}, {}, {})
    for c in classes:
        key, number, start = (np.concatenate([x[k] for x in found[c]]) for k in range(3))
        order = np.argsort(key, kind="stable")
        bits = min(24, max(16, len(key).bit_length() + 6))
        index.keys[c], index.entries[c], index.shift[c] = key[order], (number[order], start[order]), np.uint64(64 - bits)
        index.marks[c] = np.zeros(1 << bits, bool)
        index.marks[c][key >> index.shift[c]] = True
    return index


def fitting_distance(item: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact least edit distance of ``item`` to any run of words of each region; its end."""
    n, width = regions.shape
    ramp = np.arange(width + 1, dtype=np.int32)
    before = np.zeros((n, width + 1), np.int32)
    for k, word in enumerate(item):
        now = np.empty_like(before)
        now[:, 0] = k + 1
        np.minimum(before[:, 1:] + 1, before[:, :-1] + (regions != word), out=now[:, 1:])
        before = np.minimum.accumulate(now - ramp, axis=1) + ramp
    return before.min(axis=1), before.argmin(axis=1)


def _matches(keys: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``sought``, place in the sorted ``keys``) of equal ones."""
    low = np.searchsorted(keys, sought, side="left")
    count = np.searchsorted(keys, sought, side="right") - low
    entry = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
    return np.repeat(np.arange(len(sought)), count), entry


def search(index: Index, words: np.ndarray, first: np.ndarray, max_share: float) -> dict[tuple[int, int], tuple[int, int]]:
    """{(text, item): (distance, word of the text)} of the leaks in a slice of texts."""
    width = index.walks.pad if index.walks else 1
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    met: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def meet(number: np.ndarray, begin: np.ndarray, inner: np.ndarray) -> None:
        """Item ``number`` may begin at ``begin``, in the text that holds ``inner``."""
        order = np.argsort(number, kind="stable")
        text = np.searchsorted(first, np.clip(inner, 0, max(len(words) - 1, 0)), side="right") - 1
        items, starts = np.unique(number[order], return_index=True)
        for item, some in zip(items.tolist(), np.split(order, starts[1:]), strict=True):
            met.setdefault(item, []).append((begin[some], text[some]))

    if index.walks:
        starts = window_starts(words)
        sizes = np.array([len(x) for _, x in index.items])
        for c, key in index.walks.run(padded, starts):
            hit = np.flatnonzero(index.marks[c][key >> index.shift[c]])
            place, entry = _matches(index.keys[c], key[hit])
            if len(place):
                number, offset = index.entries[c][0][entry], index.entries[c][1][entry]
                begin = starts[hit[place]] - offset
                # a window belongs to the text that holds its middle
                meet(number, begin, begin + sizes[number] // 2)
    for length, pieces in index.pieces.items():
        place, entry = _matches(pieces.keys, run_hashes(words, length))
        if len(place):
            meet(pieces.numbers[entry], place - pieces.offsets[entry], place)
    found: dict[tuple[int, int], tuple[int, int]] = {}
    short = (words >> np.uint64(48)).astype(np.uint16)
    for item, places in met.items():
        symbols = index.items[item][1]
        allowed = int(len(symbols) * max_share)
        slack = allowed + 1
        begin, text = (np.concatenate(x) for x in zip(*places, strict=True))
        lead = 1 << 32  # a slice has fewer words, and begins lie at most an item before it
        once = np.unique(text * (2 * lead) + begin + lead)
        # each word of the item is one of 64 bits; a region without so many of the bits cannot hold it
        held = (symbols >> np.uint64(48)).astype(np.uint16)
        bit = np.zeros(1 << 16, np.uint64)
        bit[held] = np.uint64(1) << (np.arange(len(held)) % 64).astype(np.uint64)
        least = int(np.bitwise_count(np.bitwise_or.reduce(bit[held]))) - allowed
        own = (bit != 0).view(np.uint8)
        for cut in range(0, len(once), 1 << 14):
            text, begin = once[cut : cut + (1 << 14)] // (2 * lead), once[cut : cut + (1 << 14)] % (2 * lead) - lead
            # a region with too few words of the item's 16 bits cannot hold it
            low, high = (np.clip(x, first[text], first[text + 1]) for x in (begin - slack, begin + len(symbols) + slack))
            base = low.min()
            counts = np.zeros(high.max() - base + 1, np.int32)
            np.cumsum(own[short[base : high.max()]], out=counts[1:])
            near = np.flatnonzero(counts[high - base] - counts[low - base] >= len(symbols) - allowed)
            for part in range(0, len(near), 512):
                some = near[part : part + 512]
                span = begin[some][:, None] - slack + np.arange(len(symbols) + 2 * slack)
                inside = (span >= low[some][:, None]) & (span < high[some][:, None])
                span = np.clip(span, 0, len(words) - 1)
                full = np.bitwise_count(np.bitwise_or.reduce(bit[short[span]] * inside, axis=1)) >= least
                some, span, inside = some[full], span[full], inside[full]
                if not len(some):
                    continue
                distance, end = fitting_distance(symbols, np.where(inside, words[span], np.uint64(0)))
                for k in np.flatnonzero(distance <= allowed):
                    i = some[k]
                    at = max(0, int(begin[i] - slack + end[k] - len(symbols) - first[text[i]]))
                    found[int(text[i]), item] = min(found.get((int(text[i]), item), (1 << 30, 0)), (int(distance[k]), at))
    return found


def _tokens(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return normalised_words(raw, np.array([0, len(raw)]))[0] if len(raw) else np.zeros(0, np.uint64)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    """Items in blocks; the driver holds one block."""
    block: list[tuple[int | None, np.ndarray]] = []
    held = 0
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long"), F.lower("text").alias("text")).distinct().orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        words = _tokens(row["text"])
        if not len(words):
            continue
        if block and (len(block) == BLOCK_ITEMS or held + len(words) > BLOCK_WORDS):
            yield block
            block, held = [], 0
        block.append((row["item_id"], words))
        held += len(words)
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_similarity: float = 0.8, walks: int = 4, keys: int = 5, samples: int = 3, seed: int = 5) -> DataFrame:
    """Benchmark items that occur in texts: one row per row of ``docs`` and item.

    An item occurs if some run of words of the text has a word edit distance to
    it of at most 1 - ``min_similarity`` of its words. Words are runs of letters
    and digits without regard to case, and single characters of scripts without
    blanks. Columns: doc_id, text_key (xxhash64 of the
    text), item_id, edit_distance, item_words, similarity, at_word. ``walks`` x
    ``keys`` LSH repetitions give the recall that the tests measure; items of
    fewer than MIN_WORDS words are found without loss.

    Defined cases: null or empty texts and items, and items without a word, match
    nothing; an item_id of several texts matches by any; items without an item_id
    are items of their own, found with a null item_id; null doc_ids are kept; a very
    long text is searched whole; repeated rows give repeated results; other columns
    are ignored; empty tables give an empty result. Texts are scanned once per
    BLOCK_ITEMS items or BLOCK_WORDS words of items.
    """
    parts = []
    source = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.lower("text").alias("text"))
    names = ["doc_id", "text_key", "item_id", "edit_distance", "item_words", "similarity", "at_word"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64()]
    for block in _blocks(benchmark):
        index = build_index(block, walks, keys, samples, seed, 1 - min_similarity + 1e-9)
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                out: list[tuple] = []
                for row, _, raw, offsets in text_slices(batch.column("text")):
                    words, first = normalised_words(raw, offsets)
                    if not len(words):
                        continue
                    best: dict[tuple, tuple] = {}
                    for (text, item), (distance, at) in search(index, words, first, 1 - min_similarity + 1e-9).items():
                        item_id, symbols = index.items[item]
                        hit = (distance, len(symbols), 1 - distance / len(symbols), at)
                        own = (text, item_id, item if item_id is None else None)
                        best[own] = min(best.get(own, hit), hit)
                    for (text, item_id, _), hit in best.items():
                        out.append((batch.column("doc_id")[row + text].as_py(), batch.column("text_key")[row + text].as_py(), item_id, *hit))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        parts.append(source.mapInArrow(run, LEAKS))
    if not parts:
        return docs.sparkSession.createDataFrame([], LEAKS)
    return reduce(DataFrame.unionByName, parts)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, min_item_words: int = MIN_ITEM_WORDS, **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all their columns, whatever their names.

    Items of fewer than ``min_item_words`` words drop nothing, as ordinary texts hold
    them by chance; :func:`find_leaks` reports them.

    Defined cases: those of :func:`find_leaks`; so null and empty texts stay, of
    repeated rows all stay or none, and without a benchmark every row stays.
    """
    found = find_leaks(docs, benchmark, **options).where(F.col("item_words") >= min_item_words)
    leaked = materialise(found.select(F.col("text_key").alias("key")).distinct(), "leaks")
    own, names = coded(docs)
    return decoded(own.withColumn("key", F.xxhash64(names["text"])).join(sized(leaked), "key", "left_anti"), names)
