"""Phrase collocations: frequent phrases by multikey quicksort of suffix pointers, scored by their weakest cut."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import materialise, sized

#: Words of a phrase, the least count of one, and the rows that a language returns.
LONGEST, LEAST, TOP = 4, 30, 2000
#: Score of a phrase of which no part occurs elsewhere; half of it per part.
SCALE = 2_000_000
#: A phrase goes if a longer one around it has at least so many percent of its occurrences.
COVERED = 80
#: Suffixes of a bucket, which one task sorts, and the least number of buckets. A word that fills a bucket is hot.
CAPACITY, BUCKETS = 1 << 22, 64
#: Distinct words that a task counts, and words of texts whose suffixes it holds, before it hands them on.
TASK_KEYS, TASK_WORDS = 300_000, 1 << 20
#: Bits of the table of frequent words, at most: 16 MB.
TABLE_BITS = 1 << 27
#: Bytes of text that are cut into words at a time.
STRETCH = 1 << 20

# A-Z are lower-cased, these end a piece, and blank and tab end a word.
_PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_BYTES = bytearray(range(256))
for _upper in range(ord("A"), ord("Z") + 1):
    _BYTES[_upper] = _upper + 32
for _end in _PIECE_ENDS:
    _BYTES[_end] = 0x0A
_BYTES[0x09] = 0x20
_BYTES = bytes(_BYTES)


# ------------------------------------------------------------- words of a text


def stretches(text: str) -> Iterator[list[bytes]]:
    """Words of consecutive stretches of a text; a line feed stands between pieces, and empty words are to be ignored."""
    raw = text.encode().translate(_BYTES).replace(b"\n", b" \n ")
    begin = 0
    while begin < len(raw):
        end = raw.find(b" ", begin + STRETCH)
        end = len(raw) if end < 0 else end
        yield raw[begin:end].split(b" ")
        begin = end + 1


# ------------------------------------------------------------------- unigrams


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words of all whole texts; ``docs`` has lang and text without nulls.

    Each task hands on a row per distinct word, so that a common word is never a hot key.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, Counter[bytes]] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, words in sums.items():
                for none in (b"", b"\n"):
                    words.pop(none, None)
                keys = pa.array(words.keys(), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), keys, pa.array(words.values(), pa.int64())], ["lang", "word", "n"])
            sums.clear()

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for some in stretches(text):
                    sums.setdefault(lang, Counter()).update(some)
                    held += len(some)
                    if held > TASK_WORDS:
                        held = 0
                        if sum(map(len, sums.values())) > TASK_KEYS:
                            yield from out()
        yield from out()

    return docs.select("lang", "text").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _slot(lang: Column, word: Column) -> Column:
    return F.crc32(F.concat(F.encode(word, "UTF-8"), F.lit(b"\0"), F.encode(lang, "UTF-8")))


class WordTable:
    """Which words are frequent or hot, as two bits per slot of a hash: wrong only by taking a word as more frequent than it is."""

    def __init__(self, frequent: bytes, hot: bytes) -> None:
        self.frequent, self.hot = frequent, hot
        self.mask = len(frequent) * 8 - 1

    @staticmethod
    def of(words: DataFrame, capacity: int) -> WordTable:
        """The table of (lang, word, n): 16 bits a word, up to ``TABLE_BITS``."""
        bits = 1 << 16
        total = words.count()
        while bits < min(16 * total, TABLE_BITS):
            bits *= 2
        slot = _slot(F.col("lang"), F.col("word")).bitwiseAND(F.lit(bits - 1)).cast("long")
        slots = words.select(slot.alias("slot"), (F.col("n") >= capacity).alias("hot")).groupBy("slot").agg(F.max("hot").alias("hot"))
        # blocks of 2^15 slots: at most 2^12 rows of 4 KB and 4 KB come to the driver
        blocks = slots.groupBy(F.shiftright("slot", 15).alias("block")).agg(F.collect_list("slot").alias("some"), F.collect_list(F.when(F.col("hot"), F.col("slot"))).alias("hots"))

        def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def packed(slots: pa.ListArray) -> pa.Array:
                marks = []
                for some in slots:
                    flags = np.zeros(1 << 15, np.uint8)
                    flags[some.values.to_numpy() & 0x7FFF] = 1
                    marks.append(np.packbits(flags, bitorder="little").tobytes())
                return pa.array(marks, pa.binary())

            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), packed(batch.column(1)), packed(batch.column(2))], ["block", "some", "hots"])

        frequent, hot = bytearray(bits // 8), bytearray(bits // 8)
        for row in blocks.mapInArrow(pack, "block long, some binary, hots binary").collect():
            begin = row["block"] << 12
            frequent[begin : begin + len(row["some"])] = row["some"]
            hot[begin : begin + len(row["hots"])] = row["hots"]
        return WordTable(bytes(frequent), bytes(hot))

    def state(self, slot: int) -> int:
        """0 of an infrequent word, 1 of a frequent and 2 of a hot one."""
        at, bit = (slot & self.mask) >> 3, 1 << (slot & 7)
        return 0 if not self.frequent[at] & bit else 2 if self.hot[at] & bit else 1


# ------------------------------------------------------------------- suffixes

_NOTHING, _BREAK = -2, -1
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Suffixes(dict):
    """Suffixes of one language in a task. As a dict it has the code of each word, -1 of one that breaks suffixes."""

    def __init__(self, table: WordTable, lang: str) -> None:
        super().__init__({b"": _NOTHING, b"\n": _BREAK})
        self.table, self.tail = table, b"\0" + lang.encode()
        self.words: list[bytes] = []
        self.hashes: list[int] = []
        self.hot: list[bool] = []
        self.buffer: list[np.ndarray] = []
        self.held = 0

    def __missing__(self, word: bytes) -> int:
        slot = zlib.crc32(self.tail, zlib.crc32(word))
        state = self.table.state(slot)
        code = len(self.words) if state else _BREAK
        if state:
            self.words.append(word)
            self.hashes.append(slot)
            self.hot.append(state == 2)
        self[word] = code
        return code

    def add(self, words: list[bytes]) -> None:
        codes = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        self.buffer.append(codes[codes != _NOTHING])
        self.held += len(self.buffer[-1])

    def end(self) -> None:
        """The end of a text."""
        self.buffer.append(np.full(1, _BREAK, np.int32))

    def forget(self) -> None:
        """Give the codes up: only between texts, when nothing is held."""
        table, lang = self.table, self.tail[1:].decode()
        self.clear()
        self.__init__(table, lang)

    def take(self, buckets: int, ends: bool) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
        """(bucket, lead, words, codes, counts) of the distinct suffixes of what is held; unless it ``ends``, the last words stay."""
        codes = np.concatenate([*self.buffer, np.full((LONGEST - 1) * ends, _BREAK, np.int32)])
        self.buffer, self.held = [codes[-(LONGEST - 1) :]] * (not ends), 0
        if len(codes) < LONGEST:
            return
        hot = np.append(np.array(self.hot, bool), False)
        rows = np.stack([codes[k : len(codes) - LONGEST + 1 + k] for k in range(LONGEST)], axis=1)
        rows = rows[(rows[:, 0] >= 0) & (rows[:, 1] >= 0)]
        for k in range(2, LONGEST):
            rows[rows[:, k - 1] < 0, k] = _BREAK
        # words up to the first that is not hot; of a suffix of hot words only, each beginning is a row of its own
        warm = ~hot[rows]
        lead = np.maximum(warm.argmax(axis=1) + 1, 2)
        only = rows[np.arange(len(rows)), lead - 1] < 0
        only |= ~warm.any(axis=1)
        starts = [np.where(np.arange(LONGEST) < size, rows, _BREAK)[(hot[rows[:, :size]] & (rows[:, :size] >= 0)).all(axis=1)] for size in range(2, LONGEST + 1)]
        lead = np.concatenate([lead[~only], np.zeros(sum(map(len, starts)), lead.dtype)])
        rows = np.concatenate([rows[~only], *starts])
        if not len(rows):
            return
        pair = lambda a, b: ((a.astype(np.int64) + 1) << 32) | (b.astype(np.int64) + 1)
        keys = (pair(rows[:, 2], rows[:, 3]), pair(rows[:, 0], rows[:, 1]))
        order = np.lexsort(keys)
        new = np.flatnonzero(np.append(True, (np.diff(keys[0][order]) != 0) | (np.diff(keys[1][order]) != 0)))
        counts = np.diff(np.append(new, len(order)))
        rows, lead = rows[order[new]], lead[order[new]]
        hashes = np.append(np.array(self.hashes, np.uint64), np.uint64(0))
        route = np.zeros(len(rows), np.uint64)
        for k in range(LONGEST):
            route = np.where((k < lead) | (lead == 0), (route ^ hashes[rows[:, k]]) * _MIX, route)
            route ^= route >> np.uint64(29)
        bucket = (route % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((lead, bucket))
        rows, lead, bucket, counts = rows[order], lead[order], bucket[order], counts[order]
        edges = np.flatnonzero(np.append(True, (np.diff(bucket) != 0) | (np.diff(lead) != 0)))
        for begin, stop in zip(edges, [*edges[1:], len(rows)], strict=True):
            kinds, own = np.unique(rows[begin:stop], return_inverse=True)
            own = own.reshape(-1, LONGEST) - int(kinds[0] < 0)  # 0 to the number of words, -1 behind the end
            words = b"\n".join([self.words[k] for k in kinds[kinds >= 0]])
            narrow = np.int16 if len(kinds) <= 1 << 15 else np.int32
            yield int(bucket[begin]), int(lead[begin]), *(zlib.compress(x, 1) for x in (words, own.T.astype(narrow).tobytes(), counts[begin:stop].astype(np.int64).tobytes()))


def _route(docs: DataFrame, table: Broadcast, buckets: int) -> DataFrame:
    """(bucket, lang, lead, words, codes, counts) rows: packed suffixes, and where ``lead`` is 0 phrases of hot words only.

    A suffix is the up to four words from a place of a piece up to its first infrequent
    word. Its bucket is a hash of its ``lead`` leading words: two, or more up to the first
    that is not hot, so that no group fills more than a bucket.
    The phrases of ``lead`` words and more are counted there. The shorter ones have hot
    words only and would lie in several buckets; each task counts them, and their bucket
    is a hash of the whole phrase.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes: dict[str, Suffixes] = {}

        def out(lang: str, ends: bool) -> Iterator[pa.RecordBatch]:
            rows = list(suffixes[lang].take(buckets, ends))
            for begin in range(0, len(rows), 2000):
                bucket, lead, words, codes, counts = zip(*rows[begin : begin + 2000], strict=True)
                columns = [pa.array(bucket, pa.int64()), pa.array([lang] * len(bucket), pa.string()), pa.array(lead, pa.int32()), *(pa.array(c, pa.binary()) for c in (words, codes, counts))]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "lang", "lead", "words", "codes", "counts"])

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if lang not in suffixes:
                    suffixes[lang] = Suffixes(table.value, lang)
                mine = suffixes[lang]
                for words in stretches(text):
                    mine.add(words)
                    if mine.held >= TASK_WORDS:
                        yield from out(lang, False)
                mine.end()
                if len(mine) > TASK_KEYS:
                    yield from out(lang, True)
                    mine.forget()
                if len(suffixes) > 4 and sum(x.held for x in suffixes.values()) > 4 * TASK_WORDS:
                    for name in list(suffixes):
                        yield from out(name, True)
                    suffixes.clear()
        for lang in suffixes:
            yield from out(lang, True)

    return docs.select("lang", "text").mapInArrow(run, "bucket long, lang string, lead int, words binary, codes binary, counts binary")


def frequent_prefixes(keys: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(row, depth, weight) of every prefix of the rows of ``keys`` that weighs ``least`` or more.

    Multikey three-way quicksort of pointers to the rows: at each depth a partition is
    split by a pivot into smaller, equal and larger keys, the equal ones go on a key
    deeper, and their weight is the count of the prefix. What weighs less than ``least``
    is abandoned. A row ends at its first key -1 or at the last column.
    """
    todo = [(np.arange(len(keys)), 0)]
    while todo:
        rows, depth = todo.pop()
        column = keys[rows, depth]
        pivot = sorted((column[0], column[len(column) // 2], column[-1]))[1]
        for sign, part in ((-1, column < pivot), (1, column > pivot), (0, column == pivot)):
            some = rows[part]
            if not len(some) or (weight := int(weights[some].sum())) < least:
                continue
            if sign:
                todo.append((some, depth))
            elif pivot >= 0:
                yield int(some[0]), depth + 1, weight
                if depth + 1 < keys.shape[1]:
                    todo.append((some, depth + 1))


def _pointers(blobs: list[tuple[bytes, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Keys of the words of packed suffixes (a row each, -1 behind its end), their weights, and the words by key."""
    known: dict[bytes, int] = {}
    keys, weights = [], []
    for words, codes, numbers in blobs:
        own = np.array([*(known.setdefault(w, len(known)) for w in zlib.decompress(words).split(b"\n")), -1], np.int32)
        codes, counts = zlib.decompress(codes), np.frombuffer(zlib.decompress(numbers), np.int64)
        weights.append(counts)
        keys.append(own[np.frombuffer(codes, np.int16 if len(codes) == 2 * LONGEST * len(counts) else np.int32).reshape(LONGEST, -1).T])
    return np.concatenate(keys), np.concatenate(weights), list(known)


def _whole_rows(keys: np.ndarray, weights: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(row, depth, weight) of the distinct rows that weigh ``least`` or more."""
    order = np.lexsort(keys.T)
    new = np.flatnonzero(np.append(True, (np.diff(keys[order], axis=0) != 0).any(axis=1)))
    for row, weight in zip(order[new], np.add.reduceat(weights[order], new), strict=True):
        if weight >= least:
            yield int(row), int((keys[row] >= 0).sum()), int(weight)


def _count_phrases(routed: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, a) of the phrases of ``least`` occurrences or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, lead, blobs in _groups(batches):
            keys, weights, words = _pointers(blobs)
            counted = frequent_prefixes(keys, weights, least) if lead else _whole_rows(keys, weights, least)
            found = [(b" ".join([words[k] for k in keys[row, :depth]]), depth, n) for row, depth, n in counted if depth >= lead]
            columns = [[lang] * len(found), *zip(*found, strict=True)] if found else [[]] * 4
            kinds = (pa.string(), pa.binary(), pa.int32(), pa.int64())
            made = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([made[0], made[1].cast(pa.string()), *made[2:]], ["lang", "phrase", "words", "a"])

    dealt = routed.repartition("bucket").sortWithinPartitions("bucket", "lang", "lead")
    return dealt.mapInArrow(run, "lang string, phrase string, words int, a long")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, list[tuple[bytes, bytes, bytes]]]]:
    current, blobs = None, []
    for batch in batches:
        for bucket, lang, lead, *blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current != (bucket, lang, lead):
                if blobs:
                    yield *current[1:], blobs
                current, blobs = (bucket, lang, lead), []
            blobs.append(tuple(blob))
    if blobs:
        yield *current[1:], blobs


def frequent_phrases(docs: DataFrame, counts: DataFrame, least: int = LEAST, capacity: int = CAPACITY) -> DataFrame:
    """(lang, phrase, words, a) of the phrases of 2 to 4 words that occur ``least`` times or more.

    ``docs`` has lang and text without nulls, ``counts`` all their words of that many occurrences.
    """
    spark = docs.sparkSession
    total = counts.agg(F.sum("n")).first()[0] or 0
    size = min(capacity, max(1, total // BUCKETS))
    table = spark.sparkContext.broadcast(WordTable.of(counts, size))  # 32 MB at most
    return _count_phrases(_route(docs, table, max(1, -(-total // size))), least)


# --------------------------------------------------------------------- scores


def _part(words: Column, begin: int | Column, count: int | Column) -> Column:
    return F.array_join(F.slice(words, begin, count), " ")


def _scored(candidates: DataFrame, phrases: DataFrame, counts: DataFrame, scale: int) -> DataFrame:
    """Candidates with l, r and score of their weakest cut; parts are frequent words or phrases."""
    parts = counts.select("lang", F.col("word").alias("part"), "n").unionByName(phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("n")))
    words = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(words, F.lit(1), F.col("k")).alias("first"), _part(words, F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    few = parts.count() <= 100_000
    for name, count in (("first", "l"), ("rest", "r")):
        of = parts.select("lang", F.col("part").alias(name), F.col("n").alias(count))
        cuts = cuts.join(F.broadcast(of) if few else of, ["lang", name])
    # decimals: the product may pass 64 bits
    score = F.expr(f"cast({scale} as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _around(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, around): of each phrase inside a longer one the count of the most frequent such."""
    words = F.split("phrase", " ")
    longer = phrases.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    longer = longer.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inside = longer.select("lang", _part(words, F.col("begin"), F.col("size")).alias("phrase"), F.col("a").alias("around"))
    return inside.groupBy("lang", "phrase").agg(F.max("around").alias("around"))


def _first(rows: DataFrame, count: int, salts: int = 64) -> DataFrame:
    """The ``count`` best phrases of each language with their rank: first of each of ``salts`` parts, then of those."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col("rank") <= count)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    return ranked(ranked(salted, "lang", "salt").drop("rank", "salt"), "lang")


def collocations(docs: DataFrame, covered: int = COVERED, least: int = LEAST, top: int = TOP, scale: int = SCALE, capacity: int = CAPACITY) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by their weakest cut.

    Words and pieces are those of whole texts. A phrase of 2 to 4 words with ``least``
    occurrences or more is a candidate; cut in two, it scores ``scale * a / (l + r)``,
    rounded down, and its lowest cut counts (ties: the earliest). It goes if a longer
    candidate around it has ``covered`` percent of its occurrences. Ranks are by
    score, then a, then the phrase in UTF-8 order, so ties are settled.

    A null text is empty, a null language is ``und``; of ``docs`` only lang and text are
    used, whatever other columns it has. Repeated rows count each time; texts without
    frequent phrases and an empty table give no rows.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counts = materialise(word_counts(docs), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = counts.where(F.col("n") >= least)
    phrases = materialise(frequent_phrases(docs, frequent, least, capacity), "phrases")
    covered = F.coalesce(F.col("around") * 100 >= F.col("a") * covered, F.lit(False))
    kept = phrases.join(_around(phrases), ["lang", "phrase"], "left").where(~covered).select(*phrases.columns)
    best = _first(_scored(kept, phrases, frequent, scale), top)
    return best.join(sized(totals, 100_000), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
