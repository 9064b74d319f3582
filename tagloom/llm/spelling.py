"""Spelling variants: words one edit apart, by composing acceptors with a one-edit transducer."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import materialise, sized

#: Letters of a word (a fixed value): a run of these.
LETTERS = r"[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: One in so many words of a text has a letter taken out.
SLIP = 199
#: Code points that name an initial state, and the most words that start in one partition.
STATE, PARTITION_WORDS = 3, 8192
#: Distinct words that a task counts before it hands the counts on.
TASK_WORDS = 200_000
#: Texts longer than this are matched one word at a time.
LONG_TEXT = 1 << 22

_RUN = re.compile(LETTERS)
_LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}


# --------------------------------------------------------------------- counting


def slipped(run: str, doc: str, slip: int = SLIP) -> str:
    """A run as it is counted: A-Z lower-cased, and some by hash without one code point."""
    word = run.lower() if run.isascii() else run.translate(_LOWER)
    h = zlib.crc32(f"{doc}:{word}".encode())
    if h % slip:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n) of the distinct words of all whole texts, of at least ``min_length`` code points and ``min_count`` occurrences.

    Each task counts its texts and hands on a row per distinct word, so that a common
    word is never a hot key. A null or empty text has no words; a null doc_id counts
    as an empty one in the hash.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.string()), pa.array(sums.values(), pa.int64())], ["word", "n"])
            sums.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                text, doc = text.as_py() or "", doc.as_py() or ""
                runs = Counter(_RUN.findall(text)) if len(text) <= LONG_TEXT else Counter(m.group() for m in _RUN.finditer(text))
                for spelled, n in runs.items():
                    if len(spelled) >= min_length and len(word := slipped(spelled, doc, slip)) >= min_length:
                        sums[word] += n
                if len(sums) >= TASK_WORDS:
                    yield out()
        yield out()

    counted = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# -------------------------------------------------------------------- automata


class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words: equal right languages share one state."""

    def __init__(self, words: Iterable[str]) -> None:
        self.edges: list[dict[str, int]] = [{}]
        self.final = [False]
        register: dict[tuple, int] = {}
        path: list[tuple[int, str]] = []  # of the last word: the state it left, by which letter
        last = ""
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            self._freeze(path, same, register)
            at = self.edges[path[-1][0]][path[-1][1]] if path else 0
            for letter in word[same:]:
                self.edges.append({})
                self.final.append(False)
                self.edges[at][letter] = len(self.edges) - 1
                path.append((at, letter))
                at = len(self.edges) - 1
            self.final[at] = True
            last = word
        self._freeze(path, 0, register)

    def _freeze(self, path: list[tuple[int, str]], keep: int, register: dict[tuple, int]) -> None:
        """Replace the states behind ``keep`` letters of the path by equal registered ones."""
        while len(path) > keep:
            at, letter = path.pop()
            state = self.edges[at][letter]
            known = register.setdefault((self.final[state], tuple(self.edges[state].items())), state)
            if known != state:
                self.edges[at][letter] = known
                self.edges[state] = {}


def _spelled(letters: tuple | None) -> str:
    """Letters of a chain (earlier, letter)."""
    out = []
    while letters is not None:
        letters, letter = letters
        out.append(letter)
    return "".join(reversed(out))


def near_pairs(words: list[str], last: int | None = None, replaced: bool = True, inserted: bool = True) -> Iterator[tuple[str, str]]:
    """Unordered pairs of the sorted ``words`` that are one edit apart, each once.

    The paths of (acceptor) o (one-edit transducer) o (acceptor): before the edit both
    sides are in one state; there they part, by two letters (replaced) or by a letter that
    only one side reads (inserted); after it they read the same letters up to final states.
    Words part at their first difference, so a pair has one path. ``last`` bounds the
    place of the edit: less than ``last`` letters stand before it.
    """
    machine = Acceptor(words)
    edges, final = machine.edges, machine.final

    def common(p: int, r: int, without: str | None) -> Iterator[str]:
        """Words that both states accept and that don't begin with ``without``."""
        if final[p] and final[r]:
            yield ""
        todo = [(to, edges[r][c], (None, c)) for c, to in edges[p].items() if c != without and c in edges[r]]
        while todo:
            p, r, chain = todo.pop()
            if final[p] and final[r]:
                yield _spelled(chain)
            few, many = (edges[p], edges[r]) if len(edges[p]) <= len(edges[r]) else (edges[r], edges[p])
            todo += [(to, many[c], (chain, c)) for c, to in few.items() if c in many]

    todo: list[tuple[int, int, tuple | None]] = [(0, 0, None)]
    while todo:
        state, depth, chain = todo.pop()
        if last is not None and depth >= last:
            continue
        head, ways = None, list(edges[state].items())
        for k, (letter, to) in enumerate(ways):
            if inserted:
                for rest in common(to, state, letter):
                    head = _spelled(chain) if head is None else head
                    yield head + rest, head + letter + rest
            for other, beside in ways[:k] if replaced else ():
                for rest in common(to, beside, None):
                    head = _spelled(chain) if head is None else head
                    yield head + letter + rest, head + other + rest
            todo.append((to, depth + 1, (chain, letter)))


# ------------------------------------------------------------------ partitions


def _partition(key: Column, kind: str, skip: Column, cut: Column) -> Column:
    return F.struct(key.alias("state"), F.lit(kind).alias("kind"), skip.cast("int").alias("skip"), cut.cast("int").alias("cut"))


def _initial_states(words: DataFrame, limit: int) -> DataFrame:
    """(word, n, state, kind, skip, cut): words by the initial states of the composition.

    Words of six letters that are one edit apart share their first three or their last
    three: "head" partitions hold the pairs that part after the third letter, "tail"
    partitions those that part before. A partition of more than ``limit`` words is dealt
    by the place of the edit instead, and by all letters before and behind it, so that
    it holds as many words as there are letters, for 3 rows a letter of its words.
    """
    length, word = F.length("word"), F.col("word")
    both = F.array(
        _partition(F.concat(F.lit("<"), F.substring(word, 1, STATE)), "head", F.lit(STATE), F.lit(0)),
        _partition(F.concat(F.lit(">"), F.right(word, F.lit(STATE))), "tail", F.lit(0), F.lit(STATE)),
    )
    rows = words.select("word", "n", F.explode(both).alias("p")).select("word", "n", "p.*")
    hot = materialise(rows.groupBy("state").agg(F.count("*").alias("size")).where(F.col("size") > limit).select("state"), "hot-states")
    if hot.isEmpty():
        return rows
    hot = sized(hot)
    few = rows.join(hot, "state", "left_anti")
    many = rows.join(hot, "state", "left_semi")
    places = F.when(F.col("kind") == "head", F.sequence(F.lit(STATE), length)).otherwise(F.sequence(F.lit(0), F.lit(STATE - 1)))
    at = F.col("at")
    key = lambda kind, before, behind: F.concat_ws(":", F.lit(kind), at, F.sha2(before, 256), F.sha2(behind, 256))
    before, behind, onward = F.substring(word, F.lit(1), at), F.expr("substring(word, at + 2)"), F.expr("substring(word, at + 1)")
    # behind its end a word has nothing to replace or leave out; of equal letters only the last is left out, so that a pair has one place
    shorter = _partition(key("inserted", before, onward), "inserted", at, length - at)
    replaced = F.when(at < length, _partition(key("replaced", before, behind), "replaced", at, length - at - 1))
    single = F.substring(word, at + 1, F.lit(1)) != F.substring(word, at + 2, F.lit(1))
    longer = F.when((at < length) & single, _partition(key("inserted", before, behind), "inserted", at, length - at - 1))
    spread = many.select("word", "n", F.explode(places).alias("at"))
    spread = spread.select("word", "n", F.explode(F.array_compact(F.array(shorter, replaced, longer))).alias("p"))
    return few.unionByName(spread.select("word", "n", "p.*"))


def near_words(words: DataFrame, limit: int = PARTITION_WORDS) -> DataFrame:
    """(word, near, near_n): each word of (word, n) with every word exactly one edit from it.

    Words must have at least six code points and be distinct. Each pair is in both orders.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones, others, counts = [], [], []

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(ones, pa.string()), pa.array(others, pa.string()), pa.array(counts, pa.int64())], ["word", "near", "near_n"])
            for column in (ones, others, counts):
                column.clear()
            return made

        for kind, known in _groups(batches):
            if len(known) < 2:
                continue
            found = near_pairs(sorted(known), {"head": None, "tail": STATE}.get(kind, 1), kind != "inserted", kind != "replaced")
            for a, b in found:
                (one, n), (other, m) = known[a], known[b]
                ones += (one, other)
                others += (other, one)
                counts += (m, n)
            if len(ones) >= 50_000:
                yield out()
        yield out()

    states = _initial_states(words, limit).repartition("state").sortWithinPartitions("state")
    return states.select("state", "kind", "skip", "cut", "word", "n").mapInArrow(run, "word string, near string, near_n long")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, dict[str, tuple[str, int]]]]:
    """Of each partition of the composition its kind, and its words by the letters that they don't all share."""
    current, kind, known = None, "", {}
    for batch in batches:
        for state, of, skip, cut, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state != current:
                if known:
                    yield kind, known
                current, kind, known = state, of, {}
            known[word[skip : len(word) - cut]] = (word, n)
    if known:
        yield kind, known


# -------------------------------------------------------------------- operator


def _with_roots(links: DataFrame, top: int, ratio: int) -> DataFrame:
    """(word, root) of ``links(word, form)``: forms followed to the last, in steps that double.

    A form occurs ``ratio`` times as often as its word, so chains have at most
    log(top) / log(ratio) links.
    """
    roots = materialise(links.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max(0, math.ceil(math.log2(max(1.0, math.log(max(top, 1), ratio)))))):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        roots = materialise(roots.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots")
    return roots


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, slip: int = SLIP, limit: int = PARTITION_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts of ``docs``.

    ``form`` is the word one edit away that occurs most often (ties: the smallest in
    code-point order), if at least ``ratio`` times as often, else null; ``root`` follows
    forms to the last, and is the word itself if it has none. Of ``docs`` only doc_id and
    text are used, whatever other columns it has. Null and empty texts have no words,
    repeated rows count each time, and an empty table gives no rows. The search for near
    words needs a ``min_length`` of six at least, and chains of forms end because
    ``ratio`` is above one.
    """
    if min_length < 2 * STATE or ratio <= 1:
        raise ValueError(f"words must have at least {2 * STATE} letters, and a form must occur more often than its word")
    words = materialise(count_words(docs, min_length, min_count, slip), "words")
    near = near_words(words, limit).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("first"))
    listed = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("first.near").alias("near"), (-F.col("first.less")).alias("near_n"))
    chosen = F.col("near_n") >= F.col("n") * ratio
    listed = materialise(listed.select("word", "n", "n_near", F.when(chosen, F.col("near")).alias("form"), F.when(chosen, F.col("near_n")).alias("form_n")), "variants")
    linked = listed.where("form IS NOT NULL")
    roots = _with_roots(linked, linked.agg(F.max("form_n")).first()[0] or 1, ratio)
    return listed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
