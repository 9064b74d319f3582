"""Token counts of texts as a piece model gives them, by merging pairs from a heap."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from pathlib import Path

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A document of more tokens is marked.
TOKEN_LIMIT = 4096
#: Mark of a blank in the pieces of a model.
BLANK = "▁"
#: Counts of chunks that a worker keeps at a time, and the longest chunk that it keeps.
KEPT_CHUNKS, KEPT_LENGTH = 500_000, 48
#: Characters of a text that are cut into chunks at a time.
STRETCH = 1 << 20


class PieceMerges(dict):
    """Token counts of chunks under a model of ranked pieces: ``merges[chunk]``.

    A chunk starts as its characters; the adjacent pair of lowest rank (best score,
    ties to the left) is merged until no pair is a piece. A character that is no
    piece counts as its UTF-8 bytes. As a dict it keeps the counts of short chunks,
    ``KEPT_CHUNKS`` at most.
    """

    def __init__(self, model: bytes) -> None:
        super().__init__()
        self.processor = p = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(p.get_piece_size())
        if any(p.is_unused(i) for i in ids) or not any(p.is_byte(i) for i in ids):
            raise ValueError("the model must fall back on bytes and use all its pieces")
        normal = [i for i in ids if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
        order = sorted(normal, key=lambda i: (-p.get_score(i), i))
        self.ranks = {p.id_to_piece(i): rank for rank, i in enumerate(order)}
        #: Neighbours in some piece; no merge ever joins two other characters.
        self.joined = {piece[k : k + 2] for piece in self.ranks for k in range(len(piece) - 1)}
        self._chunk = self._chunks_by_blank()

    def _chunks_by_blank(self) -> re.Pattern | None:
        """Chunks begin at runs of blanks, and stray control characters stand alone, if no piece goes across."""
        if any(pair[0] != BLANK and pair[1] == BLANK for pair in self.joined):
            return None
        alone = "".join(c for c in map(chr, range(0x20)) if not any(c in pair for pair in self.joined))
        single = f"[{re.escape(alone)}]|" if alone else ""
        return re.compile(f"{single}{BLANK}*[^{BLANK}{re.escape(alone)}]+|{BLANK}+")

    def __missing__(self, chunk: str) -> int:
        count = sum(map(self.merged, self._cut(chunk))) if len(chunk) > KEPT_LENGTH else self.merged(chunk)
        if len(chunk) <= KEPT_LENGTH:
            if len(self) >= KEPT_CHUNKS:
                self.clear()
            self[chunk] = count
        return count

    def _cut(self, chunk: str) -> Iterator[str]:
        """A long chunk cut where its neighbours are in no piece."""
        begin = 0
        for k in range(1, len(chunk)):
            if chunk[k - 1 : k + 1] not in self.joined:
                yield chunk[begin:k]
                begin = k
        yield chunk[begin:]

    def merged(self, chunk: str) -> int:
        """Initial symbols of a chunk minus its merges."""
        ranks, size = self.ranks, len(chunk)
        symbols = list(chunk)
        total = sum(1 if c in ranks else len(c.encode()) for c in symbols)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        heap = [(rank, k, 2) for k in range(size - 1) if (rank := ranks.get(chunk[k : k + 2])) is not None]
        heapify(heap)
        while heap:
            _, k, length = heappop(heap)
            right = after[k]
            if not symbols[k] or right >= size or len(symbols[k]) + len(symbols[right]) != length:
                continue  # one of the two has been merged since
            symbols[k] += symbols[right]
            symbols[right] = ""
            after[k] = onward = after[right]
            total -= 1
            if onward < size:
                before[onward] = k
                if (rank := ranks.get(symbols[k] + symbols[onward])) is not None:
                    heappush(heap, (rank, k, length + len(symbols[onward])))
            if (back := before[k]) >= 0 and (rank := ranks.get(symbols[back] + symbols[k])) is not None:
                heappush(heap, (rank, back, len(symbols[back]) + length))
        return total

    def count(self, text: str) -> int:
        """Tokens of a whole text, without added special tokens."""
        text = self.processor.normalize(text)
        if self._chunk is None:
            return self[text] if text else 0
        total, begin = 0, 0
        while begin < len(text):
            edge = _CHUNK_EDGE.search(text, begin + STRETCH) if len(text) > begin + STRETCH else None
            end = edge.start() if edge else len(text)
            total += sum(map(self.__getitem__, self._chunk.findall(text, begin, end)))
            begin = end
        return total


#: Where a run of blanks begins.
_CHUNK_EDGE = re.compile(f"(?<!{BLANK}){BLANK}")


@lru_cache(maxsize=2)
def _merges(model: bytes) -> PieceMerges:
    return PieceMerges(model)


def with_token_counts(docs: DataFrame, model_file: str, limit: int = TOKEN_LIMIT, text: str = "text") -> DataFrame:
    """``docs`` plus n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each whole text.

    The model is a byte-fallback BPE model of the sentencepiece library without
    user-defined pieces. The driver reads it, so executors need no such file. Pairs
    are merged here, without making identifiers; the library only normalises.

    A null or empty text has no bytes and no tokens. Strings of special tokens in a text
    are ordinary text. A text of any length is counted whole, and repeated rows each
    have their counts; an empty table gives none. Columns of ``docs`` that have one of
    the three names are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(Path(model_file).read_bytes())  # some 0.5 MB: as large as the file, whatever the table

    @F.arrow_udf("long")
    def tokens(texts: pa.Array) -> pa.Array:
        merges = _merges(model.value)
        return pa.array([merges.count(t) if (t := x.as_py()) else 0 for x in texts], pa.int64())

    counted = docs.withColumns({"n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), "n_tokens": tokens(F.col(text))})
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
