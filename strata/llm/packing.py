"""Packing token ids into windows, online, by the sum of squares.

A document's ids, with an end id, are cut into whole windows and a remainder. The remainder goes
to the fill level for which the sum over levels of squared counts of partially filled windows
grows least: from level h to h + r that sum changes by 2 (N[h + r] - N[h]) + 2, a new window is
level zero, and a window that becomes full leaves the sum. N is one array.

Each task packs its own partition; nothing is shuffled. Where MOST_OPEN windows are open, and at a
partition's end, the open windows are drained: their pieces, in order, are cut anew into full
windows, and what is left at the end into windows of powers of two. No sequence is padded then.

Defined results: a null text has only the end id; repeated rows are packed each for itself; other
columns are not read. A task holds the ids of its open windows and of one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import map_batches
from strata.llm.tokens import word_ids

WINDOW = 2048
END = 1
MOST_OPEN = 2048
#: Bytes of ids in a batch of the result.
BATCH = 8 << 20

Piece = tuple[int | None, int, np.ndarray, int]


class Shelf:
    """Partially filled windows by fill level. Pieces are (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN) -> None:
        self.window, self.most_open, self.open = window, most_open, 0
        # The ends stand for "a new window" and "full": with these values one formula holds.
        self.counts = np.zeros(window + 1)
        self.counts[0], self.counts[window] = 0.5, -0.5
        self.levels: list[list[list[Piece]]] = [[] for _ in range(window)]

    def level_for(self, size: int) -> int:
        """The fullest of the levels that make the sum of squares smallest."""
        start = self.counts[: self.window - size + 1]
        growth = np.where(start > 0, self.counts[size:] - start, np.inf)
        return len(growth) - 1 - int(growth[::-1].argmin())

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[list[Piece]]:
        """Place a document; yields the windows that are done."""
        total = len(ids)
        whole = total - total % self.window
        for start in range(0, whole, self.window):
            yield [(doc_id, start, ids[start : start + self.window], total)]
        size = total - whole
        if not size:
            return
        level = self.level_for(size)
        pieces: list[Piece] = []
        if level:
            pieces = self.levels[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        # A copy, as the remainder may wait long and must not hold the whole document.
        pieces.append((doc_id, whole, ids[whole:].copy(), total))
        if level + size == self.window:
            yield pieces
        else:
            self.levels[level + size].append(pieces)
            self.counts[level + size] += 1
            self.open += 1
            if self.open > self.most_open:
                yield from self.drain()

    def drain(self) -> Iterator[list[Piece]]:
        """Cut all open windows anew into full ones and powers of two."""
        waiting = [piece for level in reversed(self.levels) for pieces in level for piece in pieces]
        self.levels = [[] for _ in range(self.window)]
        self.counts[1:-1] = 0
        self.open = 0
        left = sum(len(ids) for _, _, ids, _ in waiting)
        room, pieces = 0, []
        for doc_id, start, ids, total in waiting:
            at = 0
            while at < len(ids):
                if not room:
                    room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
                part = ids[at : at + room]
                pieces.append((doc_id, start + at, part, total))
                at, room, left = at + len(part), room - len(part), left - len(part)
                if not room:
                    yield pieces
                    pieces = []


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("ids", T.BinaryType(), False),
        T.StructField("doc_tokens", T.LongType(), False),
        T.StructField("sequence_id", T.LongType(), False),
        T.StructField("offset", T.LongType(), False),
    ]
)
_NAMES = PIECES.fieldNames()
_ARROW = pa.schema(
    [(name, pa.binary() if name == "ids" else pa.int64()) for name in _NAMES]
)


def _numbered(sequences: Iterator[list[Piece]], first: int) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0
    for sequence_id, pieces in enumerate(sequences, first):
        offset = 0
        for doc_id, start, ids, total in pieces:
            packed = ids.astype("<u4").tobytes()
            rows.append((doc_id, start, len(ids), packed, total, sequence_id, offset))
            offset += len(ids)
            held += len(packed)
        if held >= BATCH:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], _NAMES
            )
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], _NAMES
        )


def pack(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents: ids as little-endian unsigned 32-bit numbers, and where they
    lie. vocabulary is the tokenizer's file, at the same place on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shelf = word_ids(vocabulary), Shelf()

        def sequences() -> Iterator[list[Piece]]:
            end = np.array([END], np.uint16)
            for batch in batches:
                ids, texts = batch.columns
                for doc_id, found in zip(ids.to_pylist(), encoder.encoded(texts), strict=True):
                    yield from shelf.add(doc_id, np.append(found, end))
            yield from shelf.drain()

        yield from _numbered(sequences(), TaskContext.get().partitionId() << 32)

    return map_batches(docs.select(F.col(doc_id).cast("long"), text), run, PIECES)
