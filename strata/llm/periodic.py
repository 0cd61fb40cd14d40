"""Periodic runs of words, caught online.

A text's words are appended piece by piece, and what is known of it grows with them:

1. For each level k, the text appended so far is cut into blocks of 2^k words. Each completed
   block gets a catcher, which waits for the block to come again between 2^(k+1) - 1 and
   2^(k+2) - 2 words later. Every stretch of at least that period holds a whole block, so each
   repetition is caught at exactly one level.
2. An appended word completes one suffix of 2^k words for each level, and two catchers there wait
   for it: two comparisons a word and level. Windows are compared by hashes that are built from
   those of the level below.
3. A hit is a piece of a square. Where the block before it did not hit at the same distance, it
   opens a run; the run is drawn out to the left at once, and to the right with every further
   piece, until two words that a period separates differ. So squares of one period merge into
   one run, however long.
4. Closed runs are compared word by word before they are reported. Of runs over the same stretch
   the one of the smallest period stays; the other periods are its multiples.

Work is proportional to words times levels, also in a text of one repeated word. A text is held
as numbers, 8 bytes a word and level.

Defined results: a null text has no words, no runs and an empty collapsed text. Words are what
ASCII blanks separate; case counts. Repeated rows are judged each for itself, and an empty table
gives an empty one. Other columns pass through; one named as a result is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import words

#: A run has this many words, and this many of its periods, at least.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Words that are appended at once.
PIECE = 1 << 14


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class _Grown:
    """An array that is added to at its end."""

    def __init__(self, kind: type) -> None:
        self._room, self.size = np.empty(64, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self._room):
            self._room = np.concatenate(
                [self._room[: self.size], np.empty(max(need, self.size * 2) - self.size, self._room.dtype)]
            )
        self._room[self.size : need] = values
        self.size = need

    @property
    def values(self) -> np.ndarray:
        return self._room[: self.size]


class Catchers:
    """All catchers of one text, and the runs that they have opened."""

    def __init__(self, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> None:
        if least_periods < 2:
            raise ValueError("A run has two periods at least.")
        self.least_words, self.least_periods = least_words, least_periods
        self._words = _Grown(np.int64)
        #: Hashes of the windows of 2^k words, by their start, for each level.
        self._windows: list[_Grown] = []
        #: Suffixes that a level's catchers have compared.
        self._compared: list[int] = []
        #: Runs that reach the end of the text so far: first word, end of the words known to come
        #: again a period later, period.
        self._open = np.empty((3, 0), np.int64)
        self._closed: list[np.ndarray] = []

    def append(self, piece: np.ndarray) -> None:
        """Add words, as numbers that are equal where the words are."""
        self._words.add(piece)
        size = self._words.size
        while self.least_periods * (2 ** (len(self._windows) + 1) - 1) <= size:
            self._windows.append(_Grown(np.uint64))
            self._compared.append(0)
        self._hash()
        opened = [self._open, *(self._hits(k) for k in range(len(self._windows)))]
        found = np.concatenate(opened, axis=1)
        found[1] = self._drawn_out(found[1], found[2])
        at_end = found[1] + found[2] == size
        self._open = found[:, at_end]
        self._close(found[:, ~at_end])

    def runs(self) -> list[Run]:
        """All runs of the words appended, by start, then period."""
        self._close(self._open)
        self._open = np.empty((3, 0), np.int64)
        if not self._closed:
            return []
        start, stop, period = np.concatenate(self._closed, axis=1)
        end = stop + period
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))
        found = []
        for a, b, p in zip(start[first].tolist(), end[first].tolist(), period[first].tolist()):
            exact = self._exact(a, b, p)
            if exact and self._long(exact.length, p):
                found.append(exact)
        return sorted(set(found), key=lambda run: (run.start, run.period))

    def _hash(self) -> None:
        """Windows of every level that the words now complete."""
        below = self._words.values
        for k, windows in enumerate(self._windows):
            here = windows.size
            if k == 0:
                windows.add(_mixed(below[here:].astype(np.uint64) + np.uint64(1)))
            else:
                half = 2 ** (k - 1)
                one, other = below[here : max(here, len(below) - half)], below[here + half :]
                windows.add(_mixed(one * np.uint64(3) + (other ^ (other >> np.uint64(31)))))
            below = windows.values

    def _hits(self, k: int) -> np.ndarray:
        """Runs that the level's catchers open with the suffixes not compared so far."""
        windows, block = self._windows[k].values, 2**k
        suffix = np.arange(max(self._compared[k], 2 * block - 1), len(windows))
        self._compared[k] = len(windows)
        latest = (suffix - (2 * block - 1)) // block * block
        opened = []
        for caught in (latest, latest - block):
            hit = np.flatnonzero((windows[suffix] == windows[caught]) & (caught >= 0))
            at, again = caught[hit], suffix[hit]
            # Whether the block before hit, too: then the run is open already.
            follows = (at >= block) & (windows[at - block] == windows[again - block])
            at, again = at[~follows], again[~follows]
            if self.least_periods > 2:
                # Such a run holds two blocks at least: one that comes alone opens none.
                next_at = np.minimum(again + block, len(windows) - 1)
                ahead = windows[np.minimum(at + block, len(windows) - 1)] == windows[next_at]
                ahead |= again + block >= len(windows)
                at, again = at[ahead], again[ahead]
            if len(at):
                start, period = at.copy(), again - at
                for level in range(k - 1, -1, -1):
                    lower, step = self._windows[level].values, 2**level
                    back = np.maximum(start - step, 0)
                    same = (start >= step) & (lower[back] == lower[back + period])
                    start[same] -= step
                opened.append(np.stack([start, at + block, period]))
        return np.concatenate([np.empty((3, 0), np.int64), *opened], axis=1)

    def _drawn_out(self, stop: np.ndarray, period: np.ndarray) -> np.ndarray:
        """The ends to which words keep coming again a period later."""
        if not len(stop):
            return stop
        stop = stop.copy()
        for level in range(len(self._windows) - 1, -1, -1):
            windows, step = self._windows[level].values, 2**level
            going = np.arange(len(stop))
            while len(going):
                at, again = stop[going], stop[going] + period[going]
                inside = again < len(windows)
                going, at, again = going[inside], at[inside], again[inside]
                going = going[windows[at] == windows[again]]
                stop[going] += step
        return stop

    def _long(self, length, period):
        return (length >= self.least_words) & (length >= self.least_periods * period)

    def _close(self, runs: np.ndarray) -> None:
        start, stop, period = runs
        kept = runs[:, self._long(stop + period - start, period)]
        if kept.shape[1]:
            self._closed.append(kept)

    def _exact(self, start: int, end: int, period: int) -> Run | None:
        """The run as the words themselves have it, should two hashes have met by chance."""
        held = self._words.values
        same = held[start : end - period] == held[start + period : end]
        open_left = start > 0 and held[start - 1] == held[start - 1 + period]
        open_right = end < len(held) and held[end - period] == held[end]
        if same.all() and not open_left and not open_right:
            return Run(start, end - start, period)
        differ = np.flatnonzero(held[:-period] != held[period:])
        edges = np.concatenate([[-1], differ, [len(held) - period]])
        longest = max(
            ((a + 1, b) for a, b in zip(edges.tolist(), edges[1:].tolist()) if b > start and a < end),
            key=lambda pair: pair[1] - pair[0],
        )
        return Run(longest[0], longest[1] + period - longest[0], period)


def find_runs(
    found: list[bytes], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> list[Run]:
    """Every maximal run of a list of words, by start, then period."""
    if len(found) < max(least_words, least_periods):
        return []
    names: dict[bytes, int] = {}
    numbers = np.fromiter((names.setdefault(word, len(names)) for word in found), np.int64, len(found))
    if len(names) == len(found):
        return []
    catchers = Catchers(least_words, least_periods)
    for at in range(0, len(numbers), PIECE):
        catchers.append(numbers[at : at + PIECE])
    return catchers.runs()


def collapse(found: list[bytes], runs: list[Run]) -> bytes:
    """The words without what repeats the first period of a run, joined by one blank."""
    if not runs:
        return b" ".join(found)
    kept = np.ones(len(found), bool)
    for run in runs:
        kept[run.start + run.period : run.start + run.length] = False
    return b" ".join(found[n] for n in np.flatnonzero(kept).tolist())


_RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in Run._fields])
_ARROW_RUN = pa.list_(pa.struct([pa.field(name, pa.int64(), False) for name in Run._fields]))


def scan(
    docs: DataFrame,
    text: str = "text",
    runs: str = "runs",
    collapsed: str = "collapsed",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """Add the runs of every whole text (start, length, period in words) and the text without
    the repetitions."""
    for name in (runs, collapsed):
        if name in docs.columns:
            raise ValueError(f"there is a column {name!r} already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, left = [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                # Bytes know exactly the six ASCII blanks.
                found = (value.as_py() or "").encode().split()
                got = find_runs(found, least_words, least_periods)
                made.append([one._asdict() for one in got])
                left.append(collapse(found, got).decode())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, _ARROW_RUN), pa.array(left, pa.string())],
                [*batch.schema.names, runs, collapsed],
            )

    added = [
        T.StructField(runs, T.ArrayType(_RUN, False), False),
        T.StructField(collapsed, T.StringType(), False),
    ]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Column:
    """Texts of which about a tenth, chosen by the id's checksum, end in a repeated passage.

    From word a on, word i is word a + (i - a) % p of the text. A null id changes nothing.
    """
    checksum = F.crc32(F.col(doc_id).cast("string"))
    chosen = F.coalesce(checksum % 10 == 0, F.lit(False))
    drawn = F.floor(checksum / 10)

    def repeated(held: Column) -> Column:
        size = F.size(held)
        first = (drawn % size).cast("int")
        period = (1 + F.floor((size - first) / (3 + drawn % 8))).cast("int")
        again = F.transform(F.sequence(first, size - 1), lambda i: F.get(held, first + (i - first) % period))
        made = F.array_join(F.concat(F.slice(held, F.lit(1), first), again), " ")
        return F.when(size > 0, made).otherwise(F.col(text))

    # A variable of a lambda is evaluated once, not for each word.
    made = F.get(F.transform(F.array(words(F.col(text))), repeated), F.lit(0))
    return F.when(chosen, made).otherwise(F.col(text))
