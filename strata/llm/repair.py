"""Token ids on disk, compressed by a grammar of repeated pairs (Re-Pair).

Writing: documents are dealt by ranges of their id, sorted, encoded, and gathered into blocks of
about BLOCK_IDS ids, whole documents each. In a block, frequent neighbours become a nonterminal,
round by round until no pair pays for its rule: all pairs that occur half as often as the most
frequent one, or more, are replaced at once, the more frequent first where two overlap, never
across documents. Pairs are counted exactly. A replacement only makes pairs of symbols that are new in
it, so a pair never becomes more frequent than it was at first: places lie in levels by what their
pair counted last, and a round looks only at those levels that reach its bound. A rule (left, right) is
stored with the length of its expansion, so that any part of a document is found by adding up
lengths and decoded alone (`decode_part`).

The file format is Parquet, one row a block: Spark's writer makes each file whole or not at all,
wherever the shared folder is. Columns: shard and block (their order is that of the ids), before
(ids of the shard's earlier blocks), n_ids, doc_ids, doc_lengths (ids of each document),
doc_symbols (symbols of each), left, right and lengths of the rules, low and high (bits 0-15 and
16-23 of the symbols). Numbers are little-endian. Symbols below TERMINALS are ids.

Defined results: a null text has only the end id; a null id comes first; repeated rows are stored
each; other columns are not read. A task holds one block, or one document if that is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import map_batches, settle
from strata.llm.tokens import word_ids

END = 2
TERMINALS = 1 << 16
BLOCK_IDS = 1 << 20
#: A rule takes twelve bytes and saves three a use.
LEAST_USES = 5
#: Counters that sort out rare pairs before the others are counted exactly.
COUNTERS = 1 << 20
#: Stands for a document's end id while pairs are sought; no token has it.
_MARK = TERMINALS - 1
#: Symbols of a block fit 24 bits.
MOST_RULES = (1 << 24) - TERMINALS


class Grammar(NamedTuple):
    symbols: np.ndarray
    doc_symbols: np.ndarray
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray


def _chosen(score: np.ndarray) -> np.ndarray:
    """Places whose pair goes: the score is the highest around, every second one in a run."""
    best = score > 0
    same = score[1:] == score[:-1]
    best[1:] &= score[1:] >= score[:-1]
    best[:-1] &= score[:-1] >= score[1:]
    if (best[1:] & same).any():
        places = np.arange(len(score))
        opens = places.copy()
        opens[1:][same] = 0
        best &= (places - np.maximum.accumulate(opens)) % 2 == 0
    return np.flatnonzero(best)


def _slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The counters of those pairs; the last one where a document ends, which counts nothing."""
    mixed = ((left << 24) | right).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    slots = (mixed >> np.uint64(64 - COUNTERS.bit_length() + 1)).view(np.int64)
    slots[(left == _MARK) | (right == _MARK)] = COUNTERS
    return slots


def _where(mask: np.ndarray) -> np.ndarray:
    """The places of a mask of whole words, by words where most are empty."""
    if 32 * np.count_nonzero(mask) > len(mask):
        return np.flatnonzero(mask)
    word = np.flatnonzero(mask.view(np.uint64))
    row, column = np.nonzero(mask.reshape(-1, 8)[word])
    return 8 * word[row] + column


def _levels(counts: np.ndarray) -> np.ndarray:
    """Binary digits of counts, 0 for those too rare for a rule."""
    digits = np.frexp(counts)[1].astype(np.int8)
    digits[counts < LEAST_USES] = 0
    return digits


class _Sequence:
    """The symbols of a block as a list of places, each knowing the next and the one before, and
    the counter of the pair that starts there.

    Pairs that share a counter are counted too high, never too low.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        self.symbols = symbols
        places = np.arange(len(symbols) + 1)
        self.next, self.last = places + 1, places - 1
        self.alive = np.ones(len(symbols), bool)
        self.slot = np.full(len(symbols), COUNTERS, np.int32)
        self.slot[:-1] = _slots(symbols[:-1], symbols[1:])
        self.counts = np.bincount(self.slot, minlength=COUNTERS + 1).astype(np.int32)
        self.counts[COUNTERS] = 0

    def keys(self, places: np.ndarray) -> np.ndarray:
        return (self.symbols[places] << 24) | self.symbols[self.next[places]]

    def _slot(self, places: np.ndarray) -> None:
        after = self.next[places]
        inside = after < len(self.symbols)
        places, after = places[inside], after[inside]
        self.slot[places] = _slots(self.symbols[places], self.symbols[after])

    def count(self, places: np.ndarray) -> np.ndarray:
        return self.counts[self.slot[places]]

    def replace(self, places: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Put a symbol for each of those pairs; returns the places whose pair is another now."""
        gone = self.next[places]
        after = self.next[gone]
        self.symbols[places] = symbols
        self.next[places], self.last[after] = after, places
        self.alive[gone] = False
        before = self.last[places]
        changed = np.sort(np.concatenate([places, before[before >= 0]]))
        changed = changed[np.append(True, changed[1:] != changed[:-1])]
        left = np.concatenate([changed, gone])
        np.subtract.at(self.counts, self.slot[left], np.int32(1))
        self.slot[left] = COUNTERS
        self._slot(changed)
        np.add.at(self.counts, self.slot[changed], np.int32(1))
        self.counts[COUNTERS] = 0
        return changed


def _apart(held: _Sequence, places: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Which of the pairs at those places go, no two of which overlap."""
    # Neighbours stand next to each other; what lies between others scores nothing.
    shift = np.arange(len(places)) + np.append(0, np.cumsum(held.next[places[:-1]] != places[1:]))[: len(places)]
    spread = np.zeros(int(shift[-1]) + 1 if len(shift) else 0, np.int64)
    spread[shift] = score
    chosen = np.zeros(len(spread), bool)
    chosen[_chosen(spread)] = True
    return chosen[shift]


def compress(documents: list[np.ndarray]) -> Grammar:
    """The grammar of a block of documents, each with its end id, which no rule takes in.

    Ends when no pair is left that occurs LEAST_USES times apart from itself.
    """
    symbols = np.concatenate(documents).astype(np.int64)
    symbols[np.cumsum([len(x) for x in documents]) - 1] = _MARK
    held = _Sequence(symbols)
    rules: list[np.ndarray] = [np.empty(0, np.int64)]
    made, least = 0, len(symbols)
    # Of what each place's pair counted when it was last looked at, or changed.
    level = np.zeros(-(-len(symbols) // 8) * 8, np.int8)
    level[: len(symbols)] = _levels(held.counts)[held.slot]
    while True:
        most = 0
        while top := int(level.max(initial=0)):
            places = _where(level == top)
            found = held.count(places)
            most = int(found.max())
            if most.bit_length() >= top:
                break
            level[places] = _levels(found)
        if not top:
            break
        least = max(LEAST_USES, min(least, most // 2))
        places = _where(level >= least.bit_length())
        found = held.count(places)
        rare = found < least
        level[places[rare]] = _levels(found[rare])
        at = places[~rare]
        known, number, counts = np.unique(held.keys(at), return_inverse=True, return_counts=True)
        # A score of its own for each pair, larger for more frequent ones.
        score = np.where(counts >= least, counts * (len(counts) + 1) + np.arange(len(counts)), 0)
        wanted = score[number] > 0
        level[at[~wanted]] = _levels(counts)[number[~wanted]]
        at, of = at[wanted], number[wanted]
        chosen = _apart(held, at, score[of])
        at, of = at[chosen], of[chosen]
        uses = np.bincount(of, minlength=len(counts))
        rule = np.flatnonzero(uses >= LEAST_USES)
        if not len(rule) or made + len(rule) > MOST_RULES:
            if least == LEAST_USES:
                break
            least //= 2
            continue
        named = np.full(len(counts), -1)
        named[rule] = TERMINALS + made + np.arange(len(rule))
        rules.append(known[rule])
        made += len(rule)
        at, of = at[named[of] >= 0], of[named[of] >= 0]
        changed = held.replace(at, named[of])
        level[changed] = _levels(held.count(changed))
    keys = np.concatenate(rules)
    left, right = keys >> 24, keys & 0xFFFFFF
    sizes = np.ones(TERMINALS + made, np.int64)
    at = 0
    for some in rules:
        # A round's rules name symbols from before it.
        to = at + len(some)
        sizes[TERMINALS + at : TERMINALS + to] = sizes[left[at:to]] + sizes[right[at:to]]
        at = to
    symbols = held.symbols[held.alive]
    ends = np.flatnonzero(symbols == _MARK) + 1
    symbols[ends - 1] = END
    return Grammar(symbols, np.diff(ends, prepend=0), left, right, sizes[TERMINALS:])


class Expansions:
    """The ids of every symbol of a grammar, one after the other."""

    def __init__(self, left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> None:
        sizes = np.concatenate([np.ones(TERMINALS, np.int64), lengths])
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.ids = np.empty(int(sizes.sum()), np.uint32)
        self.ids[:TERMINALS] = np.arange(TERMINALS)
        at = 0
        while at < len(left):
            # A stretch of rules that only name symbols from before it.
            newest = np.maximum(left[at:], right[at:]) - TERMINALS
            blocked = np.flatnonzero(newest >= at)
            to = at + int(blocked[0]) if len(blocked) else len(left)
            pairs = np.stack([left[at:to], right[at:to]], axis=1).ravel()
            start = self.starts[TERMINALS + at]
            found = self.expand(pairs)
            self.ids[start : start + len(found)] = found
            at = to

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.sizes[symbols]
        ends = np.cumsum(sizes)
        if not len(ends):
            return np.empty(0, np.uint32)
        shift = np.repeat(self.starts[symbols] - ends + sizes, sizes)
        return self.ids[shift + np.arange(ends[-1])]


def decode_part(
    symbols: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray, start: int, stop: int
) -> list[int]:
    """ids start to stop of a document's symbols; only rules on the way to them are expanded."""
    size_of = lambda s: 1 if s < TERMINALS else int(lengths[s - TERMINALS])
    sizes = np.where(symbols < TERMINALS, 1, lengths[np.maximum(symbols - TERMINALS, 0)] if len(lengths) else 1)
    ends = np.cumsum(sizes)
    first = int(np.searchsorted(ends, start, side="right"))
    at = int(ends[first - 1]) if first else 0
    stack = []
    for symbol in symbols[first : int(np.searchsorted(ends, stop)) + 1][::-1].tolist():
        stack.append(symbol)
    out: list[int] = []
    while stack and at < stop:
        symbol = stack.pop()
        if at + size_of(symbol) <= start:
            at += size_of(symbol)
        elif symbol < TERMINALS:
            out.append(symbol)
            at += 1
        else:
            stack += [int(right[symbol - TERMINALS]), int(left[symbol - TERMINALS])]
    return out


_BINARY = ("doc_lengths", "doc_symbols", "left", "right", "lengths", "low", "high")
BLOCKS = T.StructType(
    [T.StructField(name, T.LongType(), False) for name in ("shard", "block", "before", "n_ids")]
    + [T.StructField("doc_ids", T.ArrayType(T.LongType()), False)]
    + [T.StructField(name, T.BinaryType(), False) for name in _BINARY]
)


def _block(shard: int, block: int, before: int, doc_ids: list, documents: list[np.ndarray]) -> pa.RecordBatch:
    grammar = compress(documents)
    packed = {
        "doc_lengths": np.array([len(x) for x in documents], "<u4"),
        "doc_symbols": grammar.doc_symbols.astype("<u4"),
        "left": grammar.left.astype("<u4"),
        "right": grammar.right.astype("<u4"),
        "lengths": grammar.lengths.astype("<u4"),
        "low": (grammar.symbols & 0xFFFF).astype("<u2"),
        "high": (grammar.symbols >> 16).astype("u1"),
    }
    values = [shard, block, before, sum(map(len, documents))]
    return pa.RecordBatch.from_arrays(
        [pa.array([x], pa.int64()) for x in values]
        + [pa.array([doc_ids], pa.list_(pa.int64()))]
        + [pa.array([packed[name].tobytes()], pa.binary()) for name in _BINARY],
        BLOCKS.fieldNames(),
    )


def write(docs: DataFrame, path: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode all documents, in the order of their ids, into files below path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = word_ids(vocabulary), TaskContext.get().partitionId()
        end = np.array([END], np.uint16)
        block = before = held = 0
        doc_ids: list[int | None] = []
        documents: list[np.ndarray] = []
        for batch in batches:
            ids, texts = batch.columns
            for doc_id, text in zip(ids.to_pylist(), encoder.encoded(texts), strict=True):
                documents.append(np.append(text, end))
                doc_ids.append(doc_id)
                held += len(documents[-1])
                if held >= BLOCK_IDS:
                    yield _block(shard, block, before, doc_ids, documents)
                    block, before, held, doc_ids, documents = block + 1, before + held, 0, [], []
        if documents:
            yield _block(shard, block, before, doc_ids, documents)

    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_batches(ordered, run, BLOCKS).write.parquet(path)


DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("shard", T.LongType(), False),
        T.StructField("within", T.LongType(), False),
        T.StructField("n_tokens", T.LongType(), False),
        T.StructField("ids", T.BinaryType(), False),
    ]
)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            numbers = {name: np.frombuffer(row[name], "<u4").astype(np.int64) for name in _BINARY[:5]}
            symbols = np.frombuffer(row["low"], "<u2").astype(np.int64)
            symbols |= np.frombuffer(row["high"], "u1").astype(np.int64) << 16
            ids = Expansions(numbers["left"], numbers["right"], numbers["lengths"]).expand(symbols)
            lengths = numbers["doc_lengths"]
            ends = np.cumsum(lengths)
            starts = ends - lengths
            data = ids.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(np.full(len(ends), row["shard"])),
                    pa.array(row["before"] + starts),
                    pa.array(lengths),
                    pa.array([data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
                ],
                DOCUMENTS.fieldNames(),
            )


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents below path: ids as little-endian unsigned
    32-bit numbers, start counts the ids of all documents before."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row for each shard; written, so that the planner knows how small it is.
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first"))
    starts = settle(starts, "starts")
    found = blocks.mapInArrow(_documents, DOCUMENTS)
    return found.join(starts, "shard").select(
        "doc_id", (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids"
    )
