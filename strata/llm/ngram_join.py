"""Texts whose sets of n-grams are alike, joined exactly on prefix trees.

1. A text becomes the sorted set of its word n-grams, as 64-bit hashes. Texts of equal sets fall
   together in an aggregation.
2. Sets that may link are brought together by signatures. The range of hashes is cut into one part
   more than the n-grams that two linked sets may differ in, so they agree in all n-grams of at
   least one part: a signature is the digest of one part. The number of parts depends on the size,
   so a set has signatures for its own class of sizes and for the class below, where it meets
   smaller sets. Each signature's sets are tied to the smallest of them; what is tied together is
   a group. No link leaves a group, and no pair of a signature is written out.
3. A group is cut into slices of bounded size. In a slice, n-grams are ordered by how many sets
   have them, the most frequent first, and the sets are stored in a trie in that order. One
   traversal serves all sets of the slice as probes: a node has, for each probe, the n-grams that
   it shares with the path, and its children start from that. An edge's n-gram adds one to the
   probes that have it, or takes one from those that lack it, whichever are fewer. A subtree is
   cut off where no probe that isn't joined to all of it can still overlap enough, by the n-grams
   that remain below and those that remain to the probe.
4. Links join at once, and what is joined is not compared again, so a slice gives no more links
   than sets. Slices of a large group hold its first set besides their own. Where that leaves a
   group apart, the sets outside its largest component probe the tries of all its slices.

A group all of whose sets are nearly but not quite alike costs the square of its size in step 4,
in slices, as trie traversals. All others cost their size.

Defined results: words are what ASCII blanks separate, ASCII case aside; a text of fewer words than
an n-gram is one n-gram; a null text and one without words have an empty set, which links with
nothing, its copies neither. Rows of equal sets link. A null id never names a component unless all
ids of it are null. Repeated rows share their component. Other columns aren't read. Two n-grams of
a pair of texts are taken for the same by chance once in 10^13 pairs of texts of a thousand words.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import map_batches, settle
from strata.llm.simhash import components, label

WIDTH = 3
#: Shared over all n-grams of two texts, at least: a fraction of whole numbers.
SIMILAR = (9, 10)
SEED = 42
#: Sets of a slice, and their n-grams, at most (one set may have more).
SLICE_SETS = 1024
SLICE_GRAMS = 1 << 21
#: Times that a set with empty parts is cut anew.
TURNS = 64


# Sets


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def grams(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The text's n-grams as distinct hashes, ascending."""
    # Bytes know ASCII case and exactly the six ASCII blanks.
    found = (text or "").encode().lower().split()
    width = min(width, len(found))
    if not width:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    total = len(found) - width + 1
    made = np.full(total, width, np.uint64)
    for n in range(width):
        made = _mixed(made * np.uint64(5) + hashes[n : n + total])
    made ^= made >> np.uint64(32)
    return np.unique(made)


# Signatures


@functools.cache
def _largest(number: int, similar: tuple[int, int]) -> int:
    """The largest size of a class of sizes."""
    least, of = similar
    return _largest(number - 1, similar) * of // least + 1 if number else 1


def size_class(size: int, similar: tuple[int, int] = SIMILAR) -> int:
    """Sets that link are of one class of sizes or of neighbouring ones."""
    return next(n for n in itertools.count() if size <= _largest(n, similar))


@functools.cache
def parts(number: int, similar: tuple[int, int] = SIMILAR) -> int:
    """Parts for links whose smaller set is of class `number`: one more than the n-grams in which
    the two can differ."""
    least, of = similar
    # The smaller set holds all that is shared, so the union is not larger than this.
    union = _largest(number, similar) * of // least
    return union * (of - least) // of + 1


def _digests(hashes: np.ndarray, number: int, similar: tuple[int, int]) -> np.ndarray:
    count, made = parts(number, similar), []
    for turn in range(TURNS):
        if turn:
            hashes = np.sort(_mixed(hashes + np.uint64(turn)))
        # Sums of mixed hashes: as good as digests of the parts, and made at once.
        sums = np.append(np.uint64(0), np.cumsum(_mixed(hashes + np.uint64(SEED))))
        edges = np.arange(1, count, dtype=np.uint64) * np.uint64((1 << 64) // count if count > 1 else 0)
        cuts = np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])
        place = np.arange(count, dtype=np.uint64) + np.uint64((number << 40) + (turn << 32))
        digests = _mixed((sums[cuts[1:]] - sums[cuts[:-1]]) ^ _mixed(place))
        full = cuts[1:] > cuts[:-1]
        if full.all() or turn == TURNS - 1:
            made.append(digests)
            break
        # Two sets may agree in no part but empty ones, which say nothing. Both have them, so both
        # are cut anew by other hashes.
        made.append(digests[full])
    return np.concatenate(made)


def signatures(hashes: np.ndarray, similar: tuple[int, int] = SIMILAR) -> np.ndarray:
    """Digests of the parts of a set of ascending hashes, for its class of sizes and the one below."""
    own = size_class(len(hashes), similar)
    return np.concatenate([_digests(hashes, n, similar) for n in range(max(0, own - 1), own + 1)])


_SET = T.StructType(
    [
        T.StructField("node", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("signatures", T.ArrayType(T.LongType())),
    ]
)


def _set_number(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def add_sets(docs: DataFrame, text: str, width: int, similar: tuple[int, int]) -> DataFrame:
    """Add a struct `set`: the set's own number, its size and its signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, listed = [], [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                hashes = grams(value.as_py(), width)
                nodes.append(_set_number(hashes))
                sizes.append(len(hashes))
                listed.append(signatures(hashes, similar).view(np.int64) if len(hashes) else [])
            made = pa.StructArray.from_arrays(
                [
                    pa.array(np.array(nodes, np.uint64).view(np.int64)),
                    pa.array(sizes, pa.int64()),
                    pa.array(listed, pa.list_(pa.int64())),
                ],
                _SET.fieldNames(),
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, "set"])

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField("set", _SET)]))


# Tries


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after the other."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts - starts, counts)


class Trie:
    """Sets as paths, most frequent n-gram first. A node is a run of sets in the order of paths."""

    def __init__(self, sets: list[np.ndarray], probes: list[np.ndarray]) -> None:
        every = [*sets, *probes]
        stored, self._everyone = len(sets), len(every)
        self.sizes = np.array([len(x) for x in every], np.int64)
        flat = np.concatenate([np.empty(0, np.uint64), *every])
        owner = np.repeat(np.arange(len(every)), self.sizes)
        _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(count), np.int64)
        by_count = np.argsort(-count, kind="stable")
        rank[by_count] = np.arange(len(count))
        ranks = rank[place]
        # For each n-gram the sets that have it, or of the most frequent those that lack it.
        count = count[by_count]
        self._many = int((2 * count > self._everyone).sum())
        frequent = ranks < self._many
        lacking = np.ones((self._many, self._everyone), bool)
        lacking[ranks[frequent], owner[frequent]] = False
        order = np.argsort(ranks[~frequent], kind="stable")
        self._rows = np.concatenate([np.nonzero(lacking)[1], owner[~frequent][order]])
        self._counts = np.where(np.arange(len(count)) < self._many, self._everyone - count, count)
        self._starts = np.cumsum(self._counts) - self._counts
        ends = np.cumsum(self.sizes)
        paths = [np.sort(ranks[e - n : e]) for e, n in zip(ends[:stored], self.sizes[:stored], strict=True)]
        # Large-ended bytes sort as the paths do.
        keys = [path.astype(">u4").tobytes() for path in paths]
        self.order = np.array(sorted(range(stored), key=keys.__getitem__), np.int64)
        self.paths = [paths[n] for n in self.order.tolist()]
        #: What a path shares with the one before.
        self.common = np.zeros(stored, np.int64)
        for n in range(1, stored):
            one, other = self.paths[n - 1], self.paths[n]
            least = min(len(one), len(other))
            differ = np.flatnonzero(one[:least] != other[:least])
            self.common[n] = differ[0] if len(differ) else least

    def _behind(self, path: np.ndarray, overlap: np.ndarray) -> np.ndarray:
        """The overlaps behind an edge, from those before it."""
        many = int(np.searchsorted(path, self._many))
        made = overlap + many
        for grams_, sign in ((path[:many], -1), (path[many:], 1)):
            if len(grams_):
                rows = self._rows[_ranges(self._starts[grams_], self._counts[grams_])]
                made += sign * np.bincount(rows, minlength=self._everyone)
        return made

    def links(self, labels: np.ndarray, similar: tuple[int, int]) -> list[tuple[int, int]]:
        """Links that join whatever the stored sets link with. labels: numbers that are equal where
        sets are joined, changed on the way."""
        least, of = similar
        # Two sets link if (of + least) * overlap >= least * (one size + other size).
        need = least * self.sizes
        found: list[tuple[int, int]] = []
        stack = [(0, len(self.paths), 0, np.zeros(self._everyone, np.int64))] if self.paths else []
        while stack:
            # The sets first to last - 1 share `depth` n-grams, which overlap counts.
            first, last, depth, overlap = stack.pop()
            mine, sizes = labels[self.order[first:last]], self.sizes[self.order[first:last]]
            alive = labels != mine[0] if (mine == mine[0]).all() else np.ones(len(labels), bool)
            more = np.minimum(self.sizes - overlap, int(sizes.max()) - depth)
            alive &= (of + least) * (overlap + more) >= need + least * int(sizes.min())
            if not alive.any():
                continue
            alone = last - first == 1
            to = len(self.paths[first]) if alone else int(self.common[first + 1 : last].min())
            if to > depth:
                overlap = self._behind(self.paths[first][depth:to], overlap)
            if len(self.paths[first]) == to:
                here = int(self.order[first])
                linked = (of + least) * overlap >= need + least * int(self.sizes[here])
                linked &= labels != labels[here]
                for label in np.unique(labels[linked]).tolist():
                    found.append((here, int(np.flatnonzero(linked & (labels == label))[0])))
                    labels[labels == label] = labels[here]
                first += 1
            if first < last:
                cuts = first + 1 + np.flatnonzero(self.common[first + 1 : last] == to)
                edges = [first, *cuts.tolist(), last]
                stack += [(a, b, to, overlap) for a, b in itertools.pairwise(edges)][::-1]
        return found


def trie_links(
    sets: list[np.ndarray], probes: list[np.ndarray], similar: tuple[int, int] = SIMILAR
) -> list[tuple[int, int]]:
    """Links (numbers of sets, then probes) that join all that the sets link with among themselves
    and with probes; links among probes alone aren't sought."""
    trie = Trie(sets, probes)
    return trie.links(np.arange(len(sets) + len(probes)), similar)


# Joins


_PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _joined(members: DataFrame, width: int, similar: tuple[int, int]) -> DataFrame:
    """Pairs (a, b), a > b, that join what links of members (part, node, probe, text) join, a part a
    trie."""

    def links(rows: list[tuple[int, bool, str]]) -> Iterator[tuple[int, int]]:
        stored = {node: text for node, probe, text in rows if not probe}
        asking = {node: text for node, probe, text in rows if probe and node not in stored}
        nodes = [*stored, *asking]
        sets = [grams(text, width) for text in stored.values()]
        probes = [grams(text, width) for text in asking.values()]
        found = np.array(trie_links(sets, probes, similar), np.int64).reshape(-1, 2)
        # As stars, which take fewer rounds to become components than chains.
        named = np.array(nodes, np.int64)[found]
        yield from zip(*(x.tolist() for x in _stars(named[:, 0], named[:, 1])), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            found: list[tuple[int, int]] = []
            for at, *row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if at != part:
                    found += links(held)
                    part, held = at, []
                held.append(tuple(row))
            yield _pairs(found)
        yield _pairs(list(links(held)))

    ordered = members.select("part", "node", "probe", "text").repartition("part")
    return map_batches(ordered.sortWithinPartitions("part", "node"), run, _PAIR)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([pair[n] for pair in found], pa.int64()) for n in range(2)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


_MET = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("a", T.LongType()),
        T.StructField("b", T.LongType()),
        T.StructField("tie", T.BooleanType()),
    ]
)


def _met(keys: np.ndarray, a: np.ndarray, b: np.ndarray, tie: bool) -> pa.RecordBatch:
    columns = [pa.array(keys), pa.array(a), pa.array(b), pa.array(np.full(len(keys), tie))]
    return pa.RecordBatch.from_arrays(columns, _MET.fieldNames())


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node that pairs join each to; those that are it are left out."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    low, before = np.arange(len(nodes)), None
    while before is None or (low != before).any():
        before = low.copy()
        least = np.minimum(low[a], low[b])
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        low = low[low]
    moved = low != np.arange(len(nodes))
    return nodes[moved], nodes[low[moved]]


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of a batch, each once, with the smallest set that the batch ties it to; ties of
    the others to that.

    So a signature of any number of sets leaves a task in as many rows as the task has batches.
    """
    for batch in batches:
        listed = batch.column(1)
        sizes = listed.value_lengths().to_numpy(zero_copy_only=False)
        nodes = np.repeat(batch.column(0).to_numpy(), sizes)
        keys = listed.flatten().to_numpy(zero_copy_only=False)
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        opens = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
        low = nodes[np.flatnonzero(opens)[np.cumsum(opens) - 1]]
        moved, root = _stars(nodes[nodes > low], low[nodes > low])
        first = nodes[opens]
        if len(moved):
            at = np.minimum(np.searchsorted(moved, first), len(moved) - 1)
            first = np.where(moved[at] == first, root[at], first)
        yield _met(keys[opens], first, first, False)
        yield _met(moved, moved, root, True)


def _ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ties (a, b), a > b, of rows that come ordered by key, then a."""
    key, low = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, a, b, tie = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
        done, (keys, nodes) = np.stack([a[tie], b[tie]]), (keys[~tie], a[~tie])
        if len(keys):
            opens = np.append(keys[0] != key, keys[1:] != keys[:-1])
            lows = np.append(low, nodes[opens])[np.cumsum(opens)]
            key, low = keys[-1], lows[-1]
            done = np.concatenate([done, np.stack([nodes, lows])[:, nodes > lows]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _stars(*done)], ["a", "b"])


def tied(points: DataFrame) -> DataFrame:
    """(node, root) of sets (node, signatures) that signatures tie together."""
    met = points.select("node", "signatures").mapInArrow(_first_of_each, _MET)
    ordered = met.repartition("key").sortWithinPartitions("key", "a")
    return components(ordered.mapInArrow(_ties, _PAIR).distinct())


def links(
    points: DataFrame,
    texts: DataFrame,
    width: int = WIDTH,
    similar: tuple[int, int] = SIMILAR,
    slice_grams: int = SLICE_GRAMS,
    ties: Callable[[DataFrame], DataFrame] = tied,
) -> DataFrame:
    """Pairs (a, b), a > b, that join the same sets as all links of settled points (node, size,
    signatures) do; a pair may be joined by several links. texts: (node, text). Both have any number of rows a node.

    ties: makes (node, root) of the points, for what may link; it may read other columns than signatures."""
    roots = ties(points)
    groups = roots.union(roots.select("root", "root").distinct()).toDF("node", "group")
    sizes = points.groupBy("node").agg(F.first("size").alias("size"))
    groups = settle(groups.join(sizes, "node"), "groups")
    cut = groups.groupBy("group").agg(
        F.greatest(
            F.ceil(F.count("*") / SLICE_SETS), F.ceil(F.sum("size") / slice_grams), F.lit(1)
        ).alias("slices")
    )
    placed = groups.join(cut, "group").withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")))
    placed = settle(placed, "placed")
    texts = texts.join(placed.select("node"), "node", "left_semi")
    texts = settle(texts.dropDuplicates(["node"]), "texts")
    # A group's first set stands in each of its slices.
    guests = placed.where("node = group").withColumn(
        "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))
    )
    columns = ["group", "slice", "node"]
    members = placed.select(*columns, F.lit(False).alias("probe"))
    members = members.union(guests.select(*columns, F.lit(True)))
    part = F.xxhash64("group", "slice").alias("part")
    within = members.select(part, "node", "probe").join(texts, "node")
    first = settle(_joined(within, width, similar), "first")
    if placed.where("slices > 1").isEmpty():
        return first
    # What is still apart in groups of several slices.
    found = components(first)
    rooted = placed.where("slices > 1").join(found, "node", "left")
    rooted = settle(rooted.withColumn("root", F.coalesce("root", "node")), "rooted")
    sizes = rooted.groupBy("group", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("group").agg(F.max_by("root", F.struct("n", "root")).alias("largest"))
    apart = rooted.join(largest, "group").where("root <> largest")
    if apart.isEmpty():
        return first
    # Those are sliced in turn, and each of their slices meets each slice of the group.
    asking = apart.select("group", "node", "size", "slices")
    blocks = asking.groupBy("group").agg(
        F.greatest(
            F.ceil(F.count("*") / SLICE_SETS), F.ceil(F.sum("size") / slice_grams), F.lit(1)
        ).alias("blocks")
    )
    blocks = settle(blocks, "blocks")
    block = F.pmod(F.xxhash64(F.lit(SEED), "node"), F.col("blocks"))
    asking = asking.join(blocks, "group").select(
        "group", "node", block.alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"),
        F.lit(True).alias("probe"),
    )
    stored = placed.join(blocks, "group").select(
        "group", "node",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "slice", F.lit(False).alias("probe"),
    )
    part = F.xxhash64("group", "slice", "block").alias("part")
    across = asking.unionByName(stored).select(part, "node", "probe").join(texts, "node")
    return first.union(_joined(across, width, similar)).distinct()


def similar_texts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    similar: tuple[int, int] = SIMILAR,
) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of docs."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = add_sets(named, "text", width, similar).select("doc_id", "text", "set.*")
    marked = settle(marked, "sets")
    filled = marked.where("size > 0")
    found = links(filled.select("node", "size", "signatures"), filled.select("node", "text"), width, similar)
    labels = label(filled.select("doc_id", F.col("node").alias("fingerprint")), "doc_id", lambda _: found)
    labels = labels.select(F.col("fingerprint").alias("node"), "component_id")
    # Empty sets stay by themselves, and out of the join: all have one number.
    empty = marked.where("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    joined = filled.select("doc_id", "node", "size").join(labels, "node", "left")
    return joined.select("doc_id", "size", "component_id").union(empty).select(
        F.col("doc_id").alias(doc_id), F.col("size").alias("n_shingles"), "component_id"
    )
