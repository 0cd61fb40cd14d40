"""Near-duplicates by SimHash, compared bit-sliced.

1. Each whole text becomes a 64-bit fingerprint (`add_fingerprint`).
2. Equal fingerprints fall together in an aggregation, so copies are never compared.
3. Distinct fingerprints meet where they agree on two of six blocks of bits: of the at most four
   bits in which two linked fingerprints differ, each spoils one block, so two blocks agree for
   every link. Fifteen tables, no link lost.
4. In a bucket of a table, fingerprints lie as vertical bit planes. A row of counters holds the
   distances of one fingerprint to a whole block, bit-sliced; carry-save adders update 64 of them
   by one machine word, and a row is abandoned once all of it exceeds the radius.
5. A bucket larger than a slice is split: its slices meet pairwise under keys of their own.
   Each task reduces what it finds to links with the smallest member of a local group, so dense
   groups give no more links than members.
6. Links become components by alternating minimum stars, written to the shared folder each round.

Defined results: a null text is empty, its fingerprint zero, which links like any other. A null
id never names a component unless all ids of it are null. Repeated rows share fingerprint and
component. Other columns pass through `add_fingerprint` unread.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import settle

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
#: Blocks of bits, two of which two linked fingerprints share.
BLOCKS = 6
#: Lanes of a block of planes, and fingerprints of a slice of a large bucket.
LANES = 1024
SLICE = 8192
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """Majority of the bits of the shingles' XXH64, as an unsigned number."""
    # Bytes know ASCII case and exactly the six ASCII blanks.
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(word) + 1 for word in found]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    width = min(SHINGLE, len(found))
    spans = zip(starts, ends[width - 1 :].tolist(), strict=False)
    hashes = (xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans)
    total = len(found) - width + 1
    ones = np.zeros(BITS, np.int64)
    while len(chunk := np.fromiter(itertools.islice(hashes, CHUNK), "<u8")):
        bits = np.unpackbits(chunk.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def add_fingerprint(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of the column `text` as a long (the same 64 bits, signed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            made = np.array([fingerprint(x.as_py()) for x in texts], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.int64())], [*batch.schema.names, into]
            )

    if into in docs.columns:
        raise ValueError(f"there is a column {into!r} already")
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.LongType(), False)])
    return docs.mapInArrow(run, schema)


def _masks() -> list[int]:
    """For each pair of blocks, the bits of the two, as a signed long."""
    edges = np.linspace(0, BITS, BLOCKS + 1).round().astype(int).tolist()
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    masks = [a | b for a, b in itertools.combinations(blocks, 2)]
    return [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]


def planes(fingerprints: np.ndarray) -> np.ndarray:
    """Row b holds bit b of all fingerprints, 64 of them a word."""
    bits = np.unpackbits(
        fingerprints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )
    padded = np.zeros((BITS, -(-len(fingerprints) // 64) * 64), np.uint8)
    padded[:, : len(fingerprints)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def within_radius(
    queries: np.ndarray, block: np.ndarray, wanted: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `queries` and words of lanes that differ in at most RADIUS bits.

    queries: fingerprints; block: planes of others; wanted: for each query a row of words, the
    lanes that matter. Returns the surviving rows' numbers and their lanes.
    """
    rows = np.flatnonzero(wanted.any(axis=1))
    alive = wanted[rows]
    picked = queries.astype("<u8")[rows]
    one, two, four = (np.zeros_like(alive) for _ in range(3))
    for b in range(0, BITS, 2):
        if not len(rows):
            break
        differ = [
            block[b + k][None, :] ^ (np.uint64(0) - ((picked >> np.uint64(b + k)) & np.uint64(1)))[:, None]
            for k in range(2)
        ]
        # Full adder on the lowest counter bit, half adders above. Five is out, so four never
        # overflows: two planes add two at most.
        either = differ[0] ^ differ[1]
        carry = (differ[0] & differ[1]) | (one & either)
        one = one ^ either
        up = two & carry
        two = two ^ carry
        four = four | up
        alive = alive & ~(four & (one | two))
        if b % 8 == 6:
            stays = alive.any(axis=1)
            if not stays.all():
                rows, picked, alive = rows[stays], picked[stays], alive[stays]
                one, two, four = one[stays], two[stays], four[stays]
    return rows, alive


def _same_bucket(queries: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    same = np.zeros((len(queries), -(-len(lanes) // 64) * 64), bool)
    same[:, : len(lanes)] = queries[:, None] == lanes[None, :]
    return np.packbits(same, axis=1, bitorder="little").view("<u8")


def local_groups(buckets: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
    """For each fingerprint, the smallest index that it is linked with inside its bucket.

    buckets: ascending bucket numbers of the fingerprints.
    """
    labels = np.arange(len(fingerprints))
    cuts = range(0, len(fingerprints), LANES)
    sliced = {start: planes(fingerprints[start : start + LANES]) for start in cuts}
    for first, second in itertools.combinations_with_replacement(cuts, 2):
        a, b = buckets[first : first + LANES], buckets[second : second + LANES]
        if a[-1] < b[0]:
            continue
        rows, lanes = within_radius(
            fingerprints[first : first + LANES], sliced[second], _same_bucket(a, b)
        )
        hits = np.unpackbits(lanes.view(np.uint8), axis=1, bitorder="little").astype(bool)
        for row, hit in zip(rows + first, hits, strict=True):
            met = np.unique(labels[np.append(np.flatnonzero(hit) + second, row)])
            for other in met[1:]:
                labels[labels == other] = met[0]
    return labels


_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the buckets of rows that come ordered by bucket."""

    def linked(rows: pa.Table) -> pa.RecordBatch:
        keys = np.stack([rows.column(name).to_numpy() for name in ("part", "key", "x", "y")])
        starts = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))
        points = rows.column("fingerprint").to_numpy()
        buckets, labels = np.cumsum(starts), np.arange(len(points))
        # Runs of whole buckets, about a block of lanes each.
        opens = np.flatnonzero(starts)
        at = 0
        while at < len(points):
            k = np.searchsorted(opens, at + LANES)
            to = int(opens[k]) if k < len(opens) else len(points)
            labels[at:to] = at + local_groups(buckets[at:to], points[at:to].view("<u8"))
            at = to
        moved = labels != np.arange(len(points))
        ends = points[moved], points[labels[moved]]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.maximum(*ends)), pa.array(np.minimum(*ends))], ["a", "b"]
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = pa.Table.from_batches(held)
        last = tuple(rows.column(name)[-1].as_py() for name in ("part", "key", "x", "y"))
        open_rows = np.ones(rows.num_rows, bool)
        for name, value in zip(("part", "key", "x", "y"), last, strict=True):
            open_rows &= rows.column(name).to_numpy() == value
        closed = int(open_rows.argmax())
        if closed:
            yield linked(rows.slice(0, closed))
            held = rows.slice(closed).combine_chunks().to_batches()
    if held:
        yield linked(pa.Table.from_batches(held))


def links(points: DataFrame) -> DataFrame:
    """Links (a, b), a > b, that connect the same distinct fingerprints as all pairs within the
    radius do."""
    spread = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(n).alias("part"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key")
                )
                for n, m in enumerate(_masks())
            )
        )
    )
    entries = points.select("fingerprint", spread.alias("at")).select("fingerprint", "at.*")
    # Counted map-side first, so that a bucket of any size reaches its reducer as a few rows.
    sizes = entries.groupBy("part", "key").count().where("count > 1")
    slices = F.ceil(F.col("count") / SLICE)
    met = entries.join(sizes, ["part", "key"]).select(
        "part", "key", "fingerprint",
        F.pmod(F.xxhash64("fingerprint"), slices).alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), slices - 1)).alias("other"),
    )
    placed = met.select(
        "part", "key", "fingerprint",
        F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
    )
    keys = ["part", "key", "x", "y"]
    return (
        placed.repartition(*keys)
        .sortWithinPartitions(*keys, "fingerprint")
        .mapInArrow(_link_batches, _LINKS)
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), a > b; root is the smallest node of the
    component, and a root's own row is left out."""

    def signature(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = settle(edges, "edges")
    before = signature(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
        large = settle(large.distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        across = large.join(least, "a").where("b > low").select("b", "low")
        edges = settle(across.union(least).toDF("a", "b").distinct(), "small")
        after = signature(edges)
        if after == before:
            break
        before = after
    return edges.toDF("node", "root")


def label(
    fingerprints: DataFrame,
    doc_id: str = "doc_id",
    linked: Callable[[DataFrame], DataFrame] = links,
) -> DataFrame:
    """(fingerprint, component_id, keeper) for each distinct fingerprint of a settled frame.

    component_id is the smallest id that the links reach. keeper is true for one fingerprint of
    each component, one that holds the component's id.
    """
    points = settle(
        fingerprints.groupBy("fingerprint").agg(F.min(doc_id).alias("first")), "points"
    )
    joined = components(linked(points)).toDF("fingerprint", "root")
    rooted = points.join(joined, "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    best = F.min(F.struct(F.col("first").isNull(), "first", "fingerprint"))
    roots = rooted.groupBy("root").agg(best.alias("best"))
    return rooted.join(roots, "root").select(
        "fingerprint",
        F.col("best.first").alias("component_id"),
        (F.col("best.fingerprint") == F.col("fingerprint")).alias("keeper"),
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of docs."""
    marked = settle(
        add_fingerprint(docs.select(doc_id, text), text).select(doc_id, "fingerprint"), "marks"
    )
    labels = label(marked, doc_id).select("fingerprint", "component_id")
    return marked.join(labels, "fingerprint", "left").select(
        doc_id, "fingerprint", "component_id"
    )


def keep_one(
    marked: DataFrame,
    mark: str,
    doc_id: str,
    linked: Callable[[DataFrame], DataFrame] = links,
) -> DataFrame:
    """One row of each component of a settled frame: one with the component's id."""
    labels = label(marked.select(doc_id, F.col(mark).alias("fingerprint")), doc_id, linked)
    keep = labels.where("keeper").select(
        F.col("fingerprint").alias("keep__mark"), F.col("component_id").alias("keep__id")
    )
    here = (F.col(mark) == F.col("keep__mark")) & F.col(doc_id).eqNullSafe(F.col("keep__id"))
    return marked.join(keep, here).dropDuplicates(["keep__mark", "keep__id"])


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: one with the component's id. Columns as they came."""
    mark = "simhash__fingerprint"
    marked = settle(add_fingerprint(docs, text, mark), "marked")
    return keep_one(marked, mark, doc_id).select(*docs.columns)
