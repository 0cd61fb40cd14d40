"""Hard negatives by inner product, found by pruning on coordinates.

For each anchor: its best rows of the same label (positives), and for each of those the best rows
of other labels whose score lies in a band below the positive's (hard negatives).

1. Vectors become whole numbers, so that scores are exact, and are dealt by length, longest first,
   into buckets of about BUCKET_ROWS rows.
2. A bucket holds, for each coordinate, its unit vectors' values as a sorted list. The score that
   an anchor must reach, over its own length and the bucket's longest, is a cosine that a row must
   have: above 1 the whole bucket is out. Else the cosine leaves a range of values feasible on each
   coordinate. An anchor takes the FOCUS coordinates in which it is largest, cuts the shortest of
   their ranges out of its list, and intersects it with the others. What is left is verified
   exactly.
3. The score to reach is propagated: anchors meet a first group of the longest buckets, and what
   they find there is the least that all others must offer. A block of anchors travels only to
   buckets that are long enough for one of them.

Blocks of anchors meet buckets: every anchor against all rows. A task holds a bucket and a block
at a time. In many dimensions, and for a small cosine, ranges prune little; results are exact all
the same.

Defined results: rows whose id, label or vector is null, or whose vector is empty or holds null or
non-finite components, take no part. An anchor meets vectors of its own length only, and no row
with its id; other repeated rows count each. Of a repeated anchor the smallest label and vector
ask. Ties go to the smaller id. A positive of negative score has no band. Fewer rows than asked
for give fewer. Scores beyond a long become the last long. Other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import settle
from strata.llm.kdtree import whole

SCALE = 256
BUCKET_ROWS = 8192
#: Bytes of a bucket's vectors at most: longer vectors make buckets of fewer rows.
BUCKET_BYTES = 16 << 20
BLOCK_ANCHORS = 1024
FOCUS = 5
#: Sums of products below this are exact in doubles.
_EXACT = 1 << 53
_LEAST, _MOST = -(2**63), 2**63 - 1
#: What rounding may take from a cosine or a coordinate of a unit vector.
_SLACK = 1e-9


class Bucket:
    """Vectors of about one length, with sorted lists of their coordinates."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        lengths = _lengths(vectors)
        self.longest = float(lengths.max(initial=0.0))
        self._units = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
        self._most = np.abs(vectors).max(initial=0)
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._large: np.ndarray | None = None

    def _sorted(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        if coordinate not in self._lists:
            order = np.argsort(self._units[:, coordinate], kind="stable")
            self._lists[coordinate] = order, self._units[order, coordinate]
        return self._lists[coordinate]

    def candidates(self, anchor: np.ndarray, length: float, least: int) -> np.ndarray | None:
        """Rows whose focus coordinates leave a score of `least` feasible; None: all rows."""
        if least <= 0 or length == 0:
            return None
        cosine = least / (length * self.longest) - _SLACK if self.longest else math.inf
        if cosine > 1:
            return np.empty(0, np.int64)
        if cosine <= 0:
            return None
        unit = anchor / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        own, around = np.arccos(np.clip(unit[focus], -1, 1)), math.acos(cosine)
        low = np.cos(np.minimum(own + around, math.pi)) - _SLACK
        high = np.cos(np.maximum(own - around, 0)) + _SLACK
        cuts = []
        for coordinate, a, b in zip(focus.tolist(), low, high, strict=True):
            values = self._sorted(coordinate)[1]
            cuts.append((np.searchsorted(values, a), np.searchsorted(values, b, "right")))
        shortest = min(range(len(cuts)), key=lambda n: cuts[n][1] - cuts[n][0])
        first, last = cuts[shortest]
        if 2 * (last - first) > len(self.ids):
            return None
        rows = self._sorted(int(focus[shortest]))[0][first:last]
        for n, coordinate in enumerate(focus.tolist()):
            if n != shortest:
                values = self._units[rows, coordinate]
                rows = rows[(values >= low[n]) & (values <= high[n])]
        return rows

    def scores(self, anchor: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Exact inner products as longs."""
        if self._most * np.abs(anchor).max(initial=0) * len(anchor) < _EXACT:
            vectors = self.vectors if rows is None else self.vectors[rows]
            return (vectors @ anchor).astype(np.int64)
        if self._large is None:
            self._large = np.frompyfunc(int, 1, 1)(self.vectors)
        large = self._large if rows is None else self._large[rows]
        sums = large @ np.frompyfunc(int, 1, 1)(anchor)
        return np.array([min(max(x, _LEAST), _MOST) for x in sums.tolist()], np.int64)

    def best(
        self, anchor_id: int, label: int, anchor: np.ndarray, bands: list[tuple[int, int, int]], same: bool, k: int
    ) -> Iterator[tuple[int, int, int]]:
        """(key, vec_id, score) of the k best rows in each band (key, lowest, highest score)."""
        length = float(_lengths(anchor[None, :])[0])
        rows = self.candidates(anchor, length, min(low for _, low, _ in bands))
        scores = self.scores(anchor, rows)
        ids = self.ids if rows is None else self.ids[rows]
        labels = self.labels if rows is None else self.labels[rows]
        wanted = ((labels == label) == same) & (ids != anchor_id)
        ids, scores = ids[wanted], scores[wanted]
        for key, low, high in bands:
            found = np.flatnonzero((scores >= low) & (scores <= high))
            if len(found) > k:
                kth = np.partition(scores[found], len(found) - k)[len(found) - k]
                found = found[scores[found] >= kth]
            # Complements fall as scores rise, and don't overflow as negations may.
            order = np.lexsort((ids[found], ~scores[found]))
            for place in found[order[:k]].tolist():
                yield key, int(ids[place]), int(scores[place])


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Lengths, also where squares would overflow."""
    most = np.abs(vectors).max(axis=1, initial=0)
    scaled = vectors / np.where(most > 0, most, 1.0)[:, None]
    return most * np.sqrt((scaled * scaled).sum(axis=1))


def _numbers(df: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    made = df.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        whole(F.col(vector), SCALE).alias("v"),
    )
    return made.where("v IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL")


def _length(v: str) -> Column:
    """The same of an array, infinite where squares overflow: it only deals rows and anchors."""
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x))


def _small(vectors: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in as few bytes as hold them."""
    most = np.abs(vectors).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
    return kind, vectors.astype(kind).tobytes()


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


_BUCKET = _fields(
    bucket=T.IntegerType(), dim=T.IntegerType(), longest=T.DoubleType(), ids=T.BinaryType(),
    labels=T.BinaryType(), kind=T.StringType(), vectors=T.BinaryType(),
)
_BLOCK = _fields(
    dim=T.IntegerType(), need=T.DoubleType(), a_ids=T.BinaryType(), a_labels=T.BinaryType(),
    a_vectors=T.BinaryType(), a_ends=T.BinaryType(), bands=T.BinaryType(),
)
_FOUND = _fields(
    anchor_id=T.LongType(), key=T.LongType(), vec_id=T.LongType(), score=T.LongType()
)


def _batch(schema: T.StructType, rows: list[tuple]) -> pa.RecordBatch:
    """Rows as Arrow; Spark casts them to the stated schema's names and types."""
    kinds = {
        T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.DoubleType: pa.float64(),
        T.BinaryType: pa.binary(), T.StringType: pa.string(),
    }
    columns = zip(*rows, strict=True) if rows else ([] for _ in schema)
    arrays = [pa.array(list(c), kinds[type(f.dataType)]) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema.fieldNames())


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _by_dim(batch: pa.RecordBatch, most: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of equally long vectors, `most` rows each at most."""
    sizes = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes).tolist():
        mine = batch.take(pa.array(np.flatnonzero(sizes == dim)))
        rows = max(1, min(most, BUCKET_BYTES // (8 * dim)))
        for at in range(0, mine.num_rows, rows):
            yield dim, mine.slice(at, rows)


def buckets(rows: DataFrame, count: int) -> DataFrame:
    """(vec_id, label, v) dealt by length: bucket 0 has the longest."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch, BUCKET_ROWS) if batch.num_rows else ():
                vectors = _vectors(part.column("v"), dim)
                ids, labels = (part.column(c).to_numpy() for c in ("vec_id", "label"))
                kind, held = _small(vectors)
                longest = float(_lengths(vectors).max())
                number = part.column("bucket")[0].as_py()
                row = number, dim, longest, ids.tobytes(), labels.tobytes(), kind, held
                yield _batch(_BUCKET, [row])

    # The id's digest splits vectors of one length, of which there can be any number.
    dealt = rows.withColumn("length", _length("v")).repartitionByRange(
        max(1, -(-count // BUCKET_ROWS)), F.desc("length"), F.xxhash64("vec_id")
    )
    numbered = dealt.sortWithinPartitions(F.desc("length"), F.xxhash64("vec_id"), "label", "v")
    return numbered.select(F.spark_partition_id().alias("bucket"), "vec_id", "label", "v").mapInArrow(
        pack, _BUCKET
    )


def _blocks(asking: DataFrame, count: int) -> DataFrame:
    """Anchors (vec_id, label, v, bands) with bands (key, low, high), those of like need together.

    need: the length that a row must have for the lowest band of any anchor of the block.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch, BLOCK_ANCHORS) if batch.num_rows else ():
                vectors, listed = _vectors(part.column("v"), dim), part.column("bands")
                ids, labels = (part.column(c).to_numpy() for c in ("vec_id", "label"))
                flat = listed.flatten()
                bands = np.stack([flat.field(n).to_numpy() for n in range(3)], axis=1)
                ends = np.cumsum(listed.value_lengths().to_numpy())
                need = min(part.column("need").to_pylist())
                row = (dim, need, ids.tobytes(), labels.tobytes(), vectors.tobytes(),
                       ends.astype("<i8").tobytes(), bands.astype("<i8").tobytes())
                yield _batch(_BLOCK, [row])

    lowest = F.array_min(F.transform("bands", lambda band: band["low"])).cast("double")
    need = F.when((lowest > 0) & (F.col("length") > 0), lowest / F.col("length")).otherwise(0.0)
    needed = asking.withColumn("length", _length("v")).withColumn("need", need * (1 - _SLACK))
    dealt = needed.repartitionByRange(max(1, -(-count // BLOCK_ANCHORS)), "need", F.xxhash64("vec_id"))
    return dealt.select("vec_id", "label", "v", "bands", "need").mapInArrow(pack, _BLOCK)


def _searched(pairs: DataFrame, same: bool, k: int) -> DataFrame:
    """The k best of every band of every pair of a bucket and a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, built = None, None
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n].as_py() for name in batch.schema.names}
                dim = row["dim"]
                if built != row["part"]:
                    vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, dim)
                    ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
                    bucket, built = Bucket(ids, labels, vectors.astype(np.float64)), row["part"]
                ids, labels, ends = (np.frombuffer(row[c], "<i8") for c in ("a_ids", "a_labels", "a_ends"))
                anchors = np.frombuffer(row["a_vectors"]).reshape(-1, dim)
                bands = np.frombuffer(row["bands"], "<i8").reshape(-1, 3).tolist()
                starts = np.append(0, ends[:-1])
                found = [
                    (anchor_id, *hit)
                    for anchor_id, label, anchor, a, b in zip(
                        ids.tolist(), labels.tolist(), anchors, starts.tolist(), ends.tolist(), strict=True
                    )
                    for hit in bucket.best(anchor_id, label, anchor, bands[a:b], same, k)
                ]
                yield _batch(_FOUND, found)

    return pairs.mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(held: DataFrame, asking: DataFrame, same: bool, k: int, name: str) -> DataFrame:
    """(anchor_id, key, vec_id, score, rank): the k best rows of every band of every anchor.

    held: settled buckets; asking: settled anchors (vec_id, label, v, bands).
    """
    last = held.agg(F.max("bucket")).first()[0]
    count = asking.count()
    columns = ["anchor_id", "key", "vec_id", "score"]
    if last is None or not count:
        return asking.sparkSession.createDataFrame([], T.StructType([*_FOUND, T.StructField("rank", T.IntegerType())]))

    def met(asks: DataFrame, first: int, to: int, wave: str) -> DataFrame:
        blocks = settle(_blocks(asks, count), f"blocks-{name}-{wave}")
        blocks = blocks.withColumn("block", F.xxhash64("a_ids", "a_vectors", "bands"))
        # What decides goes ahead; anchors and vectors follow only for pairs that may count.
        light = blocks.select("block", "dim", "need").withColumn(
            "bucket", F.explode(F.sequence(F.lit(first), F.lit(to)))
        )
        known = held.select("bucket", "dim", "longest", "part")
        pairs = light.join(known, ["bucket", "dim"]).where("need <= longest")
        full = pairs.select("block", "part").join(blocks.drop("dim", "need"), "block")
        pairs = full.join(held.drop("bucket", "longest"), "part")
        return settle(_ranked(_searched(pairs, same, k), k), f"{name}-{wave}")

    early = math.isqrt(last)
    first = met(asking, 0, early, "first")
    if early == last:
        return first
    kth = first.where(F.col("rank") == k).select(
        F.col("anchor_id").alias("vec_id"), F.struct("key", "score").alias("kth")
    )
    kth = kth.groupBy("vec_id").agg(F.map_from_entries(F.collect_list("kth")).alias("kth"))
    floors = F.transform(
        "bands",
        lambda band: F.struct(
            band["key"].alias("key"),
            F.greatest(band["low"], F.element_at("kth", band["key"])).alias("low"),
            band["high"].alias("high"),
        ),
    )
    raised = asking.join(kth, "vec_id", "left").select("vec_id", "label", "v", floors.alias("bands"))
    rest = met(raised, early + 1, last, "rest")
    return _ranked(first.select(columns).union(rest.select(columns)), k)


def mine(
    vectors: DataFrame,
    anchors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    least: Fraction = Fraction(30, 100),
    most: Fraction = Fraction(90, 100),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A negative's score is at least `least` and at most `most` times its positive's.
    """
    if not 0 <= least < most:
        raise ValueError("A band needs 0 <= least < most.")
    rows = _numbers(vectors, vec_id, vector, label)
    held = settle(buckets(rows, rows.count()), "buckets")
    # Named by content, so that a name outlives a lost task.
    held = held.withColumn("part", F.xxhash64("ids", "labels", "vectors", "dim"))
    asked = _numbers(anchors, vec_id, vector, label).groupBy("vec_id")
    asking = settle(asked.agg(F.min(F.struct("label", "v")).alias("a")).select("vec_id", "a.*"), "anchors")
    wide = F.array(F.struct(F.lit(0).cast("long").alias("key"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high")))
    near = _search(held, asking.withColumn("bands", wide), True, positives, "positives")
    near = settle(
        near.select(
            "anchor_id", F.col("rank").cast("long").alias("key"),
            F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        ),
        "positives",
    )

    def share(of: Fraction, more: int) -> Column:
        product = f"CAST(positive_score AS DECIMAL(19, 0)) * {of.numerator}BD + {more}BD"
        return F.expr(f"({product}) div {of.denominator}BD")

    bands = near.where("positive_score >= 0").select(
        F.col("anchor_id").alias("vec_id"),
        F.struct(
            "key",
            share(least, least.denominator - 1).alias("low"),
            share(most, 0).alias("high"),
        ).alias("band"),
    )
    bands = bands.groupBy("vec_id").agg(F.sort_array(F.collect_list("band")).alias("bands"))
    found = _search(held, settle(asking.join(bands, "vec_id"), "bands"), False, negatives, "negatives")
    return found.join(near, ["anchor_id", "key"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
