"""Exact top-k by inner product, with a KD-tree for each shard.

Vectors become whole numbers first, so that scores are exact. Where they lie, they are gathered
into shards of about SHARD_ROWS vectors, and each becomes a KD-tree: the dimension of largest extent is
split at its median, down to leaves of LEAF_ROWS, and every node keeps the tight box of its
vectors. No vector is shuffled for that.

A query's inner product with anything in a box is at most the sum, over dimensions, of the larger
of q x low and q x high. A traversal is best-first: nodes in the order of that bound, until the
bound falls below the kth score. A block of queries traverses a tree together, each query in the nodes
that it still reaches, after its own best leaf. The kth score is propagated: queries meet a first group of shards
(about the root of their number), and what they find there is where all others start from, so
most of those give up near their root.

Queries are packed into blocks, blocks into groups of bounded bytes, and each group meets each shard:
every query against all rows. A task holds a group of queries and meets shard after shard of a
part of them, one at a time; the kth score rises from shard to shard. Copies of queries and of
shards are shuffled, never broadcast: a copy of the queries for each part, one of the shards for each
group, in about equal numbers of rows. Vectors travel in the narrowest type that holds them.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part;
a query meets vectors of its own length only; rows with the query's own id are left out, other
repeated rows count each; of a repeated query id the smallest vector asks. Fewer candidates than
k give fewer rows. Ties go to the smaller id. Scores beyond a long become the last long. Other
columns aren't read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import map_batches, settle

SHARD_ROWS = 8192
#: Bytes of a shard's vectors at most: longer vectors make shards of fewer rows.
SHARD_BYTES = 16 << 20
LEAF_ROWS = 64
BLOCK_QUERIES = 1024
#: Bytes of a group of queries, which a task holds.
GROUP_BYTES = 16 << 20
#: Sums of products below this are exact in doubles.
_EXACT = float(1 << 53)


def whole(vector: Column, scale: int = 1024) -> Column:
    """floor(scale x component) as doubles; null if the vector takes no part."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    valid = (F.size(vector) > 0) & F.forall(
        scaled, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    # From 2^53 on every double is whole, and floor(), which gives a long, might clip it.
    floors = F.transform(
        scaled, lambda x: F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x)
    )
    return F.when(F.coalesce(valid, F.lit(False)), floors)


class Tree:
    """A KD-tree in arrays: node n has the vectors first[n] to last[n], children 2n+1 and 2n+2."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS) -> None:
        depth = max(0, math.ceil(math.log2(max(1, len(ids)) / leaf)))
        nodes = 2 ** (depth + 1) - 1
        self.first, self.last = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        self.low = np.full((nodes, vectors.shape[1]), np.inf)
        self.high = np.full((nodes, vectors.shape[1]), -np.inf)
        order = np.arange(len(ids))
        self.last[0] = len(ids)
        for node in range(nodes):
            start, stop = self.first[node], self.last[node]
            mine = order[start:stop]
            self.low[node] = vectors[mine].min(axis=0)
            self.high[node] = vectors[mine].max(axis=0)
            if 2 * node + 2 < nodes:
                middle = (stop - start) // 2
                widest = int((self.high[node] - self.low[node]).argmax())
                order[start:stop] = mine[np.argpartition(vectors[mine, widest], middle)]
                for child, (a, b) in ((1, (start, start + middle)), (2, (start + middle, stop))):
                    self.first[2 * node + child], self.last[2 * node + child] = a, b
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, the most that an inner product can be."""
        most = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        if not _exact(queries, self.vectors):  # room for what sums in doubles may lose
            sizes = np.maximum(np.abs(self.low), np.abs(self.high))
            most += np.abs(queries) @ sizes.T * 1e-12
        return most

    def search(
        self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int
    ) -> Iterator[tuple[int, int, int]]:
        """(query_id, vec_id, score) of each query's k best here whose score is its floor or more.

        Floors rise to the kth scores found."""
        together = self._search_block if _exact(queries, self.vectors) else self._search_each
        yield from together(query_ids, queries, floors, k)

    def _search_block(
        self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int
    ) -> Iterator[tuple[int, int, int]]:
        """All queries at once, by matrix products that doubles hold exactly."""
        bounds, inner = self.bounds(queries), len(self.first) // 2
        scores_of = np.full((len(queries), k), -np.inf)
        ids_of = np.full((len(queries), k), np.iinfo(np.int64).max)

        def meet(rows: np.ndarray, leaf: int) -> None:
            here = slice(self.first[leaf], self.last[leaf])
            scores = queries[rows] @ self.vectors[here].T
            scores[(scores < floors[rows, None]) | (self.ids[here] == query_ids[rows, None])] = -np.inf
            hit = scores.max(axis=1) > -np.inf
            rows, scores = rows[hit], np.concatenate([scores_of[rows[hit]], scores[hit]], axis=1)
            theirs = np.broadcast_to(self.ids[here], (len(rows), scores.shape[1] - k))
            ids = np.concatenate([ids_of[rows], theirs], axis=1)
            best = np.lexsort((ids, -scores), axis=-1)[:, :k]
            scores_of[rows] = np.take_along_axis(scores, best, axis=1)
            ids_of[rows] = np.take_along_axis(ids, best, axis=1)
            floors[rows] = np.maximum(floors[rows], scores_of[rows, -1])

        own = inner + bounds[:, inner:].argmax(axis=1)
        for leaf in np.unique(own).tolist():
            rows = np.flatnonzero((own == leaf) & (bounds[:, leaf] >= floors))
            if len(rows):
                meet(rows, leaf)
        queue = [(-bounds[:, 0].max(initial=-np.inf), 0)]
        while queue:
            _, node = heapq.heappop(queue)
            rows = np.flatnonzero(bounds[:, node] >= floors)
            if node >= inner:
                rows = rows[own[rows] != node]
                if len(rows):
                    meet(rows, node)
            elif len(rows):
                for child in (2 * node + 1, 2 * node + 2):
                    heapq.heappush(queue, (-bounds[rows, child].max(), child))
        row, place = np.nonzero(scores_of > -np.inf)
        found = query_ids[row], ids_of[row, place], scores_of[row, place].astype(np.int64)
        yield from zip(*(x.tolist() for x in found), strict=True)

    def _search_each(
        self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int
    ) -> Iterator[tuple[int, int, int]]:
        """One query after the other, for scores that doubles don't hold."""
        products, bounds = _products(queries, self.vectors), self.bounds(queries)
        inner = len(self.first) // 2
        for n, query_id in enumerate(query_ids.tolist()):
            bound, kth = bounds[n], floors[n]
            best: list[tuple] = []
            queue = [(-bound[0], 0)]
            while queue and -queue[0][0] >= kth:
                _, node = heapq.heappop(queue)
                if node < inner:
                    for child in (2 * node + 1, 2 * node + 2):
                        if bound[child] >= kth:
                            heapq.heappush(queue, (-bound[child], child))
                    continue
                first, last = self.first[node], self.last[node]
                scores = products(n, first, last)
                for place in np.flatnonzero(scores >= kth).tolist():
                    vec_id = int(self.ids[first + place])
                    if vec_id == query_id:
                        continue
                    # The worst stands first: lowest score, then largest id.
                    entry = (int(scores[place]), -vec_id)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                if len(best) == k:
                    kth = max(kth, best[0][0])
            if len(best) == k and abs(kth) < _EXACT:
                floors[n] = kth
            for score, vec_id in best:
                yield query_id, -vec_id, score


def _exact(queries: np.ndarray, vectors: np.ndarray) -> bool:
    """Whether doubles hold every sum of products exactly."""
    most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0)
    return most * vectors.shape[1] < _EXACT


def _products(queries: np.ndarray, vectors: np.ndarray) -> Callable[[int, int, int], np.ndarray]:
    """Exact inner products of query n with a run of vectors, in doubles where they hold every
    sum, else in whole numbers of any size, then clipped to longs."""
    if _exact(queries, vectors):
        return lambda n, first, last: vectors[first:last] @ queries[n]
    large = np.frompyfunc(int, 1, 1)
    q, v = large(queries), large(vectors)
    return lambda n, first, last: np.clip(v[first:last] @ q[n], -(2**63), 2**63 - 1)


def _narrow(vectors: np.ndarray) -> bytes:
    """Whole numbers in the narrowest type that holds them."""
    most = np.abs(vectors).max(initial=0)
    kind = next((kind for kind in ("<i2", "<i4") if most <= np.iinfo(kind).max), "<f8")
    return vectors.astype(kind).tobytes()


def _wide(packed: bytes, rows: int, dim: int) -> np.ndarray:
    kind = {2: "<i2", 4: "<i4", 8: "<f8"}[len(packed) // (rows * dim)]
    return np.frombuffer(packed, kind).reshape(rows, dim).astype(np.float64)


_PACKED = T.StructType(
    [
        T.StructField("dim", T.IntegerType(), False),
        T.StructField("ids", T.BinaryType(), False),
        T.StructField("vectors", T.BinaryType(), False),
    ]
)


def _packed(df: DataFrame, rows: int) -> DataFrame:
    """(vec_id, v) of df, rows of a length together, `rows` at most, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def full(dim: int) -> pa.RecordBatch:
            ids, vectors = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([dim], pa.int32()),
                    *(pa.array([x], pa.binary()) for x in (ids.tobytes(), _narrow(vectors))),
                ],
                _PACKED.fieldNames(),
            )

        for batch in batches:
            ids, listed = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            sizes = listed.value_lengths().to_numpy(zero_copy_only=False)
            flat = listed.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for dim in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == dim)
                most = max(1, min(rows, SHARD_BYTES // (8 * dim)))
                for at in range(0, len(mine), most):
                    some = mine[at : at + most]
                    vectors = flat[(ends[some] - dim)[:, None] + np.arange(dim)]
                    held.setdefault(dim, []).append((ids[some], vectors))
                    if sum(len(x) for x, _ in held[dim]) >= most:
                        yield full(dim)
        for dim in list(held):
            yield full(dim)

    return df.select("vec_id", "v").mapInArrow(run, _PACKED)


_FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("query_id", "vec_id", "score")])


#: What a task meets, in this order: the blocks of a group of queries, then shards, without floors.
_MET = ["dim", "group", "part", "shards"]


def _searched(met: DataFrame, k: int) -> DataFrame:
    """The best of every pair of a shard and a block of queries that have dim, group and part in
    common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple = ()
        asking: list[tuple[np.ndarray, bytes, np.ndarray]] = []
        for batch in batches:
            for row in batch.to_pylist():
                if key != (key := (row["dim"], row["group"], row["part"])):
                    asking = []
                ids = np.frombuffer(row["ids"], np.int64)
                if row["floors"] is not None:
                    asking.append((ids, row["vectors"], np.frombuffer(row["floors"]).copy()))
                    continue
                tree = Tree(ids, _wide(row["vectors"], len(ids), row["dim"])) if asking else None
                for q_ids, packed, floors in asking:
                    found = list(tree.search(q_ids, _wide(packed, len(q_ids), row["dim"]), floors, k))
                    columns = zip(*found, strict=True) if found else ((), (), ())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in columns], _FOUND.fieldNames()
                    )

    return map_batches(met, run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _blocks(queries: DataFrame, count: int) -> DataFrame:
    """Queries (vec_id, v, floor) as (block, dim, ids, vectors, floors)."""
    parts = max(1, math.ceil(count / BLOCK_QUERIES))
    numbered = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(parts)))
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("dim", T.IntegerType())]
        + [T.StructField(n, T.BinaryType()) for n in ("ids", "vectors", "floors")]
    )

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        vectors = np.array(rows.column("v").to_pylist(), np.float64)
        return pa.table(
            {
                "block": pa.array([key[0].as_py()], pa.int64()),
                "dim": pa.array([vectors.shape[1]], pa.int32()),
                "ids": pa.array([rows.column("vec_id").to_numpy().tobytes()], pa.binary()),
                "vectors": pa.array([_narrow(vectors)], pa.binary()),
                "floors": pa.array([rows.column("floor").to_numpy().tobytes()], pa.binary()),
            }
        )

    return numbered.withColumn("dim", F.size("v")).groupBy("block", "dim").applyInArrow(pack, schema)


def _dealt(shards: DataFrame, blocks: DataFrame, groups: int, parts: int) -> DataFrame:
    """Each shard for each group of blocks and each block for each part of the shards, as rows that
    meet."""

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    asking = blocks.select(
        "dim", F.pmod("block", F.lit(groups)).cast("int").alias("group"), each(parts).alias("part"),
        F.lit(False).alias("shards"), "ids", "vectors", "floors",
    )
    asked = shards.select(
        "dim", each(groups).alias("group"), F.pmod("shard", F.lit(parts)).cast("int").alias("part"),
        F.lit(True).alias("shards"), "ids", "vectors", F.lit(None).cast("binary").alias("floors"),
    )
    # A count of its own, as what is read says little about the work on it.
    met = asking.unionByName(asked).repartition(groups * parts, *_MET[:3])
    return met.sortWithinPartitions(*_MET)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its k best among vectors."""

    def numbers(df: DataFrame) -> DataFrame:
        made = df.select(F.col(vec_id).alias("vec_id"), whole(F.col(vector)).alias("v"))
        return made.where("v IS NOT NULL AND vec_id IS NOT NULL")

    packed = settle(_packed(numbers(vectors), SHARD_ROWS), "shards")
    count, n_vectors = packed.agg(F.count("*"), F.sum(F.length("ids") / 8)).first()
    # Named by content, so that a lost task's shards get their names again.
    named = packed.select("dim", F.xxhash64("ids", "vectors").alias("shard"), "ids", "vectors")
    asking = settle(numbers(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    n_queries = asking.count()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def met(shards: DataFrame, share: float, floored: DataFrame, name: str) -> DataFrame:
        blocks = settle(_blocks(floored, n_queries), f"blocks-{name}")
        held = blocks.agg(F.sum(F.length("vectors"))).first()[0] or 0
        groups = max(1, math.ceil(held / GROUP_BYTES))
        # As many copies of queries as of vectors, or more where that gives too few tasks.
        even = math.ceil(groups * share * (n_vectors or 0) / max(1, n_queries))
        parts = max(1, min(math.ceil(share * count), max(even, math.ceil(tasks / groups))))
        found = _searched(_dealt(shards, blocks, groups, parts), k)
        return settle(_best(found, k), f"found-{name}")

    # The first group: about the root of the shards' number, chosen by their digest.
    share = 1.0 if count < 4 else math.sqrt(count) / count
    early = F.pmod(F.col("shard"), F.lit(1 << 20)) < int(share * (1 << 20))
    lowest = F.lit(float("-inf"))
    first = met(named.where(early), share, asking.withColumn("floor", lowest), "first")
    kth = first.where(F.col("rank") == k).select("vec_id", "query_id", "score")
    kth = kth.select(F.col("query_id").alias("asked"), F.col("score").cast("double").alias("kth"))
    # A long that doubles can't hold exactly starts from just below.
    exact = F.when(F.abs("kth") < _EXACT, F.col("kth")).otherwise(F.col("kth") - F.abs("kth") * 1e-15)
    floored = asking.join(kth, F.col("vec_id") == F.col("asked"), "left").select(
        "vec_id", "v", F.coalesce(exact, lowest).alias("floor")
    )
    rest = met(named.where(~early), 1.0, floored, "rest")
    columns = ["query_id", "vec_id", "score"]
    return _best(first.select(columns).union(rest.select(columns)), k).select(
        "query_id", "rank", "vec_id", "score"
    )
