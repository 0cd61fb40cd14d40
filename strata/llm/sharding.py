"""Placing rows on shards by a permutation-filled lookup table.

Each shard has a preference order over the slots of a table of prime size: offset, offset + skip,
and so on. The shards take turns; at its turn a shard claims the next slot of its order that is
free, until the table is full. Shares differ by one slot at most, and when a shard comes or goes,
nearly all other slots keep their owner. A row's key is digested to a slot, and the table, whose
size is a parameter and not the data's, says the shard in constant time.

Defined results: rows of equal keys go to the same shard, null keys too (a null is a value of its
own); other columns pass through. With `spread`, a row's digest also takes in a column that splits
hot keys over all shards. No row is moved or dropped: the rows stay where they lie until the
caller writes or repartitions by the shard.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slots of the table at most: a broadcast of about 16 MB.
MOST_SLOTS = 1 << 20
#: Slots for each shard at least; shares then differ by one part in a hundred.
SLOTS_PER_SHARD = 100


def prime_from(least: int) -> int:
    """The smallest prime that isn't below `least`."""

    def is_prime(n: int) -> bool:
        return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))

    while not is_prime(least):
        least += 1
    return least


def _number(text: str) -> int:
    """The first 52 bits of a digest; SQL engines can compute the same."""
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def table_size(shards: list[str], slots: int | None = None) -> int:
    """The number of slots: prime, at least what is asked for."""
    size = prime_from(slots or SLOTS_PER_SHARD * len(shards))
    if not len(shards) <= size <= MOST_SLOTS:
        raise ValueError(f"a table of {size} slots doesn't suit {len(shards)} shards")
    return size


def fill(shards: list[str], slots: int | None = None) -> np.ndarray:
    """The shard's number for each slot. Order of the list doesn't matter to who prefers what,
    only to who takes the first turn."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need names of their own")
    size = table_size(shards, slots)
    offsets = [_number(f"offset:{name}") % size for name in shards]
    skips = [_number(f"skip:{name}") % (size - 1) + 1 for name in shards]
    owner = np.full(size, -1, np.int64)
    at = list(offsets)
    for claim in range(size):
        shard = claim % len(shards)
        while owner[at[shard]] >= 0:
            at[shard] = (at[shard] + skips[shard]) % size
        owner[at[shard]] = shard
    return owner


def slot_of(size: int, *key: Column) -> Column:
    """The key's slot; nulls and empty strings differ."""
    parts = [F.coalesce(F.concat(F.lit("="), part.cast("string")), F.lit("-")) for part in key]
    digest = F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 13)
    return (F.conv(digest, 16, 10).cast("long") % size).cast("int")


def lookup(spark: SparkSession, shards: list[str], slots: int | None = None) -> DataFrame:
    """The table as (slot, shard), at most MOST_SLOTS rows."""
    owner = fill(shards, slots)
    rows = [(slot, shards[number]) for slot, number in enumerate(owner.tolist())]
    return spark.createDataFrame(rows, "slot int, shard string")


def place(
    df: DataFrame,
    key: list[str],
    shards: list[str],
    slots: int | None = None,
    spread: list[str] | None = None,
    into: str = "shard",
) -> DataFrame:
    """Add the columns `into` and `into`_slot. spread: columns that split hot keys."""
    size = table_size(shards, slots)
    slot = f"{into}_slot"
    if {into, slot} & set(df.columns):
        raise ValueError(f"there is a column {into!r} or {slot!r} already")
    table = lookup(df.sparkSession, shards, slots).toDF(slot, into)
    columns = [F.col(f"`{name}`") for name in [*key, *(spread or [])]]
    # At most MOST_SLOTS rows, whatever the data's size.
    return df.withColumn(slot, slot_of(size, *columns)).join(F.broadcast(table), slot)


def write(placed: DataFrame, path: str, into: str = "shard") -> None:
    """Write whole rows below path, a folder a shard.

    Rows travel by shard and slot, so that a task writes to few shards and no shard is one task's.
    """
    ordered = placed.repartitionByRange(F.col(into), F.col(f"{into}_slot"))
    ordered.write.partitionBy(into).parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows below path with the columns of a schema; the shard is the folder's."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
