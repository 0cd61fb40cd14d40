"""Large JSON arrays, read by many tasks.

A file of one array has no line ends to cut it by, so a plain reader needs a task for each file.
Here the bytes are read in the ranges in which Spark cuts text files, up to a comma each, which is
no part of any longer token:

1. Each range is summarised without knowing what came before it: the number of its quotes, modulo
   two, and, for a range that starts outside a string and for one that starts inside, by how much
   brackets raise the depth and at what relative depths there are commas.
2. Running sums over the summaries, in the order of the ranges, give for each range whether it
   starts inside a string, at what depth, and in which range the element began that it starts in.
3. The ranges are read again, and cut at commas of depth one. What lies between two cuts of a range
   is an element; what is left at its ends is put together with the ends of its neighbours. So an
   element may be larger than a range, and only two pieces of a range are ever shuffled.

The elements are written as lines, which any number of tasks can read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Depth of what stands directly in the array.
TOP = 1
_QUOTE, _BACKSLASH, _COMMA = b'"\\,'
_OPENS, _CLOSES = b"[{", b"]}"


class Start(NamedTuple):
    """How a range starts."""

    inside: int
    depth: int
    element: int


def _fragments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files as what stands between commas, with its range, in order within a range."""
    text = spark.read.option("lineSep", ",").text(paths)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"),
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """Parts of ranges as their bytes are in the file; a range's parts follow each other."""
    for batch in batches:
        files, starts, values = (column.to_pylist() for column in batch.columns)
        first = 0
        for n in range(1, len(values) + 1):
            if n == len(values) or starts[n] != starts[first] or files[n] != files[first]:
                yield files[first], starts[first], b"".join(b"," + value for value in values[first:n])
                first = n


class Structure(NamedTuple):
    """Bytes with what they are to the grammar, for a range that starts outside a string."""

    quotes: int
    #: For bytes outside and inside of strings: where, and the change of depth; commas change none.
    outside: tuple[np.ndarray, np.ndarray]
    inside: tuple[np.ndarray, np.ndarray]


def structure(piece: bytes) -> Structure:
    data = np.frombuffer(piece, np.uint8)
    quoted = data == _QUOTE
    slashes = np.flatnonzero(data == _BACKSLASH)
    if len(slashes):
        # A run of backslashes escapes what follows it if the run is odd.
        opens = np.append(True, np.diff(slashes) > 1)
        runs = np.diff(np.append(np.flatnonzero(opens), len(slashes)))
        after = slashes[opens] + runs
        after = after[(runs % 2 == 1) & (after < len(data))]
        quoted[after] = False
    step = np.zeros(len(data), np.int64)
    for char in _OPENS:
        step[data == char] = 1
    for char in _CLOSES:
        step[data == char] = -1
    marks = np.flatnonzero((step != 0) | (data == _COMMA))
    odd = np.cumsum(quoted)[marks] % 2 == 1
    sides = ((marks[~odd], step[marks[~odd]]), (marks[odd], step[marks[odd]]))
    return Structure(int(quoted.sum()), *sides)


_SUMMARY = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("first", T.StringType()),
        T.StructField("quotes", T.LongType()),
        T.StructField("deeper", T.ArrayType(T.LongType())),
        T.StructField("commas", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


def _summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each range; both entries of `deeper` and `commas` count: starts outside, inside."""

    def row(key, first, quotes, deeper, commas):
        columns = [[key[0]], [key[1]], [first], [quotes], [deeper], [[sorted(some) for some in commas]]]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, _SUMMARY.fieldNames())

    key = None
    for file, start, piece in _pieces(batches):
        if (file, start) != key:
            if key:
                yield row(key, first, quotes, deeper, commas)  # noqa: F821
            key, first, quotes, deeper, commas = (file, start), "", 0, [0, 0], [set(), set()]
        if not first:
            zero = b"\0" in piece[:64]
            first = "\0" if zero else piece.lstrip(b", \t\r\n\xef\xbb\xbf")[:1].decode("latin-1")
        found = structure(piece)
        for begins in (0, 1):
            where, step = (found.outside, found.inside)[(quotes + begins) % 2]
            depth = deeper[begins] + np.cumsum(step)
            commas[begins].update(np.unique(depth[step == 0]).tolist())
            deeper[begins] += int(step.sum())
        quotes += found.quotes
    if key:
        yield row(key, first, quotes, deeper, commas)


def starts_of(summaries: DataFrame) -> DataFrame:
    """How each range starts: (file, start, inside, depth, element), and of its file whether it is
    one array: `whole`. element: the start of the last range before it that has a cut."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("file")
    nothing = F.lit(0).cast("long")
    begun = summaries.withColumn("inside", F.coalesce(F.sum("quotes").over(before), nothing) % 2)
    begun = begun.withColumn("deeper", F.get("deeper", F.col("inside").cast("int")))
    begun = begun.withColumn("depth", F.coalesce(F.sum("deeper").over(before), nothing))
    commas = F.get("commas", F.col("inside").cast("int"))
    # The array's own bracket is in the first range, and opens its first element.
    cut = F.array_contains(commas, TOP - F.col("depth")) | (F.col("start") == 0)
    begun = begun.withColumn("cut", F.when(cut, F.col("start")))
    return begun.select(
        "file", "start", "first", "inside", "depth",
        F.coalesce(F.max("cut").over(before), nothing).alias("element"),
        (
            (F.max(F.when(F.col("start") == 0, F.col("first"))).over(every) == "[")
            & (F.sum("deeper").over(every) == 0)
            & (F.sum("quotes").over(every) % 2 == 0)
        ).alias("whole"),
    )


_PIECE = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("element", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)


def cut(fragments: DataFrame, starts: dict[tuple[str, int], Start]) -> DataFrame:
    """Elements, with element null, and pieces of those that ranges divide."""

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = zip(*rows, strict=True) if rows else ((), (), (), ())
        arrays = [pa.array(list(column), kind) for column, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, _PIECE.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for file, start, piece in _pieces(batches):
            if (file, start) != key:
                if key and depth >= TOP:  # noqa: F821
                    yield made([(key[0], element, key[1], _line(held))])  # noqa: F821
                key, held = (file, start), []
                if key not in starts:
                    raise RuntimeError(f"{file} was cut otherwise the first time; read it again.")
                inside, depth, element = starts[key]
                if start == 0:
                    # Nothing stands before a file's first fragment.
                    piece = piece[1:]
            found = structure(piece)
            where, step = found.inside if inside else found.outside
            depths = depth + np.cumsum(step)
            opens = (step == 1) & (depths == TOP)
            ends = ((step == -1) & (depths == TOP - 1)) | ((step == 0) & (depths == TOP))
            rows, at = [], 0
            for place, opening in zip(where[opens | ends].tolist(), opens[opens | ends].tolist(), strict=True):
                held.append(piece[at:place])
                if not opening:
                    # What began in this range is whole; the first cut ends what began before.
                    rows.append((file, None if element == start else element, start, _line(held)))
                held, at, element = [], place + 1, start
            held.append(piece[at:])
            yield made(rows)
            inside = (inside + found.quotes) % 2
            depth += int(step.sum())
        if key and depth >= TOP:
            yield made([(key[0], element, key[1], _line(held))])

    return fragments.mapInArrow(run, _PIECE)


def _line(held: list[bytes]) -> str:
    """JSON on one line: line ends can only stand between its tokens."""
    return b"".join(held).replace(b"\r", b" ").replace(b"\n", b" ").decode("utf-8", "replace")


def as_lines(spark: SparkSession, paths: list[str], folder: str) -> bool:
    """Write the elements of files of one array, and other files whole, as lines below `folder`.

    False, and nothing written, where a file is not in an encoding of single bytes and UTF-8.
    """
    fragments = _fragments(spark, paths)
    summaries = fragments.mapInArrow(_summarised, _SUMMARY)
    # A row for each range, as many as the scan has tasks.
    ranges = starts_of(summaries).collect()
    if any(row.first == "\0" for row in ranges):
        return False
    starts = {(row.file, row.start): Start(row.inside, row.depth, row.element) for row in ranges if row.whole}
    arrays = sorted({row.file for row in ranges if row.whole})
    others = sorted({row.file for row in ranges} - set(arrays))
    if arrays:
        pieces = cut(_fragments(spark, arrays), starts)
        pieces.write.parquet(f"{folder}/pieces")
        pieces = spark.read.schema(_PIECE).parquet(f"{folder}/pieces")
        parts = F.sort_array(F.collect_list(F.struct("place", "text")))
        divided = pieces.where("element IS NOT NULL").groupBy("file", "element").agg(
            F.array_join(F.transform(parts, lambda part: part["text"]), "").alias("text")
        )
        elements = pieces.where("element IS NULL").select("text").union(divided.select("text"))
        elements.where("trim(text) <> ''").write.text(f"{folder}/lines")
    if others:
        whole = spark.read.text(others, wholetext=True)
        line = F.translate("value", "\r\n", "  ")
        whole.select(line.alias("value")).write.mode("append").text(f"{folder}/lines")
    return True
