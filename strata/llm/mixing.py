"""Mixing sources to target weights by Pareto order sampling.

Targets: the weights share a budget of words; a target stops at MOST_COPIES times its source's
size and the excess is shared anew by weight until none is above. That is a water level: the
target is the smaller of the limit and weight x level.

Copies: within a source, a document's expected copies grow with its merit (one more for each
doubling of its size, so probabilities are unequal), again up to MOST_COPIES, and again a water
level, found over the classes of equal merit. The whole part is allocated as certain copies. The
rest, pi, is an inclusion probability: each document draws a uniform u, ranks by

    q = (u / (1 - u)) / (pi / (1 - pi))

and the smallest q of a source are taken. The sample has a fixed size, counted in words: documents
enter in the order of q while they fit the words that are left, and the last place goes to the
document whose size is nearest to what remains. Documents stay whole.

No document is sorted against all others: q becomes one of BINS bins, words are summed by source
and bin, and only the bin in which a source's words run out is ordered. A hot source's sums are
made map-side. The draw is a digest of seed and id, so reruns agree.

Defined results: a null text has size 0 and is never taken; a null source is a source, the last
one; rows that share source, id and size are taken or left together. Other columns pass through.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
BINS = 1 << 16
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """Uniform in (0, 1), from the first 52 bits of a digest; never 0 or 1."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    whole = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (whole.cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, source_size, target) from (source, size): one row for each source.

    The windows without a partition see one row for each source, not one for each document.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.lit(None)
    for n, value in enumerate(weights):
        weight = F.when(rank % len(weights) == n, value).otherwise(weight)
    limit = F.col("source_size") * MOST_COPIES
    ranked = sources.select("source", "source_size", weight.cast("double").alias("weight"))
    ranked = ranked.withColumn("limit", limit.cast("double"))
    # Sources reach their limits in the order of limit / weight: those before a source are full
    # when it is, so the level that it would see follows from the sums on either side.
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole) * share
    level = (budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = ranked.withColumn("level", level)
    full = F.col("limit") <= F.col("weight") * F.col("level")
    # The level of the first source that isn't full holds for all of those.
    common = F.min(F.when(~full, F.struct(F.col("limit") / F.col("weight"), "source", "level"))).over(whole)
    return levelled.select(
        "source",
        "source_size",
        F.when(full, F.col("limit")).otherwise(F.col("weight") * common["level"]).alias("target"),
    )


def merit(size: Column) -> Column:
    """One more for each doubling of the size, a whole number."""
    return F.length(F.bin(size)).cast("long")


def _copies(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, merit, target, source_size, certain, pi) for each source and class of merit."""
    classes = sizes.groupBy("source", merit(F.col("size")).alias("merit")).agg(
        F.sum("size").alias("words")
    )
    known = sources.select(F.col("source").alias("its"), "source_size", "target")
    classes = classes.join(known, F.col("source").eqNullSafe(F.col("its"))).drop("its")
    # Higher merit reaches MOST_COPIES first; 64 classes at most in a window.
    order = Window.partitionBy("source").orderBy(F.col("merit").desc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source")
    words, mass = F.col("words").cast("double"), (F.col("words") * F.col("merit")).cast("double")
    full_before = F.coalesce(F.sum(words).over(before), F.lit(0.0)) * MOST_COPIES
    mass_left = F.sum(mass).over(whole) - F.coalesce(F.sum(mass).over(before), F.lit(0.0))
    level = F.when(mass_left > 0, (F.col("target") - full_before) / mass_left)
    levelled = classes.withColumn("level", level)
    full = F.coalesce(F.col("merit") * F.col("level") >= MOST_COPIES, F.lit(False))
    common = F.max(F.when(~full, F.struct("merit", "level"))).over(whole)
    expected = F.when(full, float(MOST_COPIES)).otherwise(
        F.least(F.coalesce(F.col("merit") * common["level"], F.lit(0.0)), F.lit(float(MOST_COPIES)))
    )
    expected = F.greatest(expected, F.lit(0.0))
    return levelled.withColumn("expected", expected).select(
        "source", "source_size", "target", "merit", "words",
        F.floor("expected").alias("certain"),
        (F.col("expected") - F.floor("expected")).alias("pi"),
    )


def _matched(df: DataFrame, small: DataFrame, how: str = "inner") -> DataFrame:
    """df joined with a table of sources, null matching null; the table's source goes."""
    renamed = small.withColumnRenamed("source", "its_source")
    return df.join(renamed, F.col("source").eqNullSafe(F.col("its_source")), how).drop("its_source")


def _placed(sized: DataFrame, classes: DataFrame) -> DataFrame:
    """sized with what its class says, the rank q (null: not drawn) and q's bin."""
    its = classes.withColumnsRenamed({"source": "its_source", "merit": "its_merit"})
    here = F.col("source").eqNullSafe(F.col("its_source")) & (
        merit(F.col("size")) == F.col("its_merit")
    )
    u, pi = draw(F.col("doc_id")), F.col("pi")
    q = F.when((pi > 0) & (F.col("size") > 0), (u / (1 - u)) / (pi / (1 - pi)))
    joined = sized.join(its, here).drop("its_source", "its_merit").withColumn("q", q)
    return joined.withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * BINS).cast("int"))


def _cuts(drawn: DataFrame) -> DataFrame:
    """(source, cut_bin, last, gap) for each source whose words run out: the bin where they do,
    the last unit taken there and the words that are left after it."""
    bins = drawn.groupBy("source", "bin").agg(
        F.sum("size").alias("words"), F.max("left").alias("left")
    )
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    first = F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("before")))
    cuts = settle(
        bins.withColumn("upto", upto).where("upto > left").groupBy("source").agg(first.alias("cut"))
        .select("source", F.col("cut.bin").alias("cut_bin"), F.col("cut.before").alias("before")),
        "cuts",
    )
    # Rows that share source, id and size are one unit.
    units = (
        _matched(drawn, cuts).where("bin = cut_bin")
        .groupBy("source", "cut_bin", "before", "left", "q", "doc_id", "size")
        .agg(F.sum("size").alias("words"))
    )
    order = Window.partitionBy("source").orderBy("q", "doc_id", "size")
    taken = units.withColumn("upto", F.col("before") + F.sum("words").over(order))
    fits = F.col("upto") <= F.col("left")
    spent = F.when(fits, F.col("upto")).otherwise(F.col("before"))
    return taken.groupBy("source", "cut_bin").agg(
        F.max(F.when(fits, F.struct("q", "doc_id", "size"))).alias("last"),
        F.min(F.col("left") - spent).alias("gap"),
    )


def _inside(placed: DataFrame, cuts: DataFrame) -> DataFrame:
    """placed with gap and inside: whether the order of q takes the row."""
    reached = F.coalesce(F.struct("q", "doc_id", "size") <= F.col("last"), F.lit(False))
    early = F.col("cut_bin").isNull() | (F.col("bin") < F.col("cut_bin"))
    inside = early | ((F.col("bin") == F.col("cut_bin")) & reached)
    return _matched(placed, cuts, "left").withColumn("inside", F.col("q").isNotNull() & inside)


class Mix(NamedTuple):
    """What decides about documents: small tables by source, written to the shared folder."""

    classes: DataFrame
    cuts: DataFrame
    fillers: DataFrame


def prepare(sized: DataFrame) -> tuple[DataFrame, Mix]:
    """sized (doc_id, source, size) placed, and the tables that decide."""
    sources = settle(targets(sized), "targets")
    classes = settle(_copies(sized, sources), "classes")
    left = classes.groupBy("source").agg(
        (F.max("target") - F.sum(F.col("certain") * F.col("words"))).alias("left")
    )
    classes = settle(_matched(classes.drop("words"), left), "rates")
    placed = settle(_placed(sized, classes), "placed")
    cuts = settle(_cuts(placed.where("q IS NOT NULL")), "cuts")
    rest = _inside(placed, cuts).where("NOT inside AND q IS NOT NULL")
    fillers = (
        rest.groupBy("source", "doc_id", "size")
        .agg(F.sum("size").alias("words"), F.max("gap").alias("gap"))
        .where("words < 2 * gap")
        .groupBy("source")
        .agg(F.min(F.struct(F.abs(F.col("words") - F.col("gap")), "doc_id", "size")).alias("filler"))
    )
    return placed, Mix(classes, cuts, settle(fillers, "fillers"))


def decide(placed: DataFrame, mix: Mix) -> DataFrame:
    """placed with copies: how often the mix takes the row."""
    chosen = _matched(_inside(placed, mix.cuts), mix.fillers, "left")
    fills = (
        F.col("filler").isNotNull()
        & F.col("q").isNotNull()
        & (F.col("size") == F.col("filler.size"))
        & F.col("doc_id").eqNullSafe(F.col("filler.doc_id"))
    )
    extra = (F.col("inside") | fills).cast("int")
    return chosen.withColumn("copies", (F.col("certain") + extra).cast("int"))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for each row of docs."""
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size")
    )
    placed, mix = prepare(settle(sized, "sized"))
    return decide(placed, mix).select(
        "doc_id", "source", "size", "source_size", "target", "copies"
    )


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each row as often as it is taken, its columns as they came."""
    whole = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"),
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
    )
    _, mix = prepare(settle(whole.drop("row"), "sized"))
    taken = decide(_placed(whole, mix.classes), mix).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
