"""URL filters: rules first, and boosted trees over lexical features for what no rule fits.

The rules label the urls that they fit; from those, gradient-boosted trees learn what a blocked
url looks like. Features: lengths of url, host and path, labels of the host, depth of the path,
digit ratio, hyphens, entropy of the characters, number of parameters, and statistics of two
suffixes, the host's last label and that label with the path's first segment: how many urls have
it, and the smoothed share of block among those that rules judge. Counts and shares cover all
urls; a row that trains is left out of its own shares.

The trees are fitted on TRAINING_ROWS labelled rows or about so many, chosen by a digest of id and
url; fitting repeats exactly for the same rows. Everything else runs where the rows lie, with
joins to the suffix statistics, which have a row for each suffix.

Defined results: a null url, or one without "://", has an empty host and path, which no rule fits
and the trees judge. Repeated rows get the same verdict. Where no url has a rule, all are allowed.
Of equally long rules that fit, block wins. Other columns aren't read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import settle

#: Bound of the sample that the trees are fitted on.
TRAINING_ROWS = 20_000
TREES = 12
DEPTH = 4
#: Urls that the common share of block counts for in a suffix's share.
PRIOR = 5.0
SEED = 42

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """Fits the host and its subdomains where the path starts with the rule's."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and the rest of the url behind the path."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    behind = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(behind, "^[^?#]*", 0)
    tail = F.substring(behind, F.length(path) + 1, F.length(behind))
    return F.translate(host, _UPPER, _LOWER), path, tail


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _entropy(text: Column) -> Column:
    """Bits for each character."""
    size = F.length(text).cast("double")

    def bits(char: Column) -> Column:
        share = (size - F.length(F.replace(text, char, F.lit("")))) / size
        return -share * F.log2(share)

    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.aggregate(chars, F.lit(0.0), lambda total, c: total + bits(c))


def _lexical(url: Column, host: Column, path: Column, tail: Column) -> dict[str, Column]:
    whole = F.coalesce(url, F.lit(""))
    number = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    query = F.regexp_extract(tail, r"^\?([^#]*)", 1)
    return {
        "length": F.length(whole).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "labels": number(host, "[^.]+"),
        "depth": number(path, "[^/]+"),
        "digit_ratio": number(whole, "[0-9]") / F.greatest(F.length(whole), F.lit(1)),
        "hyphens": number(whole, "-"),
        "entropy": _entropy(whole),
        "parameters": number(query, "[^&]+"),
    }


LEXICAL = (
    "length", "host_length", "path_length", "labels", "depth", "digit_ratio", "hyphens", "entropy",
    "parameters",
)
SUFFIXES = ("suffix", "section")
FEATURES = (*LEXICAL, *(f"{name}_{what}" for name in SUFFIXES for what in ("count", "share")))


def describe(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruled (its verdict), the suffixes and the lexical features."""
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    host, path, tail = split_url(F.coalesce("url", F.lit("")))
    parts = base.withColumns({"host": host, "path": path, "tail": tail})
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    label = F.regexp_extract("host", r"[^.]*$", 0)
    first = F.regexp_extract("path", "^/?([^/]*)", 1)
    columns = _lexical(*(F.col(name) for name in ("url", "host", "path", "tail")))
    return parts.withColumns(
        {"rule": rule, "ruled": verdict, "suffix": label, "section": F.concat_ws("/", label, first)} | columns
    ).drop("tail")


class UrlFilter(NamedTuple):
    """Fitted trees (None: nothing to learn from) with the statistics that their features need."""

    model: GBTClassificationModel | None
    statistics: dict[str, DataFrame]
    prior: float


def _blocked() -> Column:
    return F.when(F.col("ruled") == "block", 1.0).when(F.col("ruled") == "allow", 0.0)


def _with_statistics(described: DataFrame, fitted: UrlFilter, leave_out: bool) -> DataFrame:
    """described with the statistics of its suffixes; leave_out: without the row itself."""
    out = described
    for name in SUFFIXES:
        table = fitted.statistics[name].withColumnRenamed(name, f"{name}__key")
        out = out.join(table, F.col(name) == F.col(f"{name}__key"), "left")
        blocked, judged = (F.coalesce(f"{name}__{x}", F.lit(0.0)) for x in ("blocked", "judged"))
        if leave_out:
            blocked, judged = blocked - _blocked(), judged - 1
        share = (blocked + PRIOR * fitted.prior) / (judged + PRIOR)
        out = out.withColumns(
            {f"{name}_count": F.log1p(F.coalesce(f"{name}__all", F.lit(0.0))), f"{name}_share": share}
        ).drop(*(f"{name}__{x}" for x in ("key", "all", "blocked", "judged")))
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(out)


def fit(described: DataFrame, rows: int = TRAINING_ROWS) -> UrlFilter:
    """Learn from the rows of `described` that a rule judges."""
    statistics = {
        name: settle(
            described.groupBy(name).agg(
                F.count("*").cast("double").alias(f"{name}__all"),
                F.coalesce(F.sum(_blocked()), F.lit(0.0)).alias(f"{name}__blocked"),
                F.count("ruled").cast("double").alias(f"{name}__judged"),
            ),
            f"statistics-{name}",
        )
        for name in SUFFIXES
    }
    sums = statistics["suffix"].agg(F.sum("suffix__blocked"), F.sum("suffix__judged")).first()
    blocked, judged = (x or 0.0 for x in sums)
    if not judged:
        return UrlFilter(None, statistics, 0.0)
    fitted = UrlFilter(None, statistics, blocked / judged)
    digest = F.pmod(F.xxhash64("page_id", "url", F.lit(SEED)), F.lit(1 << 30))
    chosen = described.where("ruled IS NOT NULL").where(digest < int(rows / judged * (1 << 30)) + 1)
    training = _with_statistics(chosen, fitted, leave_out=True).select(
        "page_id", "features", _blocked().alias("label")
    )
    # A bounded sample; one order of its rows makes the fit repeatable.
    training = settle(training.coalesce(1).sortWithinPartitions("page_id", "label"), "training")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, maxBins=64)
    return fitted._replace(model=trees.fit(training.coalesce(1)))


def judge(described: DataFrame, fitted: UrlFilter) -> DataFrame:
    """described with p_block, the trees' probability, and verdict: the rule's, else theirs."""
    if fitted.model is None:
        scored = described.withColumn("p_block", F.lit(0.0))
    else:
        scored = fitted.model.transform(_with_statistics(described, fitted, leave_out=False))
        scored = scored.withColumn("p_block", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction"
        )
    trees = F.when(F.col("p_block") > 0.5, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("ruled", trees))


def filter_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block for each row of pages."""
    described = settle(describe(pages, page_id, url, rules), "urls")
    return judge(described, fit(described)).select(
        "page_id", "host", "path", "rule", "verdict", "p_block"
    )
