"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    hard_negatives,
    kdtree,
    licenses,
    mixing,
    ngram_join,
    packing,
    periodic,
    quality_rules,
    repair,
    secrets,
    sharding,
    simhash,
    url_filter,
)
from strata.llm.common import scratch, table


def vocabulary() -> str:
    """The word tokenizer's file, installed at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("secrets")

    def kind(*names: str) -> Column:
        return F.filter(found, lambda span: span["kind"].isin(*names))

    return secrets.scan(docs).select(
        "doc_id",
        *(F.size(kind(name)).cast("long").alias(f"n_{name}") for name in secrets.BASE_KINDS),
        F.sha2(secrets.digest(kind(*secrets.BASE_KINDS)), 256).alias("base_sha256"),
        secrets.digest(found).alias("spans"),
        F.size(kind("pem", "key", "jwt")).cast("long").alias("n_confirmed"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    repair.write(table(spark, sf_dir, "documents"), path, vocabulary())
    return repair.read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return kdtree.search(vectors, vectors.where("vec_id % 100 = 0"), k=10).select(
        "query_id", "rank", "vec_id", "score"
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rules = quality_rules.CORPUS_RULES
    judged = quality_rules.judge(docs, into="quality", rules=rules, lang="lang")
    counts = F.col("quality.counts")
    return judged.select(
        "doc_id",
        *(
            counts[name].alias(name)
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ),
        F.col("quality.base_failed").alias("base_failed"),
        F.col("quality.kept").alias("kept"),
    )


#: Shards of the production layout.
SHARDS = [f"shard-{n:03d}" for n in range(64)]


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # A source may hold a third of all documents, so its documents are spread by their ids.
    placed = sharding.place(docs, ["source"], SHARDS, spread=["doc_id"])
    path = scratch(spark, "shards")
    sharding.write(placed, path)
    held = sharding.read(spark, path, placed.schema)
    # A row for each shard.
    sizes = held.groupBy("shard").agg(
        F.count("*").alias("shard_rows"), F.sum(F.length("text")).alias("shard_chars")
    )
    return held.select("doc_id", "source", "shard_slot", "shard").join(F.broadcast(sizes), "shard")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs)
    return found.select(
        "doc_id",
        F.col("licenses.digest").alias("digest"),
        F.col("licenses.license").alias("license"),
        F.array_join("licenses.notices", ",").alias("notices"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.scan(docs.withColumn("text", periodic.planted(docs)))
    runs, length, period = F.col("runs"), F.col("best.length"), F.col("best.period")

    def larger(best: Column, run: Column) -> Column:
        # Runs come by start, then period: of equal exponents the first stays.
        beats = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | beats, run).otherwise(best)

    lines = F.transform(
        runs, lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    )
    best = F.aggregate(runs, F.get(runs, F.lit(0)), larger)
    return found.withColumn("best", best).select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    rows = rows.select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(rows, rows.where("vec_id % 100 = 0"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_texts(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_mixing": op2_mixing,
    "op3_token_files": op3_token_files,
    "op4_url_filter": op4_url_filter,
    "op5_simhash": op5_simhash,
    "op6_kdtree": op6_kdtree,
    "op7_packing": op7_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_sharding": op9_sharding,
    "op10_licenses": op10_licenses,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_ngram_join": op13_ngram_join,
}
