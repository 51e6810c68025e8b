"""From raw documents to shards: quality, near-duplicates, benchmark leaks, source mix, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table; all but the last return the columns of ``docs`` and
nothing else, whatever those are called, and work on whatever rows they are given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawlnet.llm.decontaminate import Contamination, contaminated
from trawlnet.llm.mixing import Mix, mix_sources, word_tokens
from trawlnet.llm.near_dup import NearDup, near_duplicates
from trawlnet.llm.quality_cnn import learn, score
from trawlnet.llm.ring import Ring, assign
from trawlnet.llm.shared import as_text, written
from trawlnet.session import ship_package

#: A document below this probability of good quality goes.
LEAST_QUALITY = 0.3
#: Keys of removed rows are broadcast up to this many, about 60 bytes each; beyond it they are shuffled.
BROADCAST_KEYS = 500_000
KEY = "_pipeline_key"


def _key() -> Column:
    """Names a row by its id and text, so that rows that share an id are told apart."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.concat_ws(":", name, F.hex(F.xxhash64("text")))


def _without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """The rows of ``docs``, which bear ``KEY``, whose key is not among ``removed``."""
    removed = written(removed.select(KEY).distinct(), "removed")
    if removed.count() <= BROADCAST_KEYS:
        removed = F.broadcast(removed)
    return docs.join(removed, KEY, "left_anti").drop(KEY)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Scores every text with a network learned from the labelled rows and drops what scores below LEAST_QUALITY."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    params = learn(docs.select("doc_id", "text"), labels)
    scored = score(docs, params, out_col="_pipeline_score")
    return scored.where(F.col("_pipeline_score") >= LEAST_QUALITY).select(*docs.columns)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the smallest id, then text hash. Texts without words all stay."""
    ship_package(spark)
    keyed = docs.withColumn(KEY, _key())
    grouped = near_duplicates(keyed.select("doc_id", "text", KEY), NearDup(shingle=5, percent=80), carry=(KEY,))
    grouped = written(grouped.where(F.col("group").isNotNull()).select("group", "doc_id", KEY), "groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", KEY)
    first = grouped.groupBy("group").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # groups of one need no join; a large group is many narrow rows, which adaptive execution splits
    rest = grouped.join(first.select("group", F.col(f"first.{KEY}").alias("stays")), "group")
    kept = _without(keyed, rest.where(F.col(KEY) != F.col("stays")))
    repeated = grouped.groupBy(KEY).count().where("count > 1")
    if repeated.isEmpty():
        return kept
    # rows that repeat id and text: one of them stays, and texts without words are not touched
    wordless = ~as_text(F.col("text")).rlike("[^\\x20\\x09-\\x0D]")
    kept = kept.withColumn(KEY, _key())
    once = kept.where(~wordless).dropDuplicates([KEY])
    return kept.where(wordless).unionByName(once).drop(KEY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every document with a passage of a benchmark item."""
    ship_package(spark)
    keyed = docs.withColumn(KEY, _key())
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = contaminated(keyed.select(KEY, "text"), benchmark, Contamination(), id_col=KEY)
    return _without(keyed, hits.select(F.col("doc_id").alias(KEY)))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources until the weights are even enough; every document is used once at least."""
    whole = docs.select(F.struct("*").alias("_doc"))
    tokens = word_tokens(as_text(F.col("_doc.text")))
    mixed = mix_sources(whole, Mix(), "_doc.doc_id", "_doc.source", tokens, ("_doc.text",))
    return mixed.select("_doc.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: every row's place in one of eight shards of equal counts."""
    return assign(docs, Ring(shards=8, virtual_nodes=128, slack=0.0))


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dup", near_dups),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
    ("sharding", sharding),
]

#: SQL has no trained network, so the whole is held against a brute-force version in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each stage's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
