"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, source mix.

Every stage takes (spark, docs, sf_dir), calls one operator of `stratalake.llm` on all rows of
`docs` and returns a frame; `run` stores each result as Parquet in the shared folder and reads
it back as the next stage's input. All but the last return the columns of `documents`.

Stages that remove rows number the rows of their input once, in a stored copy, so repeated rows
and rows without an id are told apart. Added columns take names that the input does not have.
Empty inputs pass through as empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontam, exact_dedup, mixing, quality, simhash
from stratalake.llm.common import fold_is, fresh, join_checked, keyed, staged, table

#: A document stays when its quality score reaches this.
QUALITY = 0.3


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the classifier rejects go."""
    meta = ("n_chars",) if "n_chars" in docs.columns else ()
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality", fold_is(F.col("doc_id"), 5, 0), meta, "doc_id", "text")
    scored = quality.score(docs, model, meta, [F.struct("*")], "text")
    return scored.where(F.col("score") >= QUALITY).select("k0.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts one stays."""
    rows, key = keyed(docs, "pipeline-exact")
    return exact_dedup.keep_first(rows, key).drop(key)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of every class of near-duplicates the document with the smallest id stays."""
    rows, key = keyed(docs, "pipeline-near")
    return simhash.keep_leaders(rows, key).drop(key)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark passage go."""
    rows, key = keyed(docs, "pipeline-benchmark")
    hits = decontam.contaminated(rows, table(spark, sf_dir, "benchmark"), key=key)
    leaks = staged(hits.select(F.col("key").alias(key)).distinct(), "pipeline-leaks")
    return join_checked(rows, leaks, key, "left_anti").drop(key)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one row per copy that the mix takes, numbered from 1 in `copy`, with the
    document's size and its source's size and target."""
    copy, sizes = fresh(docs, "copy"), [fresh(docs, c) for c in ("size", "source_size", "target")]
    number = fresh(docs, "number")
    counted = mixing.numbered(docs, number)
    draw = mixing.draw_number(F.col("doc_id"), F.col("text"), F.col(number), "mix").alias("draw")
    size = mixing.word_count(F.col("text")).alias("size")
    plan = mixing.plan_mix(staged(counted.select("doc_id", "source", size, draw), "pipeline-mix"))
    sized = counted.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "source", size, draw)
    taken = mixing.ranked_rows(sized, plan).withColumn("copies", mixing.copies()).where("copies > 0")
    number = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(copy)
    return taken.select("doc.*", *[F.col(c).alias(n) for c, n in zip(("size", "source_size", "target"), sizes)], number)


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("mixing", source_mix),
]

#: Two stages learn from the data or hash with XXH64, which SQL cannot repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
