"""From raw documents to packed training sequences, in five stages.

Every stage takes any rows: nulls, blank and very long texts, repeated rows, an empty table, further
columns of any name. What each does with them stands at its operator; all but the last keep the columns
of their input. A stage may be called once the one before was written, as then the tables that one
wrote on its way are removed.
"""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import host_quality, minhash, mixing, packing, site_lines
from paperloom.llm.shared import SCRATCH, drop_scratch
from paperloom.llm.tokens import tokenizer_path
from paperloom.runtime import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Tables that the last stage has written on its way to its result.
_LEFT: list[str] = []


def stage(work: Stage) -> Stage:
    """`work`, which first removes what the stage before it needed for a result that was written since."""
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_scratch(spark, [path for path in _LEFT if path in SCRATCH])
        before = len(SCRATCH)
        out = work(spark, docs, sf_dir)
        _LEFT[:] = SCRATCH[before:]
        return out

    return run


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and come from a host that passes. Null and blank texts go."""
    return host_quality.keep_good(docs)


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text less lines that are boilerplate on its host; `n_chars` follows.

    A null text stays null, with null characters; a text may end up empty.
    """
    cleaned = site_lines.drop_boilerplate(docs)
    put = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return cleaned.select(*[put.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles; repeated rows are such a
    group, texts without words are none and stay."""
    return minhash.keep_one(docs)


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says; some sources' documents go, and those of
    sources without words."""
    return mixing.emit(mixing.mix(docs))


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids; a text without tokens is the end id alone."""
    return packing.pack(docs, tokenizer_path(), end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("packing", pack),
]

# Tokens and shingle components cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        out = work(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
