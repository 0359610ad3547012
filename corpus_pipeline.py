"""Corpus preparation in five stages, each on what the one before has kept.

    toxicity      documents whose calibrated score reaches the threshold go
    line dedup    later copies of repeated line runs and of single long lines are cut out; documents left without a line go
    near-dedup    one document of each group stays, the one with the smallest id
    mixing        each document is repeated or left out so that sources meet their targets
    tokens        byte-level BPE ids of every row

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame with the columns
of ``docs``, the last one with ``token_ids`` and ``n_tokens`` as well. ``run``
writes each stage's rows to the shared folder and reads them for the next. A
repeated document comes out of the mix as that many equal rows.

Columns beyond those of documents stay, whatever their names. A null or empty text is
kept by toxicity (by its score) and has no lines, so line dedup drops nothing from it and lets it go on.
Rows without doc_id are judged like others, under a number made of their text. Of
equal rows (doc_id and text) near-dedup keeps one. Empty tables go through all stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.llm import bpe, linedup, minhash, mixing, toxicity
from quotewright.llm.scratch import written


def _key() -> Column:
    """The doc_id; for rows without one a negative number made of the text."""
    made = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1))
    return F.coalesce(F.col("doc_id").cast("long"), -1 - made)


def _row(docs: DataFrame) -> Column:
    """All columns as one value, so that they may have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    rows = docs.select(_row(docs).alias("row"), _key().alias("key"))
    return rows.join(ids.select(F.col("doc_id").alias("key")), "key", "left_anti").select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scores = toxicity.score(docs.select(_key().alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, scores.filter("predicted = 1"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(_key().alias("doc_id"), "text", _row(docs).alias("row"))
    cleaned = linedup.deduplicated(rows, long_words=linedup.LONG_LINE)
    kept = cleaned.filter((F.size("deleted") == 0) | (F.size("deleted") < F.col("n_lines")))
    changed = {"text": F.col("text"), "n_chars": F.length("text")}
    return kept.select([(changed[c].cast(docs.schema[c].dataType) if c in changed else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.select(_key().alias("doc_id"), "text")
    several = written(keyed.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "several")
    rows = _without(docs, minhash.near_duplicates(keyed).filter("not kept"))
    # Equal rows have one id and are kept together by it; only rows that share an id meet here.
    shared = rows.select(_row(docs).alias("row"), _key().alias("key")).join(several.select(F.col("doc_id").alias("key")), "key", "left_semi")
    return _without(rows, several).unionByName(shared.groupBy("key", F.col("row.text").alias("text")).agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: Trees, components and dependent rounding have no SQL form. tests/llm compare the stages and run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
