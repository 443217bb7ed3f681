"""The corpus pipeline: quality rules, line dedup, near dedup, mixing, packing.

Each stage takes the documents its predecessor kept and is written and read again before the next:

* quality_rules: documents that break a rule go;
* line_dedup: later copies of repeated runs of lines go, and documents of which nothing is left;
* minhash_dedup: one document of each group of near copies stays;
* mixing: rows come in the order of the schedule, documents of small sources as often as their
  source's target weight asks;
* packing: one row per piece of a document in a sequence, with its token ids.

The last two steps need a tokenizer, which SQL has not, so there is no SQL for the whole; tests
hold every stage against a plain version of it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from crewlens.llm import line_dedup, minhash, mixing, packing, quality_rules
from crewlens.llm.queries import TOKENIZER
from crewlens.llm.tables import read
from crewlens.session import CODEC, passing, stored, tune


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def drop_repeated_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)  # its joins are split where a key is frequent
    return line_dedup.clean(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)  # its joins are split where a key is frequent
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)  # its joins are split where a key is frequent
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_repeated_runs),
    ("minhash_dedup", keep_one_of_each_group),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    with passing(spark) as keep:
        for name, stage in STAGES[:-1]:
            with passing(spark) as keep_stage:
                docs = keep_stage(stored(stage(spark, docs, sf_dir), name, CODEC))
        keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
