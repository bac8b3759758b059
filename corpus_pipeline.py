"""A corpus pipeline: five operators in a row, each on all documents that its predecessor kept.

Language identification drops documents whose language cannot be told; near duplicates leave
one document of each group; secrets are replaced in the texts; sources are mixed to target
weights, by repeating and cutting documents; and the texts are encoded to token ids. Every
stage returns the columns of ``documents``, up to the last one, which adds the ids.

A NULL or empty text is no language and goes in the first stage. Empty tables pass through.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import langid, mixing, pieces, secrets, simhash
from lakeops.session import staged, tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


USED = ("doc_id", "text", "lang", "source", "n_chars")
#: whole texts that a Python worker is given at a time; five stages in a row leave little beside the heap
TEXTS_AT_ONCE = "250"


def prepared(spark: SparkSession) -> None:
    """Set the options of this package on the session, which may have been made elsewhere."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_AT_ONCE)


def carried(stage: Stage) -> Stage:
    """The stage with all further columns of the documents packed away, whatever their names.

    It runs with the options of this package also on a session made elsewhere: without them a
    batch of whole texts between the JVM and Python has no bound that fits beside the heap.
    """

    @functools.wraps(stage)
    def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        prepared(spark)
        more = [c for c in docs.columns if c not in USED]
        if not more:
            return stage(spark, docs, sf_dir).select(*docs.columns)
        used = [c for c in docs.columns if c in USED]
        out = stage(spark, docs.select(*used, F.struct(*(F.col(f"`{c}`") for c in more)).alias("carried")), sf_dir)
        return out.select(*(F.col(f"carried.`{c}`") if c in more else F.col(c) for c in docs.columns))

    return packed


@carried
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; ``lang`` becomes the predicted one.

    Learns from documents outside the held-out fifth, and rejects ``und`` only: an ambiguous
    text has one of the learnt languages, and is kept.
    """
    model = langid.learn(docs.filter(~langid.held_out()))
    found = langid.predict(docs, model).filter(F.col("lang_pred") != langid.UNDETERMINED)
    found = found.withColumn("lang", F.col("lang_pred"))
    return found.drop("lang_pred", "score", "ambiguous")


@carried
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: shingles of three words, fingerprints within two bits."""
    return simhash.one_per_class(docs, shingle=3, radius=2)


@carried
def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with ``[SECRET]`` for every secret."""
    return secrets.redact(docs)


@carried
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last one of a source cut."""
    return mixing.repeated(mixing.mix(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids (little-endian unsigned 32-bit numbers) instead of the text."""
    prepared(spark)
    found = pieces.encode_documents(docs, pieces.public_model())
    return found.select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        "ids",
        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("redacted", redacted),
    ("mixed", mixed),
    ("encoded", encoded),
]

# classifiers, fingerprints and token ids have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each result written once and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
