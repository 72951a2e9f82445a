"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import exact_dedup, mixing, packing, simhash, toxicity
from tabloom.llm.common import saved, table, unused
from tabloom.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, scores below one half.

    A null text counts as empty; repeated rows have one score; without labelled rows all stay.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "score")
    return toxicity.scored(docs, model, score=score).where(F.col(score) < 0.5).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text that is equal up to white space: the smallest key's; null counts as empty."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal fingerprints: the smallest key's; documents without words are one group."""
    return simhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a document stands in it once for every copy taken."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every token piece in the training sequences; an empty text is its end id alone."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Three stages (a trained classifier, XXH64 fingerprints, a tokenizer) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents`` on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = saved(docs, f"stage-{name}")
    return docs
