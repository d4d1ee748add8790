"""The training-data pipeline: five stages over ``documents``, each written as Parquet and reread.

language            documents whose words speak for none of the learned languages go
toxicity            documents scored as toxic go
near duplicates     of each group linked by SimHash one document stays
decontamination     documents that leak a benchmark item go
packing             what is left is packed into sequences of 4096 tokens

A stage reads nothing but its predecessor's rows and the side tables it names, and keeps their
columns; models are learned from the rows it is given. Empty and null texts have no language
and leave at the first stage; a missing or one-sided label table makes no document toxic.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontamination, language, packing, simhash, toxicity
from cadenza.llm.common import free_name, staged, table

MIN_EVIDENCE = 0.5  # a text of whose words training supports a smaller share is in no learned language
TOKENIZER = "word_bpe_49k.json"
END_ID, SEQUENCE = 2, 4096


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages, by the share of their words that training supports
    (the score can't tell: it is shared among the learned languages whatever the text is in)."""
    name, score, evidence = (free_name(docs, n) for n in ("lang_pred", "lang_score", "lang_evidence"))
    found = language.with_languages(docs, language.fitted(docs), out=(name, score, ""), evidence=evidence)
    return found.where((F.col(name) != language.UNKNOWN) & (F.col(evidence) >= MIN_EVIDENCE)).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    score = free_name(docs, "toxicity")
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_toxicity(docs, model, score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (four-word shingles, 4 bits)."""
    return simhash.one_of_each(docs, bits=4, words=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    pieces = packing.token_pieces(docs, public_tokenizers.path(TOKENIZER), END_ID, SEQUENCE)
    return packing.pack(pieces, SEQUENCE)


STAGES = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL can't state the learned and iterative stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; every result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
