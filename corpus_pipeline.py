"""The corpus pipeline: five stages, each one operator of ``mediamart.llm``.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
its result is written as Parquet and read again as the next stage's docs. All
but the last return the columns of documents, in their order.

- quality: the rule ensemble, learned from sf_dir's documents and labels;
  documents with a score under its threshold go.
- language: the mixture model, learned from sf_dir's documents; documents
  without a letter go, and those in no learned language: less than LEAST_KNOWN
  of their words hold a trigram that any of them knows. Documents in several
  learned languages stay, however their shares are.
- near_duplicates: one document of each SimHash component stays, the one with
  the smallest doc_id (a null id last, then by the text's digest). Components
  rest on texts alone: of exact copies without an id one stays, and rows that
  share an id but not a text do not push each other out.
- repeats: bytes of repeated strings are cut out of the texts; a character of
  which a byte is cut goes whole. n_chars follows the text where the table has it.
- packing: the documents' pieces and the sequence and offset of each.

Null texts count as empty; an empty table gives an empty result at every
stage; extra columns stay until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.llm import language_mixture, packing, quality_rules, simhash_tiles, suffix_dedup
from mediamart.llm.common import table, unused, written
from mediamart.llm.registry import WORD_BPE

LEAST_KNOWN = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_rules.fit(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    score = unused(docs, "quality_score")
    return quality_rules.score(docs, model, score).where(F.col(score) >= quality_rules.THRESHOLD).select(*_names(docs))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_mixture.fit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    found = unused(docs, "found_language")
    kept = (F.col(f"{found}.lang") != language_mixture.UNKNOWN) & (F.col(f"{found}.known") >= LEAST_KNOWN)
    return language_mixture.predict(docs, model, found).where(kept).select(*_names(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_tiles.distinct_documents(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.clean_text(docs)
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(cut.schema["n_chars"].dataType))
    return cut


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, WORD_BPE)[1]


def _names(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates),
          ("repeats", repeats), ("packing", pack)]

#: No SQL can state the learned models and the packing; tests compare stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
