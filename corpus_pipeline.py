"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir), where docs has the columns of ``documents`` (doc_id, text, lang, source,
n_chars; further ones pass through), and returns what it keeps with the same columns; the last returns the pieces of
packed sequences. ``run`` applies them to ``documents``, each stage's result written and read again.

1. language: documents whose language can't be told (null, empty, or without a letter) go; lang is set to the prediction.
2. near_duplicates: one document of each group of near duplicates stays, that of the smallest doc_id.
3. decontamination: documents that hold a window of a benchmark item go.
4. pii: personal values give way to pseudonyms; n_chars is counted anew.
5. packing: ids of the texts, cut into sequences of power-of-two lengths.

SQL can't express the language, near-duplicate, pseudonym and packing stages, so ORACLE_SQL is None and tests compare
each stage with a brute-force version. An empty table passes every stage and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecflow.llm import common, decontam, jaccard_join, langid, packing, pii


def language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return langid.keep_known(docs, model)


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def pseudonyms(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    new = pii.pseudonymise(docs, pii.DEMO_KEY, counts=False)
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    return new if kind is None else new.withColumn("n_chars", F.length("text").cast(kind)).select(docs.columns)


def pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, common.tokenizer_path())


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("pii", pseudonyms), ("packing", pack)]

ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
