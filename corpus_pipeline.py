"""A corpus pipeline: every stage takes the documents that its predecessor kept, written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm import decontam, langid, minhash, packing, quality
from gazetta.llm.common import shared_dir, table, written
from gazetta.operators.lineage import drop_at_end
from gazetta.sinks import commits


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rules or the trees reject.

    Null, empty and very short texts fail the base rules and go. Each row is judged by its whole text alone, so rows
    that repeat have one fate; labels of unknown documents teach nothing, and no documents give no rows.
    """
    return quality.keep(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are in no language learned from the documents themselves.

    Null texts and those without letters go; a null lang teaches nothing, but its document is judged like any other.
    Rows that repeat have one fate.
    """
    return langid.keep(docs, langid.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five-word shingles, similarity 0.8 or more).

    Rows that repeat a doc_id count as one document, of which the least text stays; rows without a doc_id
    all stay, and so do null and empty texts. The rows themselves move once, to be parted from the ids that go.
    """
    found = minhash.near_duplicates(docs).where("doc_id is not null")
    ids = written(found.groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n")).where("not kept or n > 1"), "marked")
    rows = docs.join(ids.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    again = ids.where("kept")
    if again.isEmpty():
        return rows
    repeated = docs.join(again.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("_row"))
    return rows.unionByName(repeated.select("_row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage of the benchmark, wherever in the text it stands.

    Null and empty texts hold no passage and stay, null and empty items are found nowhere, and an empty benchmark
    drops nothing. Rows that repeat have one fate.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into bins; one row for each piece of a document.

    Null, empty and wordless texts are one piece of no tokens in bin -1, rows that repeat are packed each on its own,
    and a document longer than a bin is cut into pieces. No documents give no rows.
    """
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]

#: The trees, the language model, the banding and the packing have no equal in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages on the documents of sf_dir; what each returns is written to a shared folder and read again.

    With a `folder` of its own a run that was killed goes on after the last stage that it wrote to its end, and all stages
    stay. Without one, what a stage returned is dropped when the next is written, and the last when the interpreter ends.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    root = folder or f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{root}/{name}"
        if "_SUCCESS" not in commits.listed(spark, path):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if before and not folder:
            commits.delete(spark, before)
        before = path
    if not folder:
        drop_at_end(spark, root)
    return docs
