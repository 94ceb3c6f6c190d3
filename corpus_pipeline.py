"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; each result is written
as Parquet in the shared folder and read again. All stages but the last return the columns of documents.

Defined cases. Null and empty texts: rejected by the quality rules; the other stages, given such rows, keep them (each is
a class of its own, holds nothing and has no tokens). Repeated rows: scored each, one stays of rows that are alike in id and
text. Different texts under one id, and rows without an id: judged text by text; of a class without any id the text with
the smallest hash stays. Empty tables: no rows. Further columns, whatever their names, are carried along by all stages but
the last. Texts are never cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import decontaminate, jaccard, pieces, pii, quality
from tidelog.llm.scratch import Scratch

#: Near-duplicates: shingles of five words, similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the classifier; others go, null and empty texts among them."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = quality.scored(docs, model)
    return rows.where(~quality.base_failed() & (F.col("_q.probability") >= quality.KEEP_AT)).drop("_q")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest doc_id; rows alike in id and text count as one.

    The join knows documents by a hash of id and text, because ids may repeat or be missing.
    """
    marked = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)), F.xxhash64("doc_id", "text").alias("mark"))  # names may clash
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = marked.select("mark", F.col(at["doc_id"]).alias("doc_id"), F.col(at["text"]).alias("text"))
    classes = jaccard.join(rows.select("mark", "text"), SHINGLE, PERCENT, id_col="mark").select(F.col("doc_id").alias("mark"), "component_id").distinct()
    ids = rows.groupBy("mark").agg(F.min("doc_id").alias("doc_id"))
    first = classes.join(ids, "mark").groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first"))
    kept = marked.join(first.select(F.col("first.mark").alias("mark")), "mark", "left_semi").dropDuplicates(["mark"])
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data is removed and what discloses it generalised, and n_chars follows. Null texts stay null."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    carry = F.struct(F.col("text").isNull().alias("_null"), *(F.col(c) for c in others))
    rows = pii.sanitise(pii.scan(docs, carry=carry))
    clean = F.when(~F.col("carry._null"), F.col("clean"))
    found = {"doc_id": F.col("doc_id"), "text": clean, **{c: F.col(f"carry.{c}") for c in others}}
    if "n_chars" in found:
        found["n_chars"] = F.length(clean).cast("long")
    return rows.select(*(found[c].alias(c) for c in docs.columns))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and whether the ids decode to the text, for every document."""
    rows = pieces.encode(docs)
    return rows.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("SentencePiece", token_ids),
]

#: SQL expresses neither the classifier nor the encoder; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        scratch.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
