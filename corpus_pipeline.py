"""Pipeline over ``documents``: reject toxic and poor texts, keep one of each group of near
copies, pack what is left into training windows.

Every stage takes (spark, docs, folder of tables) and works on all documents that the stage
before kept; all but the last return the columns of ``documents``. A null text counts as
empty (and fails the quality rules), repeated rows are one document to the similarity join,
and rows with a null id are never taken for copies of others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import jaccard, packing, quality, toxicity
from lakeloom.llm.queries import VOCABULARY, table
from lakeloom.llm.storage import stored
from lakeloom.operators.layout import replicate_counted
from lakeloom.session import tune


def unused(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that the documents do not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half. The lexicon is learnt from labelled
    documents of four ids in five, so the fifth still tells how well it does."""
    labels = table(spark, sf_dir, "labels").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
    name = unused(docs, "score")
    scored = toxicity.score(docs, toxicity.learn(docs, labels), docs.columns, name=name)
    return scored.where(F.col(name) < 0.5).select(docs.columns)


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are more likely good than bad."""
    # Whatever the columns are called, here they have plain names.
    safe = [f"c{i}" for i in range(len(docs.columns))]
    text = safe[docs.columns.index("text")]
    measured = stored(quality.measure(docs.toDF(*safe), safe, text), "quality")
    kept = quality.judged(measured, quality.learn(measured)).where("kept")
    return kept.select(*[F.col(s).alias(c) for s, c in zip(safe, docs.columns, strict=True)])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group that links connect. A document is an id
    with a text, so one id with several texts is several documents; of equal rows one stays."""
    key = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text").alias("text_hash")))
    name = unused(docs, "document")
    keyed = docs.withColumn(name, key)
    groups = stored(jaccard.similar_groups(keyed.select(name, "text"), id_column=name), "groups")
    copies = groups.where(F.col(name) != F.col("component_id")).select(name).distinct()
    kept = keyed.join(replicate_counted(copies), name, "left_anti")
    if groups.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        known = F.col(name).isNotNull()
        kept = kept.where(known).dropDuplicates([name]).unionByName(kept.where(~known))
    return kept.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.cut_documents(docs, public_tokenizers.path(VOCABULARY), end_id=1))


STAGES = [
    ("toxicity", reject_toxic),
    ("quality rules", reject_poor),
    ("n-gram Jaccard join", one_of_near_copies),
    ("packing", pack),
]
#: Learned scores and similarity joins have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    sf_dir = sf_dir.rstrip("/")
    docs = table(tune(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
