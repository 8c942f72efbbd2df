"""The corpus pipeline: quality rules, near duplicates, mixing of sources, packing.

Every stage takes all that the stage before kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from engagement_lake.llm.mixing import mix_sources, mixed_documents, n_words  # noqa: E402
from engagement_lake.llm.packing import pack_documents  # noqa: E402
from engagement_lake.llm.quality_rules import judge  # noqa: E402
from engagement_lake.llm.shingle_join import jaccard_components  # noqa: E402
from engagement_lake.llm.store import read, written  # noqa: E402


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and their language's perplexity band let pass.

    Texts that are null, empty or white fail the base rule; repeated rows are judged alike and stay or go
    together; an empty table stays empty; columns of any other name are kept as they are.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return judge(docs, key=whole).where("kept").select("key.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.75 or more connect: the one of least id.

    Documents without words, null texts among them, are linked with nothing and all stay. The same document
    given several times counts as one. A null id is least. An empty table stays empty; all columns are
    kept, whatever their names.
    """
    id_and_text = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    known = F.unhex(F.md5(id_and_text))
    keyed = docs.select(F.struct("doc_id", known.alias("known")).alias("doc"), "text")
    found = jaccard_components(keyed, key="doc", counted=False)
    chosen = found.where("doc = component").groupBy(F.col("doc.known").alias("known"))
    chosen = written(chosen.agg(F.max("n_shingles").alias("size"), F.count(F.lit(1)).alias("rows")), "chosen")
    repeated = "rows > 1 AND size > 0"
    named = docs.select(known.alias("known"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    once = named.join(chosen.where(f"NOT ({repeated})"), "known", "left_semi")
    again = named.join(chosen.where(repeated), "known", "left_semi").dropDuplicates(["known"])
    return once.unionByName(again).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions; a document taken twice is there twice.

    A null source is one of its own; null and empty texts have no words and are not taken; ties of finish
    times follow the row's hash; repeated rows count each; an empty table stays empty; all columns are kept.
    """
    return mixed_documents(mix_sources(docs, n_words("text"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 4096 tokens.

    A null or empty text is its end token; repeated rows are packed each; an empty table gives no rows; of the
    columns only ``doc_id`` and ``text`` are used.
    """
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

# Hashes, perplexities and tokenizers have no SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
