"""A training corpus from ``documents``: quality, exact copies, near copies,
mixture, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that ``run`` writes as Parquet to the shared folder
(``spark.checkpoint.dir``) and rereads as the next stage's docs. All stages
but the last return the columns of ``docs``; the last returns token ids.

A lost executor costs at most the stage at work: everything before it is in
written tables. Nothing here decides by size; every stage sees all rows that
its predecessor kept.

Defined cases: an empty table passes through every stage as an empty table;
null and empty texts are scored by the quality model like any other and, if
kept, form one group of copies, of which the mixture selects none (no tokens);
repeated rows leave the exact stage once; the later stages name a document by
its id and text, so documents with a null or a shared id are each decided like
any other; extra columns are carried to the last stage.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodstream.llm import bpe, exact_dedup, mixing, quality, simhash
from moodstream.llm.common import read
from moodstream.llm.queries import DOMAIN_SQL, MIX_SEED, MIX_WEIGHTS, bpe_vocabulary
from moodstream.session import checkpoint_dir

# Tokens to keep of what reaches the mixture.
MIX_SHARE = 0.6


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts. It learns from the
    labelled documents that reach this stage, outside the held-out fold."""
    model = quality.train(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.accepted(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.survivors(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (the smallest id; one
    without an id only where no other has one)."""
    return simhash.survivors(docs)


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen for the target weights, each at most once."""
    return mixing.mix(docs, MIX_WEIGHTS, MIX_SHARE, F.expr(DOMAIN_SQL), seed=MIX_SEED)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of op5."""
    return bpe.encode_documents(docs, bpe_vocabulary(), with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixture", mixture_stage),
    ("token_ids", token_stage),
]

# The quality model, the fingerprints and the tokenizer have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
