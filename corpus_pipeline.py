"""The corpus pipeline: documents in, token ids out.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of documents.  ``run`` applies
them to the documents of a folder.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangar.llm import bpe, mixing, neardup, secrets, toxicity
from hangar.llm.common import staged, table

#: The columns of documents; further ones go through the stages as they are.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def guarded(stage):
    """Keeps further columns from clashing with names that a stage uses inside."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(own), sf_dir)
        return out.withColumnsRenamed({v: k for k, v in own.items()})

    return run_stage


@guarded
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, *model)
    return scored.where(F.col("toxic_score") < toxicity.THRESHOLD).select(*docs.columns)


@guarded
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the least id
    (null last), and of repeated rows any one."""
    classes = staged(neardup.near_classes(docs), "near_classes")
    texts = neardup.keyed(docs.select("doc_id", "text")).groupBy(F.col("_key").alias("key")).agg(
        F.min("doc_id").alias("id"))
    best = texts.join(classes, "key").groupBy("root").agg(F.min(F.struct(
        F.col("id").isNull().alias("late"), "id", "key")).alias("b")).select(
        F.col("b.key").alias("_key"), F.col("b.id").alias("_best"))
    return (neardup.keyed(docs).join(best, "_key")
            .where(F.col("doc_id").eqNullSafe(F.col("_best")))
            .dropDuplicates(["_key"]).select(*docs.columns))


@guarded
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found replaced by the name of its kind."""
    return secrets.redact(docs, staged(secrets.scan(docs), "secret_ledger"))


@guarded
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a row for each copy that it takes of a document."""
    sizes = staged(mixing.sized(docs), "mix_sizes")
    plan = staged(mixing.plan(sizes), "mix_plan")
    placed = mixing.place(mixing.located(docs), plan)
    return mixing.mixture(placed, words=mixing.total_words(plan)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of every row."""
    out = bpe.encode(docs, bpe.default_path())
    return out.select("doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
                      "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_neardup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Learned weights, hashed signatures and seeded draws have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
