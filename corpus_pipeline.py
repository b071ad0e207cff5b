"""A corpus pipeline: quality, near duplicates, secrets, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the caller writes and rereads as the next stage's
``docs``. All but the last return the columns of ``documents``; further columns, whatever their names, are carried along.
Every stage gives an empty table for an empty one; without labels of both classes no document is rejected.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import bpe, mixing, ngram_jaccard, quality, secrets
from assay.llm.features import free_names
from assay.llm.queries import secret_ledger, vocabulary_path
from assay.llm.store import Scratch, passing
from assay.session import ship, table

MIN_QUALITY = 0.3
#: Near duplicates here: word shingles of five words, similarity of 0.8 or more.
SHINGLE_WORDS, SIMILARITY = 5, Fraction(8, 10)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model does not reject."""
    model = quality.fit(docs, table(ship(spark), sf_dir, "labels"))
    (into,) = free_names(docs, "_score")
    scored = quality.score(docs, model, docs.columns, into=into)
    return scored.where(F.col(into) >= MIN_QUALITY).select(*docs.columns)


def with_keys(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """``docs`` with a number of its own for each row, written once so that it stays, and that column's name."""
    (key,) = free_names(docs, "_key")
    return scratch.keep(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def text_hash() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near duplicates, decided by row: rows that share an id are rows each.

    Rows without an id come last in a group; rows of one id go by the hash of their text. Rows of a text without words
    are groups of their own, of which those of one id and text are one.
    """
    scratch = Scratch(spark)
    rows, key = with_keys(docs, scratch)
    few = rows.select(F.col(key).alias("_key"), "doc_id", "text")
    groups = ngram_jaccard.jaccard_groups(few, id_col="_key", width=SHINGLE_WORDS, threshold=SIMILARITY)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", text_hash().alias("h"), "_key")
    placed = few.select("_key", place.alias("p")).join(groups, "_key")
    # without shingles rows differ by id and text alone
    bare = F.when(F.col("n_shingles") == 0, F.struct("p.doc_id", "p.h", F.when(F.col("p.doc_id").isNull(), F.col("_key")).alias("k")))
    group = F.struct(F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("c"), bare.alias("b"))
    first = placed.groupBy(group.alias("g")).agg(F.min("p").alias("p")).select(F.col("p._key").alias(key))
    return rows.join(ngram_jaccard.bounded_broadcast(scratch.keep(first, "first")), key, "left_semi").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret span replaced; n_chars follows the text."""
    (spans,) = free_names(docs, "_spans")
    found = secrets.find_secrets(docs, secret_ledger(spark), into=spans)
    out = found.withColumn("text", secrets.redact(F.col("text"), F.col(spans)))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows, with or without an id, as often as the mix takes them."""
    scratch = Scratch(spark)
    rows, key = with_keys(docs, scratch)
    taken = mixing.mix(rows.select("doc_id", "text", "source", F.col(key).alias("_key")), key_col="_key").where("passes > 0")
    times = scratch.keep(taken.select(F.col("_key").alias(key), F.col("passes").cast("int").alias("__passes")), "times")
    met = rows.join(ngram_jaccard.bounded_broadcast(times), key)
    return met.select(*docs.columns, F.explode(F.sequence(F.lit(1), "__passes")).alias("__pass")).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that the mix holds, and the digest of what they decode to."""
    coded = bpe.encode_documents(docs.select("doc_id", "text"), vocabulary_path())
    return coded.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
    ("BPE encoding", token_ids),
]

#: No stage but secrets and mixing can be written in SQL, so the whole cannot; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        with passing():
            docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
