"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of documents; the
last returns the packed pieces. `run` writes each result as Parquet in the shared folder and reads
it again, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.llm.decontamination import contamination, row_key
from commerce_lake.llm.line_dedup import dedup_lines
from commerce_lake.llm.ngram_join import linked_documents
from commerce_lake.llm.packing import pack, token_pieces
from commerce_lake.llm.queries import BYTE_BPE, TOXIC_FROM, bucket
from commerce_lake.llm.tables import keep, left_by_size, read_table
from commerce_lake.llm.toxicity import learn, score

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below TOXIC_FROM."""
    weights = learn(docs, read_table(spark, sf_dir, "labels"), learn_from=bucket(4) != 2)
    return score(docs.select(COLUMNS), weights).where(F.col("score") < TOXIC_FROM).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat."""
    cleaned = dedup_lines(docs.select(COLUMNS))
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0))).select(COLUMNS)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents one row: the one with the smallest id, of those the one with
    the smallest hash of id and text; a row without id only where none has one. Rows repeated as a
    whole are one too. Rows without n-grams all stay."""
    linked = linked_documents(docs)
    chosen = linked.where("group IS NOT NULL").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"))
    chosen = keep(chosen.select(F.col("first.row_key").alias("doc")).withColumn("chosen", F.lit(True)), "chosen_rows")
    bare = keep(linked.where("group IS NULL").select(F.col("row_key").alias("doc")).distinct().withColumn("bare", F.lit(True)), "bare_rows")
    marked = docs.select(*COLUMNS, row_key("doc_id", "text").alias("doc"))
    marked = left_by_size(left_by_size(marked, chosen, "doc", 16), bare, "doc", 16)
    # Rows of the same id and text may differ in the other columns: the first by these stays.
    rest = F.struct(*[c for c in COLUMNS if c not in ("doc_id", "text")])
    one = marked.where("chosen").groupBy("doc").agg(F.min(F.struct(rest.alias("rest"), "doc_id", "text")).alias("row"))
    one = one.select(*[F.col(f"row.{c}" if c in ("doc_id", "text") else f"row.rest.{c}").alias(c) for c in COLUMNS])
    return one.union(marked.where("bare").select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are passages of benchmark items."""
    found = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    bad = keep(found.where("contaminated").select("doc").distinct(), "contaminated_rows")
    marked = docs.select(*COLUMNS, row_key("doc_id", "text").alias("doc"))
    return left_by_size(marked, bad.withColumn("bad", F.lit(True)), "doc", 16).where("bad IS NULL").select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return pack(token_pieces(docs, **BYTE_BPE))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: A trained score and a tokenizer have no SQL. Tests hold the n-gram stage against brute force, and of the
#: other stages the columns and what they keep; their operators have tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
