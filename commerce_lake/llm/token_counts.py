"""Token totals by source, language and tokenizer version, kept up to date by signed changes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tokenizer version -> what a text's tokens are, as a pattern.
PATTERNS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-1": r"[0-9A-Za-z\x80-\x{10FFFF}]+|[^0-9A-Za-z\x80-\x{10FFFF}\x20\x09-\x0D]",
}


def pattern_counts(text: Column, patterns: dict[str, str] = PATTERNS) -> Column:
    """Array of (tokenizer, tokens); a null text has none."""
    body = F.coalesce(text, F.lit(""))
    return F.array(
        *[
            F.struct(F.lit(v).alias("tokenizer"), F.regexp_count(body, F.lit(p)).cast("long").alias("tokens"))
            for v, p in sorted(patterns.items())
        ]
    )


def vocabulary_counts(df: DataFrame, text: str, vocabulary: str, version: str) -> DataFrame:
    """Add `counts` like pattern_counts, by a tokenizer file (`tokenizers` JSON), batch by batch."""
    kind = T.ArrayType(T.StructType().add("tokenizer", T.StringType()).add("tokens", T.LongType()))
    out = T.StructType([*df.schema, T.StructField("counts", kind)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        encode = Tokenizer.from_file(vocabulary).encode
        for batch in batches:
            found = [
                [{"tokenizer": version, "tokens": len(encode(t or "", add_special_tokens=False).ids)}]
                for t in batch.column(text).to_pylist()
            ]
            kind = pa.list_(pa.struct([("tokenizer", pa.string()), ("tokens", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "counts"])

    return df.mapInArrow(count, out)


@dataclass
class TokenRollup:
    """Additive token totals in a folder all executors share.

    Each batch of changes becomes one folder of signed rows, `entries/batch=<name>`: an insert adds
    a document's counts, a delete takes away what stands for it, a revision does both. A batch
    counts once its marker under `commits` is written, which is done last: a batch that failed
    half way is invisible and is overwritten when sent again; one that was committed is not
    applied again. Totals are plain sums, so batches of different documents may come in any order.

    `count` maps a frame with a text to one with `counts` (array of tokenizer and tokens).
    """

    spark: SparkSession
    folder: str
    count: Callable[[DataFrame], DataFrame] = field(
        default=lambda df: df.withColumn("counts", pattern_counts(F.col("text")))
    )

    _ENTRY = "doc_id bigint, source string, lang string, tokenizer string, docs bigint, tokens bigint"

    def committed(self) -> list[str]:
        """Names of the batches that count; a few bytes a batch."""
        try:
            found = self.spark.read.schema("batch string").parquet(f"{self.folder}/commits/*")
        except Exception as missing:
            if "PATH_NOT_FOUND" in str(missing):
                return []
            raise
        return sorted(r["batch"] for r in found.collect())

    def entries(self) -> DataFrame:
        """Signed rows of all committed batches."""
        paths = [f"{self.folder}/entries/batch={b}" for b in self.committed()]
        if not paths:
            return self.spark.createDataFrame([], self._ENTRY)
        return self.spark.read.schema(self._ENTRY).parquet(*paths)

    def standing(self) -> DataFrame:
        """What counts at present, by document."""
        keys = ["doc_id", "source", "lang", "tokenizer"]
        return self.entries().groupBy(*keys).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0")

    def apply(self, batch: str, changes: DataFrame, *, counted: bool = False) -> bool:
        """Commit `changes` (op, doc_id, source, lang, text); False if `batch` is committed already.

        With `counted`, they have `counts` in place of the text.

        op is insert, delete or revise; other values fail. A delete needs only the doc_id. A
        delete of an unknown document changes nothing, a revision of one inserts it. Rows without
        doc_id can be inserted but not found again. Several inserts of one document add up (each
        counts as a row of the table it stands for); several deletes or revisions of one document
        within a batch take away what stood before it once. Null sources and languages are groups
        of their own. A null text has no tokens. Extra columns are ignored.
        """
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        if batch in self.committed():
            return False
        known = F.col("op").isin("insert", "delete", "revise")
        changes = changes.withColumn(
            "op", F.when(known, F.col("op")).otherwise(F.raise_error(F.concat(F.lit("unknown op: "), F.coalesce("op", F.lit("null")))))
        )
        new = changes.where("op <> 'delete'").select("doc_id", "source", "lang", "counts" if counted else "text")
        added = (
            (new if counted else self.count(new))
            .select("doc_id", "source", "lang", F.explode("counts").alias("c"))
            .select("doc_id", "source", "lang", "c.tokenizer", F.lit(1).cast("long").alias("docs"), "c.tokens")
        )
        gone = changes.where("op <> 'insert'").select("doc_id")
        removed = self.standing().join(gone, "doc_id", "left_semi")
        removed = removed.select("doc_id", "source", "lang", "tokenizer", (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        added.unionByName(removed).write.mode("overwrite").parquet(f"{self.folder}/entries/batch={batch}")
        mark = self.spark.createDataFrame([(batch,)], "batch string").coalesce(1)
        mark.write.mode("overwrite").parquet(f"{self.folder}/commits/{batch}")
        return True

    def totals(self) -> DataFrame:
        """Documents and tokens by source, lang and tokenizer; groups that came to nothing are left out."""
        keys = ["source", "lang", "tokenizer"]
        sums = self.entries().groupBy(*keys).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 OR tokens <> 0")
