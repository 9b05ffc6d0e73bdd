"""Vector bin packing of documents into shards of equal bytes, tokens and rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.tables import keep, numbered

#: Cells a shard; what the driver places is at most twice as many vectors as there are cells.
CELLS = 512
#: Parts that a whole shard of one group would be cut into.
CUT = 64


def place(sizes: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each vector (row of `sizes`): largest first, where the dot product with the
    residual capacity is highest; each resource is scaled to a total of 1 over all bins.

    At most a few times `bins` * CELLS vectors ever come here. Ties go to the lower bin.
    """
    total = sizes.sum(0)
    parts = sizes / np.where(total > 0, total, 1)
    left = np.full((bins, sizes.shape[1]), 1 / bins)
    to = np.zeros(len(sizes), np.int64)
    for i in np.lexsort((np.arange(len(sizes)), -parts.sum(1))):
        # A vector outgrowing a residual counts against that bin in proportion.
        over = np.minimum(left - parts[i], 0).sum(1)
        to[i] = int(np.argmax(np.where(over < 0, over * 1e6, left @ parts[i])))
        left[to[i]] -= parts[i]
    return to


def shard_documents(docs: DataFrame, shards: int, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_crc32, size, tokens, group_id, shard, slot) of every row.

    `size` is the UTF-8 bytes of the text plus 8, `tokens` its words; a null text counts as an
    empty one. Rows with equal texts form a group, which stays together as long as it is smaller
    than a cell (1/CELLS of a shard); a larger group is one vector of its own, up to half a shard.
    Beyond that (say, a third of all rows in one group) no shard could hold it beside others, and
    it is cut into vectors of a CUT-th of a shard by a hash of the id.

    Small groups are dealt by a hash of the text to shards * CELLS cells. Cells and large groups,
    a number that does not grow with the data, are the vectors that `place` packs. `slot` numbers
    the rows of a shard from 0 without gaps. Null ids are kept; equal rows are interchangeable.
    No rows give no rows. Other columns of `docs` are not carried.
    """
    cells = shards * CELLS
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).alias("_id"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("group_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.coalesce(F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("tokens"),
    )
    rows = keep(rows, "shard_rows")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = rows.agg(*sums).first()
    n = total["rows"]
    if not n:
        return rows.select(F.col("_id").alias(id), "text_crc32", "size", "tokens", "group_id", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    share = F.greatest(*[F.col(c) / F.lit(float(max(1, total[c]))) for c in ("size", "tokens", "rows")])
    # A group above the mean cell in any resource: fewer than 3 * cells of them.
    large = keep(
        rows.groupBy("group_id").agg(*sums).where(share > 1.0 / cells)
        .select("group_id", F.when(share * 2 * shards <= 1, 1).otherwise(F.ceil(share * CUT * shards)).cast("int").alias("cuts")),
        "shard_large",
    )
    rows = rows.join(F.broadcast(large), "group_id", "left")
    rows = rows.withColumn(
        "vector",
        F.when(F.col("cuts").isNull(), F.pmod("group_id", F.lit(cells)))
        .otherwise(F.xxhash64("group_id", F.when(F.col("cuts") > 1, F.pmod(F.xxhash64("_id"), "cuts")))),
    ).withColumn("vector", F.when(F.col("cuts").isNull(), F.col("vector")).otherwise(F.col("vector").bitwiseOR(F.lit(-(1 << 63)))))
    vectors = rows.groupBy("vector").agg(*sums).orderBy("vector").toPandas()  # at most 4 * cells + CUT * shards * 3
    vectors["shard"] = place(vectors[["size", "tokens", "rows"]].to_numpy(float), shards)
    plan = docs.sparkSession.createDataFrame(vectors[["vector", "shard"]].astype({"shard": "int32"}))
    placed = keep(rows.join(F.broadcast(plan), "vector").drop("vector", "cuts"), "shard_placed")
    out = numbered(placed, "shard", ["_id", "text_crc32", "group_id"], "slot", n)
    return out.select(F.col("_id").alias(id), "text_crc32", "size", "tokens", "group_id", "shard", F.col("slot").cast("long").alias("slot"))
