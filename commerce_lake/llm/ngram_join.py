"""Links between documents whose sets of word n-grams are similar (Jaccard)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.linking import linked_components, sketch_apart
from commerce_lake.llm.tables import keep, left_by_size, semi_by_size
from commerce_lake.llm.text import shingles

#: Similarity as a fraction, so that the test is exact: 100 * intersection >= 75 * union.
SIMILAR, OF = 75, 100
#: Counters of the sketch that n-grams are ordered by, and how many make a row of it.
COUNTERS, SLICE = 1 << 24, 1 << 18
_AT = (1 << 32) - 1
#: Parts of the hash space that the suffix filter counts.
PARTS = 64
#: Bits of the sketch of a set, which tells sets apart before they are compared.
SKETCH = 1024
#: Parts of the postings that are shuffled one after another, for less disk at a time.
SLICES = 3


def _id(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def _parts(grams: np.ndarray) -> bytes | None:
    counts = np.bincount((grams >> np.uint64(58)).astype(np.int64), minlength=PARTS)
    return counts.astype(np.uint16).tobytes() if counts.max(initial=0) < 1 << 16 else None


def _sketch(grams: np.ndarray) -> np.ndarray:
    odd = np.bincount((grams & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a document, and at the end the task's part of the sketch."""
    marks = [f"p{k}" for k in range(SKETCH // 64)]
    names = ["row_key", "doc_id", "n", "id", "parts", *marks, "slice", "counts"]
    sketch = np.zeros(COUNTERS, np.uint32)
    ids = None
    for batch in batches:
        n, id, parts, odd = [], [], [], np.zeros((len(batch), len(marks)), np.int64)
        for row, grams in shingles(batch.column(2)):
            n.append(len(grams))
            odd[row] = _sketch(grams)
            id.append(_id(grams) if len(grams) else None)
            parts.append(_parts(grams))
            np.add.at(sketch, (grams & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        ids = batch.schema.field(1).type
        rest = [pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(id, pa.int64()), pa.array(parts, pa.binary()), *[pa.array(x) for x in odd.T.copy()], *rest], names)
    if ids is not None:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        blobs = [squeeze(part.tobytes()) for part in sketch.reshape(-1, SLICE)]
        k = len(blobs)
        yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, ids), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), *[pa.nulls(k, pa.int64()) for _ in marks], pa.array(range(k), pa.int32()), pa.array(blobs, pa.binary())], names)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for k, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total[k] = total.get(k, np.zeros(SLICE, np.uint64)) + np.frombuffer(expand(blob.as_py()), np.uint32)
    if total:
        # A byte a counter: eight classes for each doubling, as rarer than that makes no difference.
        classes = [np.minimum(255, 8 * np.log2(1.0 + v)).astype(np.uint8).tobytes() for v in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array(classes, pa.binary())], ["slice", "classes"])


def linked_documents(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, set_id, group, row_key) of every row.

    Two documents are linked if their sets of distinct five-word runs (white space parts words, A-Z
    count as a-z, fewer words are one run) have a Jaccard similarity of at least 0.75;
    `component_id` is the smallest id reachable by links. Whole texts count. Runs are compared by
    64-bit hashes, sets of runs by a 64-bit digest.

    Documents with equal sets are one node. All n-grams are in one order, rare ones first; which are
    rare is estimated from the counts of all of them in a sketch of fixed size, so the order is the
    same everywhere and any order gives the right links. A document's first n - ceil(0.75 n) + 1
    n-grams are its prefix: similar sets share one, and their first common one cannot lie so far
    back in either that too little is left (length and positional filter). Pairs that pass are held
    against counts of n-grams in 64 parts of the hash space, an upper bound of the overlap (suffix
    filter), then verified on the whole sets, once.

    Null and empty texts, and those of white space, have no n-grams and are linked with nothing.
    Rows without id can link others; a component without any id has a null component_id. An id that
    is there with several texts can be the smallest of several components; `group` tells components
    apart (null without n-grams). `row_key` is a hash of id and text. Repeated
    rows are each returned. Other columns of `docs` are not carried.
    """
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.xxhash64(id, text).alias("row_key"), F.col(id).alias("doc_id"), F.col(text).alias("text"))
    marks = ", ".join(f"p{k} bigint" for k in range(SKETCH // 64))
    described = keep(rows.mapInArrow(_describe, f"row_key bigint, doc_id {kind}, n int, id bigint, parts binary, {marks}, slice int, counts binary"), "ngram_sets")
    info = described.where("slice IS NULL").drop("slice", "counts")
    slices = described.where("slice IS NOT NULL").select("slice", "counts").repartition(COUNTERS // SLICE, "slice")
    found = dict(r for r in slices.mapInArrow(_add_up, "slice int, classes binary").collect())  # COUNTERS bytes
    rarity = np.frombuffer(b"".join(found.get(k, bytes(SLICE)) for k in range(COUNTERS // SLICE)), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, seen = shared.value, set()
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for _, grams in shingles(batch.column(0)):
                n = len(grams)
                node = _id(grams)
                if not n or node in seen:
                    continue
                seen.add(node)
                order = rarity[(grams & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
                order |= grams >> np.uint64(8)
                k = n - -(-SIMILAR * n // OF) + 1
                out.append((grams[np.argsort(order, kind="stable")[:k]], node, n, k))
                size += k
                if size > 500_000:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

    postings = docs.select(text).mapInArrow(prefixes, "gram bigint, node bigint, about bigint")
    sets = info.where("n > 0").groupBy("id").agg(
        F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"), F.min("parts").alias("parts"), F.count("*").alias("weight"),
        F.first("n").alias("n"), *[F.first(f"p{k}").alias(f"p{k}") for k in range(SKETCH // 64)],
    )
    sets = keep(sets, "ngram_nodes")

    def verify(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that are similar indeed."""
        pairs = keep(_bounded(pairs, sets), "ngram_pairs")
        nodes = keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ngram_wanted")
        keys = semi_by_size(sets.select("id", "row_key"), nodes, "id").select("row_key").distinct()
        wanted = semi_by_size(rows, keep(keys, "ngram_rows"), "row_key").select("text").mapInArrow(_sets, "id bigint, grams array<bigint>")
        # Not written: the shuffle that brings repeats of a row together is also that of both joins.
        wanted = wanted.dropDuplicates(["id"])
        side = lambda x: wanted.select(F.col("id").alias(x), F.col("grams").alias(f"{x}_grams"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        common = F.size(F.array_intersect("a_grams", "b_grams"))
        return both.where(OF * common >= SIMILAR * (F.size("a_grams") + F.size("b_grams") - common)).select("a", "b")

    def plausible(x: Column, y: Column) -> Column:
        # I >= 3/4 (n + m - I) is 7 I >= 3 (n + m); what follows a first common n-gram bounds I.
        n, m = F.shiftright(x, 32), F.shiftright(y, 32)
        left = F.least(n - x.bitwiseAND(F.lit(_AT)), m - y.bitwiseAND(F.lit(_AT)))
        return (SIMILAR + OF) * left >= SIMILAR * (n + m)

    def close(x: Column, y: Column) -> Column:
        # Of n + m n-grams at most a seventh (at 0.75) are in one of the sets alone.
        return (SIMILAR + OF) * sketch_apart(x, y, SKETCH) <= (OF - SIMILAR) * (x["n"] + y["n"])

    def sketches(nodes: DataFrame) -> DataFrame:
        found = sets.select(F.col("id").alias("node"), F.struct("n", *[f"p{k}" for k in range(SKETCH // 64)]).alias("sketch"))
        return semi_by_size(found, nodes, "node")

    linked = keep(linked_components(postings, ["gram"], sets.select(F.col("id").alias("node"), "weight"), plausible, verify, sketches, close, SLICES), "ngram_components")
    named = sets.select(F.col("id").alias("node"), "doc_id").join(linked, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = keep(named.join(smallest, "component").select(F.col("node").alias("id"), "component_id", F.col("component").alias("group")), "ngram_named")
    return info.join(named, "id", "left").select(
        F.col("doc_id").alias(id),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("id").alias("set_id"),
        "group",
        "row_key",
    )


def _batch(prefixes: list[tuple]) -> pa.RecordBatch:
    """Postings; `about` is the size of the set and, in the lower half, the place in the prefix."""
    k = [p[3] for p in prefixes]
    node = np.repeat(np.array([p[1] for p in prefixes], np.int64), k)
    about = np.repeat(np.array([p[2] for p in prefixes], np.int64) << 32, k) | np.concatenate([np.arange(i) for i in k])
    grams = np.concatenate([p[0] for p in prefixes]).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(node), pa.array(about)], ["gram", "node", "about"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, grams, size = [], [], 0
        for row, found in shingles(batch.column(0)):
            ids.append(_id(found))
            grams.append(found.view(np.int64))
            size += len(found)
            if size > 500_000 or row == len(batch) - 1:
                at = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(grams)))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), flat], ["id", "grams"])
                ids, grams, size = [], [], 0


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose counts in each part of the hash space allow for the similarity."""
    # Few sets are in pairs; only their counts are sent to both ends.
    pairs = keep(pairs, "bound_pairs")
    ends = keep(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "bound_nodes")
    counts = keep(semi_by_size(sets.select("id", "parts"), ends, "id"), "bound_parts")
    for x in ("a", "b"):
        pairs = left_by_size(pairs, counts.select(F.col("id").alias(x), F.col("parts").alias(f"{x}_parts")), x, 200)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column("a_parts").to_pylist(), batch.column("b_parts").to_pylist(), strict=True):
                if a is None or b is None:
                    ok.append(True)
                    continue
                x, y = np.frombuffer(a, np.uint16).astype(np.int64), np.frombuffer(b, np.uint16).astype(np.int64)
                ok.append(bool((SIMILAR + OF) * np.minimum(x, y).sum() >= SIMILAR * (x.sum() + y.sum())))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("a", "b", "a_parts", "b_parts").mapInArrow(bound, "a bigint, b bigint")
