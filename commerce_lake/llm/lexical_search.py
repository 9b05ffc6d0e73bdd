"""Ranked lexical search by dense blocked matrix multiplication.

The terms of all queries form blocks of a bounded size. For each block, documents are read once and
written as postings of its terms. A task multiplies tiles: queries x terms (weights times repeats)
and terms x documents (impacts), dense and in float64, over the terms that both have. All factors are
whole numbers, and terms are cut into panels so narrow that no partial sum of a product can reach
2^53: each panel is exact in whatever order it is added, and panels are added in 64-bit integers.
Each tile hands its best documents on, ties by document id, so that the last ranking sees few rows.

Weights and impacts (whole numbers, rounded down; N documents with terms, L terms in all, n terms
and tf occurrences in the document, df documents with the term):

    weight = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    impact = 10^9 tf / (1000 tf + 12 m),   m = 75 + 25 n N / L
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from commerce_lake.llm.tables import forget, keep

#: Bytes of different terms (and their counts in queries) that a block may hold; sent to all tasks.
BLOCK_BYTES = 8 << 20
#: Documents and queries of a tile, and terms of a panel at most.
DOCS, QUERIES, TERMS = 512, 256, 4096
#: No partial sum reaches this: float64 holds all whole numbers up to it.
EXACT = 1 << 53
#: An impact is below this, whatever the document.
IMPACT = 10**6

#: Bytes that are no part of a term become spaces, A-Z become a-z.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and all other characters beyond ASCII; A-Z lower-cased."""
    return text.translate(_LETTERS).split()


def query_terms(queries: DataFrame, *, id: str = "item_id", text: str = "text") -> DataFrame:
    """(query, term, repeats) of each query; one without terms has no row.

    Queries with the same id (null is one) are put together, as one list of terms.
    """
    kind = queries.schema[id].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, terms, repeats = [], [], []
            for row, value in enumerate(pc.cast(batch.column(1), pa.large_binary())):
                for term, n in Counter(terms_of(value.as_py() or b"")).items():
                    rows.append(row)
                    terms.append(term.decode())
                    repeats.append(n)
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(terms, pa.string()), pa.array(repeats, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["query", "term", "repeats"])

    counted = queries.select(id, text).mapInArrow(count, f"query {kind}, term string, repeats bigint")
    return counted.groupBy("query", "term").agg(F.sum("repeats").alias("repeats"))


def _blocks(terms: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Terms with the block of their query; and the number of blocks.

    Queries are dealt by a hash into blocks of `block_bytes` at most on average. One that takes more
    than a quarter of a block by itself is cut: dealt term by term, and its blocks' scores added up.
    """
    size = F.sum(F.octet_length("term") + 64).over(Window.partitionBy("query"))
    total = terms.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    if total <= block_bytes:
        return terms.withColumns({"block": F.lit(0), "cut": F.lit(False)}), 1
    blocks = -(-2 * total // block_bytes)
    marked = terms.withColumn("cut", size > block_bytes // 4)
    dealt = F.when(F.col("cut"), F.xxhash64("query", "term")).otherwise(F.xxhash64("query"))
    return keep(marked.withColumn("block", F.pmod(dealt, F.lit(blocks)).cast("int")), "query_blocks"), blocks


def postings(docs: DataFrame, vocabulary: list[str], *, id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(doc, n_terms, terms, counts, digest) of each row: how many terms it has, which of the
    vocabulary (by number) and how often; on request a digest of its text."""
    kind = docs.schema[id].dataType.simpleString()
    words = " ".join(vocabulary).encode()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: k for k, term in enumerate(words.split())}
        for batch in batches:
            n_terms, terms, counts, ends, digests = [], [], [], [0], []
            for value in pc.cast(batch.column(1), pa.large_binary()):
                value = value.as_py() or b""
                found = terms_of(value)
                n_terms.append(len(found))
                for term, n in Counter(found).items():
                    k = number.get(term)
                    if k is not None:
                        terms.append(k)
                        counts.append(n)
                ends.append(len(terms))
                digests.append(hashlib.sha256(value).digest() if digest else None)
            at = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, t)) for x, t in ((terms, pa.int32()), (counts, pa.int64()))]
            columns = [batch.column(0), pa.array(n_terms, pa.int64()), *lists, pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n_terms", "terms", "counts", "digest"])

    kinds = f"doc {kind}, n_terms bigint, terms array<int>, counts array<bigint>, digest binary"
    return docs.select(id, text).mapInArrow(count, kinds)


def document_counts(table: DataFrame) -> DataFrame:
    """(term, df) over written postings: added up in each batch before anything is shuffled."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.bincount(pc.list_flatten(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64))
            held = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held])], ["term", "df"])

    return table.select("terms").mapInArrow(add, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def panels(weights: np.ndarray, terms: int = TERMS) -> list[slice]:
    """Cuts the columns of queries x terms (whole numbers) into runs in which no query's sum of
    weights times the largest impact reaches EXACT."""
    width = weights.shape[1]
    if width <= terms and int(weights.sum(axis=1).max(initial=0)) * IMPACT < EXACT:
        return [slice(0, width)]
    cuts, start = [], 0
    total = np.zeros(len(weights), np.int64)
    for column in range(width):
        total = total + weights[:, column]
        if column > start and (column - start == terms or int(total.max()) * IMPACT >= EXACT):
            cuts.append(slice(start, column))
            start, total = column, weights[:, column].copy()
    return [*cuts, slice(start, width)]


def multiply(weights: np.ndarray, impacts: np.ndarray) -> np.ndarray:
    """weights (queries x terms) @ impacts (terms x documents), exactly, in 64-bit integers."""
    total = np.zeros((weights.shape[0], impacts.shape[1]), np.int64)
    high = weights.max(initial=0)
    # A single weight may be too large by itself (a term that a query repeats very often).
    step = (EXACT - 1) // IMPACT
    while high > 0:
        part = np.minimum(weights, step)
        for cut in panels(part):
            total += (part[:, cut].astype(np.float64) @ impacts[cut].astype(np.float64, copy=False)).astype(np.int64)
        weights = weights - part
        high -= step
    return total


def best(scores: np.ndarray, top: int) -> np.ndarray:
    """Columns of the `top` largest positive scores of a row, of equal ones the first."""
    held = np.flatnonzero(scores > 0)
    if len(held) > top:
        least = np.partition(scores[held], len(held) - top)[len(held) - top]
        above = held[scores[held] > least]
        held = np.concatenate([above, held[scores[held] == least][: top - len(above)]])
    return held[np.lexsort((held, -scores[held]))]


def _search_block(table: DataFrame, asked: list, kind: T.DataType, top: int, documents: int, length: int) -> DataFrame:
    """(query, cut, doc, digest, score): each task's best documents for each of the queries, or all
    of a query that is cut. `asked`: (query, cut, number of term, repeats)."""
    dfs = {r["term"]: r["df"] for r in document_counts(table).collect()}  # a block's terms
    number: dict = {}
    names, entries = [], []
    for query, cut, term, repeats in asked:
        if query not in number:
            number[query] = len(names)
            names.append((query, cut))
        value = weight(dfs[term], documents) * repeats if term in dfs else 0
        if value:
            entries.append((number[query], term, value))
    entries = np.array(sorted(entries), np.int64).reshape(-1, 3)
    tiles = []
    for first in range(0, len(names), QUERIES):
        a, b = np.searchsorted(entries[:, 0], [first, first + QUERIES])
        if b > a:
            terms, column = np.unique(entries[a:b, 1], return_inverse=True)
            size = min(QUERIES, len(names) - first)
            tiles.append((first, size, terms, entries[a:b, 0] - first, column, entries[a:b, 2]))
    query_ids = pa.array([q for q, _ in names], to_arrow_type(kind))
    is_cut = [c for _, c in names]
    known_terms = 1 + max((int(t[2][-1]) for t in tiles), default=-1)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in names]  # (scores, documents) that are best so far
        column_of = np.full(known_terms, -1, np.int64)
        for batch in batches:
            batch = batch.take(pc.sort_indices(batch.column(0)))
            m = np.array([75 + 25 * n * documents // max(1, length) for n in batch.column(1).to_pylist()], np.int64)
            for first in range(0, len(batch), DOCS):
                some = batch.slice(first, DOCS)
                terms, tf = (pc.list_flatten(some.column(k)).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3))
                sizes = pc.list_value_length(some.column(2)).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(len(some)), sizes)
                impact = 10**9 * tf // (1000 * tf + 12 * m[first + doc])
                wanted = terms < known_terms
                doc, terms, impact = doc[wanted], terms[wanted], impact[wanted]
                for start, size, vocabulary, row, column, value in tiles:
                    column_of[vocabulary] = np.arange(len(vocabulary))
                    place = column_of[terms]
                    column_of[vocabulary] = -1
                    here = place >= 0
                    used, at = np.unique(place[here], return_inverse=True)
                    if not len(used):
                        continue
                    impacts = np.zeros((len(used), len(some)), np.float64)
                    impacts[at, doc[here]] = impact[here]
                    compact = np.full(len(vocabulary), -1, np.int64)
                    compact[used] = np.arange(len(used))
                    on = compact[column] >= 0
                    weights = np.zeros((size, len(used)), np.int64)
                    weights[row[on], compact[column[on]]] = value[on]
                    scores = multiply(weights, impacts)
                    for q in range(size):
                        if is_cut[start + q]:
                            picked = pa.array(np.flatnonzero(scores[q]))
                            if len(picked):
                                yield _rows(query_ids, start + q, True, some.column(0).take(picked), some.column(4).take(picked), scores[q, picked])
                            continue
                        picked = best(scores[q], top)
                        if len(picked):
                            held[start + q].append((scores[q, picked], some.column(0).take(pa.array(picked))))
                            if len(held[start + q]) > 16:
                                held[start + q] = [_best_of(held[start + q], top)]
        for q, parts in enumerate(held):
            if parts:
                scores, docs = _best_of(parts, top)
                yield _rows(query_ids, q, False, docs, pa.nulls(len(docs), pa.binary()), scores)

    doc_kind = table.schema["doc"].dataType.simpleString()
    return table.mapInArrow(rank, f"query {kind.simpleString()}, cut boolean, doc {doc_kind}, digest binary, score bigint")


def _best_of(parts: list, top: int) -> tuple[np.ndarray, pa.Array]:
    """The best of several (scores, documents), of equal ones the smallest document."""
    scores = np.concatenate([s for s, _ in parts])
    docs = pa.concat_arrays([d for _, d in parts])
    place = np.empty(len(docs), np.int64)
    place[pc.sort_indices(docs).to_numpy()] = np.arange(len(docs))
    order = np.lexsort((place, -scores))[:top]
    return scores[order], docs.take(pa.array(order))


def _rows(query_ids: pa.Array, q: int, cut: bool, docs: pa.Array, digests: pa.Array, scores: np.ndarray) -> pa.RecordBatch:
    n = len(scores)
    columns = [query_ids.take(pa.array([q] * n)), pa.array([cut] * n), docs, digests, pa.array(scores.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["query", "cut", "doc", "digest", "score"])


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    *,
    top: int = 20,
    id: str = "doc_id",
    text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(query id, rank, document id, score): the `top` highest-scoring documents of each query.

    Only scores above 0 count; equal scores go by ascending document id, null last, and rows
    repeated under one id count each. Null and empty texts have no terms: such a document scores 0
    and counts in neither N nor L, such a query has no rows. Without documents there are none.
    Other columns are not read.
    """
    kind = queries.schema[query_id].dataType
    terms = keep(query_terms(queries, id=query_id, text=query_text), "query_terms")
    terms, blocks = _blocks(terms, block_bytes)
    found = None
    for block in range(blocks):
        asked = terms.where(F.col("block") == block).collect()  # `block_bytes` on average
        vocabulary = sorted({r["term"] for r in asked})
        number = {term: k for k, term in enumerate(vocabulary)}
        table = keep(postings(docs, vocabulary, id=id, text=text, digest=any(r["cut"] for r in asked)), "postings")
        total = table.agg(F.count_if(F.col("n_terms") > 0).alias("docs"), F.sum("n_terms").alias("terms")).first()
        asked = [(r["query"], r["cut"], number[r["term"]], r["repeats"]) for r in asked]
        best = _search_block(table, asked, kind, top, total["docs"], total["terms"] or 0)
        best = keep(best.withColumn("block", F.lit(block)), "block_best")
        forget(table)
        found = best if found is None else found.union(best)
    whole = found.where("NOT cut").select("query", "doc", "score")
    if blocks > 1:  # rows of one id and text are counted, since each block has as many of them
        row = ["query", "doc", "digest"]
        parts = found.where("cut").groupBy(*row, "block").agg(F.max("score").alias("score"), F.count("*").alias("rows"))
        summed = parts.groupBy(*row).agg(F.sum("score").alias("score"), F.max("rows").alias("rows"))
        copies = F.explode(F.sequence(F.lit(1), F.least("rows", F.lit(top))))
        whole = whole.union(summed.select("query", "doc", "score", copies.alias("_")).drop("_"))
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = whole.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
    return ranked.select(F.col("query").alias(query_id), "rank", F.col("doc").alias(id), "score")
