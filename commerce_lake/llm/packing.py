"""Packing of tokenised documents into sequences by minimum bin slack, with and without seeds."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.tables import keep, numbered

#: Beyond these letters the two tokenizer libraries may class characters by other Unicode versions.
_UNCOMMON = re.compile("[^\x00-ɏ]")
#: Largest pieces that a bin begins with, in the plans that are tried; 0 is plain minimum bin slack.
SEEDS = (0, 1, 2, 3)


def encoder(vocabulary: str, ranks: str | None = None, pattern: str | None = None):
    """text -> array of ids, as `tokenizers` gives them for the file `vocabulary`.

    With `ranks` and `pattern`, a tiktoken file of the same vocabulary, common texts are encoded by
    tiktoken, which gives the same ids four times as fast; texts with uncommon characters or the
    name of an added token are left to `tokenizers`.
    """
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)

    def slow(text: str) -> np.ndarray:
        return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)

    if not ranks:
        return slow
    import base64

    import tiktoken

    with open(ranks, "rb") as lines:
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=known, special_tokens={})
    added = [re.escape(t.content) for t in exact.get_added_tokens_decoder().values()]
    leave = re.compile("|".join([_UNCOMMON.pattern, *added]))

    def encode(text: str) -> np.ndarray:
        return slow(text) if leave.search(text) else np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def token_pieces(
    docs: DataFrame, *, vocabulary: str, ranks: str | None = None, pattern: str | None = None,
    end_id: int = 2, capacity: int = 1024, id: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32 and, on request, ids) of every document's pieces.

    A document is its tokens and `end_id`; a null text counts as empty, so its one piece is the end.
    A document of more than `capacity` is cut into pieces of `capacity`, of which the first may be
    shorter. Null and repeated ids are kept.
    """
    kinds = [(id, docs.schema[id].dataType.simpleString()), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint")]
    kinds += [("ids", "array<int>")] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks, pattern)
        for batch in batches:
            of, piece, start, length, crc, ids = [], [], [], [], [], []
            for row in range(len(batch)):
                tokens = np.append(encode(batch.column(1)[row].as_py() or ""), np.uint32(end_id)).astype("<u4")
                n = len(tokens)
                cuts = [0, *range(n - (n - 1) // capacity * capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    of.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(tokens[a:b].tobytes()))
                    if with_ids:
                        ids.append(tokens[a:b].astype(np.int32))
            columns = [batch.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            columns += [pa.array(ids, pa.list_(pa.int32()))] * with_ids
            yield pa.RecordBatch.from_arrays(columns, [k for k, _ in kinds])

    return docs.select(id, text).mapInArrow(cut, ", ".join(f"`{k}` {t}" for k, t in kinds))


def fullest(lengths: list[int], counts: list[int], capacity: int) -> dict[int, int]:
    """The lengths (and how many of each) with the largest sum within `capacity`.

    Reachable sums are the bits of an integer; lengths (ascending) are added one after another. Of
    equal sums it takes the one with the most of the longest lengths.
    """
    mask = (1 << (capacity + 1)) - 1
    bits, before = 1, []
    for length, count in zip(lengths, counts, strict=True):
        before.append(bits)
        rest, step = min(count, capacity // length), 1
        while rest:
            step = min(step, rest)
            bits |= (bits << (length * step)) & mask
            rest -= step
            step *= 2
    target, chosen = bits.bit_length() - 1, {}
    for i in range(len(lengths) - 1, -1, -1):
        if not target:
            break
        for k in range(min(counts[i], target // lengths[i]), -1, -1):
            if before[i] >> (target - k * lengths[i]) & 1:
                break
        if k:
            chosen[lengths[i]] = k
            target -= k * lengths[i]
    return chosen


def seeded(lengths: dict[int, int], capacity: int, seeds: int) -> tuple[dict[int, int], int]:
    """The `seeds` largest pieces that fit a bin one after another, and the room they leave."""
    filling, room, free = {}, capacity, seeds
    for length in sorted(lengths, reverse=True):
        k = min(free, lengths[length], room // length)
        if k:
            filling[length] = k
            room -= k * length
            free -= k
        if not free or not room:
            break
    return filling, room


def fill_bins(counts: dict[int, int], capacity: int, seeds: int) -> list[tuple[dict[int, int], int]]:
    """(filling, how many bins of it): each bin begins with its `seeds` largest pieces, and the
    fullest combination of what is left completes it.

    A filling is repeated for as long as it stays feasible, so the number of steps depends on
    `capacity` and not on the number of pieces.
    """
    left = {k: v for k, v in sorted(counts.items()) if v}
    plan = []
    while left:
        filling, room = seeded(left, capacity, seeds)
        rest = {k: v - filling.get(k, 0) for k, v in left.items() if k <= room and v > filling.get(k, 0)}
        for k, m in fullest(list(rest), list(rest.values()), room).items():
            filling[k] = filling.get(k, 0) + m
        bins = min(left[k] // m for k, m in filling.items())
        plan.append((filling, bins))
        for k, m in filling.items():
            left[k] -= m * bins
            if not left[k]:
                del left[k]
    return plan


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """The plan with the fewest bins of those that `fill_bins` makes with SEEDS, and with all
    pieces as seeds; of equal ones the first.

    Without seeds, small pieces are spent early and large ones are left alone; with all pieces as
    seeds this is first-fit decreasing, so the result is never worse than that.
    """
    plans = [fill_bins(counts, capacity, seeds) for seeds in (*SEEDS, capacity)]
    return min(plans, key=lambda plan: sum(bins for _, bins in plan))


def pack(pieces: DataFrame, *, capacity: int = 1024, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """Add sequence_id and offset to pieces (with a `length` of 1 to `capacity`).

    Only the number of pieces of each length goes to the driver, `capacity` numbers. The plan made
    from them says which numbers of which length lie where; pieces are numbered within their
    length without bringing a length together, and look themselves up. Pieces equal in `order` and
    length are interchangeable. No pieces give no rows.
    """
    pieces = keep(pieces, "pieces")
    counts = {int(r["length"]): r["count"] for r in pieces.groupBy("length").count().collect()}
    rows, sequence, used = [], 0, dict.fromkeys(counts, 0)
    for filling, bins in plan_bins(counts, capacity):
        offset = 0
        for length, each in filling.items():
            rows.append((length, used[length], each, sequence, offset))
            used[length] += each * bins
            offset += each * length
        sequence += bins
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    at_length, first = table[:, 0], table[:, 1]

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begins = {int(k): np.searchsorted(at_length, [k, k + 1]) for k in np.unique(at_length)}
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["_rank"].to_numpy()
            row = np.empty(len(batch), np.int64)
            for k in np.unique(length):
                a, b = begins[int(k)]
                own = length == k
                row[own] = a + np.searchsorted(first[a:b], rank[own], "right") - 1
            of = table[row]
            within = rank - of[:, 1]
            yield batch.drop(columns="_rank").assign(sequence_id=of[:, 3] + within // of[:, 2], offset=of[:, 4] + within % of[:, 2] * length)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    ranked = numbered(pieces, "length", list(order), "_rank", sum(counts.values())).select(*pieces.columns, "_rank")
    return ranked.mapInPandas(look_up, f"{kinds}, sequence_id bigint, offset bigint")
