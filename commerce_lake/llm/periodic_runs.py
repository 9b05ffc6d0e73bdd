"""Periodic runs of words by maximal pairs, from an LCP-interval tree.

A run is a stretch of words with smallest period q that is at least `exponent` periods and
`shortest` words long and cannot grow on either side. Its words from i on and from i + q on agree
for l words and no further, and the words before them differ: (i, i + q, l) is a maximal pair with
q <= l / (exponent - 1). The other way round, such a pair is a run with no more to be done: its
stretch begins at i and has l + q words. A multiple of a run's period gives the same stretch, so of
equal stretches the smallest distance counts.

Pairs come from the tree of common prefixes of a document's suffixes, bottom up: each node keeps
its positions in lists by the word to their left, and two children meet list by list, wherever the
left words differ. Distances are bounded by the node's depth, so only that window of a list is
read, and the smaller child is always put into the larger. Positions whose first words occur once
in the document are no part of any such pair; they never enter the tree.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Words whose prefixes are classed at a time; a longer document is taken alone.
BLOCK_WORDS = 1 << 19

_random = np.random.default_rng(20250311)
_MIX = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shallowest(shortest: int, exponent: int) -> int:
    """The fewest words that the two places of a run's maximal pair have in common."""
    return min(max((exponent - 1) * q, shortest - q) for q in range(1, max(2, shortest + 1)))


def _classes(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1)


def _repeated(ids: np.ndarray, last: np.ndarray, depth: int) -> np.ndarray:
    """Positions whose next `depth` words may occur again in their document (others do not)."""
    n = len(ids) - depth + 1
    if n <= 1:
        return np.empty(0, np.int64)
    mixed = last[:n].astype(np.uint64) * _MIX[-1]
    for k in range(depth):
        mixed += ids[k : k + n].astype(np.uint64) * _MIX[k % 63] * np.uint64(2 * (k // 63) + 1)
        mixed ^= mixed >> np.uint64(29)
    at = np.flatnonzero(np.arange(n) + depth <= last[:n])
    order = np.argsort(mixed[at], kind="stable")
    sorted_ = mixed[at][order]
    same = sorted_[1:] == sorted_[:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return at[twice]


def _ordered(ids: np.ndarray, last: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, lcp): positions of repeated words in the order of their suffixes (by document, then
    by word number), and how many words each has in common with the one before (0: below `depth`).

    `last` holds for each position the end of its document. Prefixes are doubled from `depth` words
    on. The places up to `depth` words behind repeated ones, at which common prefixes end, are ranked
    too; each is alone in its class.
    """
    found = _repeated(ids, last, depth)
    if not len(found):
        return found, found
    used = np.zeros(len(ids) + depth + 1, bool)
    for k in range(depth + 1):
        used[(found + k)[found + k < last[found]]] = True
    at = np.flatnonzero(used)
    end = last[at]
    letters = int(ids.max()) + 2
    rank = _classes(end)
    for k in range(depth):
        inside = at + k < end
        rank = _classes(rank * letters + np.where(inside, ids[np.minimum(at + k, len(ids) - 1)] + 1, 0))
    index = np.full(len(ids) + 1, -1, np.int64)
    index[at] = np.arange(len(at))
    levels, reach = [], depth
    while True:
        levels.append((reach, rank))
        if rank.max() + 1 == len(at):
            break
        next_ = index[np.minimum(at + reach, len(ids))]
        inside = (next_ >= 0) & (at + reach < end)
        rank = _classes(rank * (len(at) + 1) + np.where(inside, rank[next_] + 1, 0))
        reach *= 2
    order = np.argsort(rank)
    i, j = at[order[:-1]], at[order[1:]]
    common = np.zeros(len(i), np.int64)
    for reach, rank in reversed(levels):
        a, b = index[np.minimum(i + common, len(ids))], index[np.minimum(j + common, len(ids))]
        equal = (a >= 0) & (b >= 0) & (i + common < last[i]) & (j + common < last[j])
        equal[equal] = rank[a[equal]] == rank[b[equal]]
        common[equal] += reach
    open_ = common >= depth
    for _ in range(depth - 1):  # what is left is shorter than the shortest prefix ranked
        a, b = i + common, j + common
        open_ &= (a < last[i]) & (b < last[j])
        open_[open_] = ids[a[open_]] == ids[b[open_]]
        common[open_] += 1
    common[common < depth] = 0
    return at[order], np.concatenate([[0], common])


def _meet(node: dict, left: int, i: int, depth: int, exponent: int, words, found: dict) -> None:
    """Pairs of position `i` (after word `left`) and a node's positions after another word."""
    window = depth // (exponent - 1)
    if not window:
        return
    if len(node) <= 2 * window:
        others = node.items()
    else:  # more left words than the window has places
        near = {int(w) for w in words[max(0, i - window - 1) : i + window]} | {-1}
        others = [(w, node[w]) for w in near if w in node]
    for word, places in others:
        if word == left:
            continue
        k = bisect_left(places, i - window)
        while k < len(places) and places[k] <= i + window:
            j = places[k]
            start, period = (i, j - i) if i < j else (j, i - j)
            stretch = start, depth + period
            if found.get(stretch, period) >= period:
                found[stretch] = period
            k += 1


def _join(one: dict, two: dict, depth: int, exponent: int, words, found: dict) -> dict:
    """Two children of a node of `depth` meet; the smaller is put into the larger."""
    if sum(map(len, one.values())) < sum(map(len, two.values())) if len(one) + len(two) < 8 else len(one) < len(two):
        one, two = two, one
    for left, places in two.items():
        for i in places:
            _meet(one, left, i, depth, exponent, words, found)
    for left, places in two.items():
        into = one.get(left)
        if into is None:
            one[left] = places
        elif len(places) < 8:
            for i in places:
                insort(into, i)
        else:
            into += places
            into.sort()
    return one


def maximal_pairs(order: list[int], lcp: list[int], words, begins, exponent: int) -> dict[tuple[int, int], int]:
    """(start, length) -> period of all stretches of maximal pairs near enough, by a bottom-up walk
    of the LCP-interval tree. `begins`: positions at which a document begins, which have no left
    word (-1)."""
    found: dict[tuple[int, int], int] = {}
    depths: list[int] = []
    nodes: list[dict] = []
    for k in range(1, len(order) + 1):
        l = lcp[k] if k < len(order) else 0
        if not l and not depths:
            continue
        i = order[k - 1]
        current = {-1 if i in begins else int(words[i - 1]): [i]}
        while depths and depths[-1] > l:
            current = _join(nodes.pop(), current, depths.pop(), exponent, words, found)
        if l and depths and depths[-1] == l:
            nodes[-1] = _join(nodes[-1], current, l, exponent, words, found)
        elif l:
            depths.append(l)
            nodes.append(current)
    return found


def runs_of(documents: list[list], shortest: int = 6, exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """Runs of each document (a list of words), as (start, length, period) by start, then period."""
    known: dict = {}
    ids = np.array([known.setdefault(w, len(known)) for d in documents for w in d], np.int64)
    at = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype(np.int64)
    last = np.repeat(at[1:], np.diff(at))
    depth = shallowest(shortest, exponent)
    order, lcp = _ordered(ids, last, depth)
    pairs = maximal_pairs(order.tolist(), lcp.tolist(), ids, set(at.tolist()), exponent)
    result: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if pairs:
        stretches = sorted((start, period, length) for (start, length), period in pairs.items())
        of = np.searchsorted(at, [s for s, _, _ in stretches], "right") - 1
        for d, (start, period, length) in zip(of.tolist(), stretches, strict=True):
            if length >= max(shortest, exponent * period):
                result[d].append((start - int(at[d]), length, period))
    return result


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words without those that a run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", shortest: int = 6, exponent: int = 4
) -> DataFrame:
    """(id, n_words, runs, collapsed) of each document; words are split at ASCII white space.

    `runs` holds (start, length, period) in words, by start, then period; `collapsed` is the text
    of the words that are left when of every run only the first period stays, joined by a space.
    A null or empty text has no words and no runs, and its collapsed text is empty. Rows are
    handled one by one, so null and repeated ids are kept; other columns are not read. Texts are
    whole whatever their length: a task holds a block of BLOCK_WORDS words or one document.
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    kind = docs.schema[id].dataType.simpleString()
    run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(pc.cast(batch.column(1), pa.large_binary()), b"")
            first = 0
            while first < len(batch):
                documents, size, row = [], 0, first
                while row < len(batch) and (row == first or size < BLOCK_WORDS):
                    documents.append(texts[row].as_py().split())
                    size += len(documents[-1])
                    row += 1
                runs = runs_of(documents, shortest, exponent)
                left = [b" ".join(collapse(d, r)) for d, r in zip(documents, runs, strict=True)]
                named = [[dict(zip(run.names, map(int, r), strict=True)) for r in rs] for rs in runs]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, row - first),
                        pa.array([len(d) for d in documents], pa.int64()),
                        pa.array(named, pa.list_(run)),
                        pc.cast(pa.array(left, pa.large_binary()), pa.large_string()),
                    ],
                    ["id", "n_words", "runs", "collapsed"],
                )
                first = row

    fields = "start: bigint, length: bigint, period: bigint"
    found = docs.select(id, text).mapInArrow(
        work, f"id {kind}, n_words bigint, runs array<struct<{fields}>>, collapsed string"
    )
    return found.withColumnRenamed("id", id)
