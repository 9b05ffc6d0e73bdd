"""Katz backoff scores of whole texts under a word bigram model learnt from part of them."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.tables import keep
from commerce_lake.llm.text import blocks, words

#: Counts up to this one are discounted by their own Good-Turing estimate.
K = 5
#: Tokens that a task holds at a time, and bytes of text whose bigrams meet in one group.
FLUSH, GROUP_BYTES = 3_000_000, 8 << 20
#: A word holding more than 1/HOT of all tokens (fewer than HOT words do) is split over all groups.
HOT = 1000
#: Words are told apart by 56-bit hashes.
_WORD = np.uint64((1 << 56) - 1)
END, START = np.uint64(0x1D872B41E6A5F3), np.uint64(0x9E3779B97F4A7C)


def discounts(n: list[int]) -> np.ndarray:
    """Factors d[r] for counts r = 1..K and (d[K + 1]) above, given n[r] = how many things occur
    r times, r = 1..K + 1.

    Katz's: (r*/r - a) / (1 - a) with r* = (r + 1) n[r + 1] / n[r] and a = (K + 1) n[K + 1] / n[1];
    where the n do not allow that (some are 0, or a factor is not between 0 and 1), half a count is
    taken off. Counts above K are near to reliable: they lose a K-th of the share that K loses, so
    that each context leaves something for what never followed it.
    """
    r = np.arange(1, K + 1)
    d = (r - 0.5) / r
    if all(n[i] > 0 for i in range(1, K + 2)):
        a = (K + 1) * n[K + 1] / n[1]
        star = np.array([(i + 1) * n[i + 1] / n[i] for i in r])
        if a < 1:
            katz = (star / r - a) / (1 - a)
            if ((katz > 0) & (katz < 1)).all():
                d = katz
    return np.concatenate([[0], d, [1 - (1 - d[-1]) / K]])


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * d[np.minimum(counts, K + 1).astype(np.int64)]


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _dump(**arrays) -> bytes:
    """Arrays as bytes; 56-bit words go plane by plane, so that sorted ones shrink."""
    out = {}
    for k, a in arrays.items():
        if a.dtype == np.uint64:
            out[k] = ("word", len(a), a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].T.tobytes())
        elif a.dtype.kind in "iu":
            small = next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if not len(a) or (a.min() >= 0 and a.max() <= np.iinfo(t).max) or t is np.int64)
            out[k] = (np.dtype(small).str, len(a), a.astype(small).tobytes())
        else:
            out[k] = (a.dtype.str, len(a), a.tobytes())
    return _squeeze(pickle.dumps(out))


def _load(blob: bytes) -> dict[str, np.ndarray]:
    out = {}
    for k, (kind, n, data) in pickle.loads(_expand(blob)).items():
        if kind == "word":
            full = np.zeros((n, 8), np.uint8)
            full[:, :7] = np.frombuffer(data, np.uint8).reshape(7, n).T
            out[k] = full.reshape(-1).view("<u8")
        else:
            a = np.frombuffer(data, kind)
            out[k] = a.astype(np.int64) if a.dtype.kind in "iu" else a
    return out


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = ends = 0

    def flush():
        nonlocal held, size, ends
        found, n = np.unique(np.concatenate([*held, np.full(ends, END)]), return_counts=True)
        held, size, ends = [], 0, 0
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["word", "n"])

    for batch in batches:
        for first, end, flat, at in blocks(batch.column(0)):
            h, _ = words(flat, at)
            held.append(h & _WORD)
            size, ends = size + len(h), ends + end - first
            if size > FLUSH:
                yield flush()
    if ends:
        yield flush()


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination begins in arrays sorted by them."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _bigrams(groups: int, hot: np.ndarray):
    """Rows (to, kind, part, data): for each group of words, the bigrams that end in one, with the
    documents they are in; and for each part (run of documents of a task) what its documents are."""

    def flush(part: int, docs: list, held: list[bool], sizes: list[int], tokens: list[np.ndarray], place: list[np.ndarray]):
        w = np.concatenate(tokens)
        d = np.concatenate(place)
        tokens.clear()
        place.clear()
        v = np.empty_like(w)
        v[1:] = w[:-1]
        v[np.concatenate([[0], np.flatnonzero(w[:-1] == END) + 1])] = START
        key = (w >> np.uint64(24)) << np.uint64(32) | v >> np.uint64(24)
        spread = np.isin(w, hot)
        key[spread] = (w[spread] ^ v[spread]) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(key, kind="stable")
        to = ((key[order] >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
        del key, spread
        w, v, d = w[order], v[order], d[order]
        del order
        info = _squeeze(pickle.dumps((docs, held, sizes)))
        yield -1 - part % (1 << 40), "docs", part, info
        flags = np.array(held, bool)
        cuts = np.searchsorted(to, np.arange(groups + 1))
        for g in range(groups):
            a, b = cuts[g], cuts[g + 1]
            if a < b:
                at = _runs(w[a:b], v[a:b])
                pw, pv = w[a:b][at], v[a:b][at]
                ww = _runs(pw)
                yield g, "bigrams", part, _dump(
                    w=pw[ww], pairs=np.diff(np.append(ww, len(pw))), v=pv, hits=np.diff(np.append(at, b - a)),
                    doc=d[a:b], held=np.flatnonzero(flags),
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, held, sizes, tokens, place, part, size = [], [], [], [], [], None, 0

        def rows():
            for to, kind, of, data in flush(part, docs, held, sizes, tokens, place):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([to], pa.int64()), pa.array([kind]), pa.array([of], pa.int64()), pa.array([data], pa.binary())],
                    ["to", "kind", "part", "data"],
                )

        for batch in batches:
            number = batch.column(0).to_numpy()
            for first, end, flat, at in blocks(batch.column(3)):
                part = number[first] if part is None else part
                h, begin = words(flat, at)
                # Each document's words, then its end.
                n = np.diff(begin)
                where = begin[1:] + np.arange(end - first)
                both = np.empty(len(h) + end - first, np.uint64)
                is_end = np.zeros(len(both), bool)
                is_end[where] = True
                both[is_end], both[~is_end] = END, h & _WORD
                tokens.append(both)
                place.append(np.repeat(np.arange(len(docs), len(docs) + end - first, dtype=np.int32), n + 1))
                docs += batch.column(1)[first:end].to_pylist()
                held += batch.column(2)[first:end].to_pylist()
                sizes += (n + 1).tolist()
                size += len(both)
                if size > FLUSH:
                    yield from rows()
                    docs, held, sizes, tokens, place, part, size = [], [], [], [], [], None, 0
        if docs:
            yield from rows()

    return run


_ROWS = "to bigint, kind string, part bigint, data binary"


def _meet(groups: int, hot: np.ndarray, hot_counts: np.ndarray, total: int, unigram: np.ndarray, unknown: float):
    """All bigrams ending in the words of a group: their counts, and what follows for documents
    (sums by class of count), for contexts (what followed them) and for the discounts."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["kind"].iat[0] == "docs":
            return rows.assign(to=-1 - rows["part"])
        parts = [_load(b) for b in rows["data"]]
        firsts = np.cumsum([0] + [int(p["doc"].max()) + 1 for p in parts])
        w = np.concatenate([np.repeat(p["w"], p["pairs"]) for p in parts])
        v = np.concatenate([p["v"] for p in parts])
        hits = np.concatenate([p["hits"] for p in parts])
        doc = np.concatenate([p["doc"] + f for p, f in zip(parts, firsts, strict=False)])
        learnt = np.concatenate([~np.isin(p["doc"], p["held"]) for p in parts])
        parts_no = rows["part"].to_numpy()
        del parts
        begins = np.cumsum(hits) - hits
        of_pair = np.add.reduceat(learnt, begins, dtype=np.int64)
        order = np.lexsort((v, w))
        new = _runs(w[order], v[order])
        pair = np.empty(len(w), np.int64)
        pair[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(w))))
        del learnt
        r = np.bincount(pair, of_pair, len(new)).astype(np.int64)
        pw, pv = w[order[new]], v[order[new]]
        del w, v, order
        word_new = _runs(pw)
        c = np.add.reduceat(r, word_new)
        known = np.isin(pw[word_new], hot)
        c[known] = hot_counts[np.searchsorted(hot, pw[word_new][known])]
        c = np.repeat(c, np.diff(np.append(word_new, len(pw))))
        with np.errstate(divide="ignore"):
            p1 = np.where(c > 0, _discounted(c, unigram) / max(1, total), unknown)
            unseen_log = np.log10(p1)
        own = np.repeat(pair, hits)
        del pair, hits
        seen = r[own] > 0
        level = np.minimum(r, K + 1)
        n = firsts[-1]
        # A document's tokens, as one would sum them: class of count; log of large counts and of
        # what a word that never followed gets alone; less the log of each context's count.
        add = np.where(r > K, np.log10(np.maximum(r, 1)), np.where(r == 0, unseen_log, 0))
        add = add - np.where((c > 0) & (pw != END), np.log10(np.maximum(c, 1)), 0)
        classes = np.bincount(doc[seen] * (K + 1) + level[own[seen]] - 1, minlength=n * (K + 1)).reshape(n, K + 1)
        logs = np.bincount(doc, add[own], n)
        base = np.bincount(doc, np.log10(c + 0.1)[own], n)
        known_words = np.bincount(doc, c[own] > 0, n).astype(np.int64)
        some = np.bincount(doc, minlength=n) > 0
        out = []
        for i, part in enumerate(parts_no):
            a, b = firsts[i], firsts[i + 1]
            at = np.flatnonzero(some[a:b]) + a
            out.append((-1 - part, "sums", part, _dump(doc=at - a, base=base[at], logs=logs[at], known=known_words[at], **{f"k{j}": classes[at, j] for j in range(K + 1)})))
        out.append((-(1 << 62), "levels", 0, _dump(n=np.bincount(level, minlength=K + 2)[: K + 2], last=np.bincount(r[r == K + 1], minlength=K + 2)[K + 1 : K + 2])))
        # Contexts, dealt by their own hash; held-out tokens that never followed theirs ask there.
        live = r > 0
        cv, inverse = np.unique(pv[live], return_inverse=True)
        lv = level[live]
        table = {f"t{j}": np.bincount(inverse[lv == j], minlength=len(cv)) for j in range(1, K + 1)}
        table["big"] = np.bincount(inverse, np.where(lv > K, r[live], 0), len(cv)).astype(np.int64)
        table["p"] = np.bincount(inverse, p1[live], len(cv))
        asks, ask_doc = pv[own[~seen]], doc[~seen]
        ask_part = np.searchsorted(firsts, ask_doc, "right") - 1
        goes = lambda x: ((x >> np.uint64(24)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
        to, ask_to = goes(cv), goes(asks)
        order = np.argsort(ask_to, kind="stable")
        asks, ask_doc, ask_part, ask_to = asks[order], (ask_doc - firsts[ask_part])[order], ask_part[order], ask_to[order]
        cuts, ask_cuts = np.searchsorted(to, np.arange(groups + 1)), np.searchsorted(ask_to, np.arange(groups + 1))
        for g in range(groups):
            a, b = cuts[g], cuts[g + 1]
            if a < b:
                out.append((g, "contexts", 0, _dump(v=cv[a:b], **{k: x[a:b] for k, x in table.items()})))
            a, b = ask_cuts[g], ask_cuts[g + 1]
            if a < b:
                out.append((g, "asks", 0, _dump(v=asks[a:b], doc=ask_doc[a:b], at=ask_part[a:b], part=parts_no)))
        return pd.DataFrame(out, columns=["to", "kind", "part", "data"])

    return count


def _gather(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of a part's documents; or the contexts of a group, with the tokens that ask for them."""
    to, out = rows["to"].iat[0], []
    kinds = {k: [_load(b) if k != "docs" else b for b in x["data"]] for k, x in rows.groupby("kind")}
    if "levels" in kinds:
        out.append(("levels", 0, _dump(**{k: np.sum([x[k] for x in kinds["levels"]], 0) for k in ("n", "last")})))
    if "docs" in kinds:
        n = len(pickle.loads(_expand(kinds["docs"][0]))[0])
        total = {k: np.zeros(n) for k in ("base", "logs", "known", *(f"k{j}" for j in range(K + 1)))}
        for x in kinds["sums"]:
            for k, sums in total.items():
                sums[x["doc"]] += x[k]
        part = -1 - to
        out += [("docs", part, kinds["docs"][0]), ("sums", part, _dump(**total))]
    if "asks" in kinds or "contexts" in kinds:
        found = kinds.get("contexts", [])
        names = [*(f"t{j}" for j in range(1, K + 1)), "big", "p"]
        every = np.concatenate([np.empty(0, np.uint64), *[x["v"] for x in found]])
        v, inverse = np.unique(every, return_inverse=True)
        table = {k: np.bincount(inverse, np.concatenate([np.empty(0), *[x[k] for x in found]]), len(v)) for k in names}
        table = {k: x if k == "p" else x.astype(np.int64) for k, x in table.items()}
        asks = kinds.get("asks", [])
        who = np.concatenate([np.empty(0, np.uint64), *[x["v"] for x in asks]])
        part = np.concatenate([np.empty(0, np.int64), *[x["part"][x["at"]] for x in asks]])
        doc = np.concatenate([np.empty(0, np.int64), *[x["doc"] for x in asks]])
        at = np.searchsorted(v, who)
        there = (at < len(v)) & (v[np.minimum(at, max(0, len(v) - 1))] == who) if len(v) else np.zeros(len(who), bool)
        out.append(("contexts", to, _dump(v=v, ask=at[there], part=part[there], doc=doc[there], **table)))
    return pd.DataFrame(out, columns=["kind", "part", "data"])


def katz_scores(docs: DataFrame, learn_from: Column, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are words (white space parts them, A-Z count as a-z) and one end a text. Rows for which
    `learn_from` is true are learnt from, the others are held out; all are scored, whole.
    score = sum of log10 P(token | token before), where P(w | v) is the discounted share of w among
    what followed v; for a w that never did, alpha(v) P(w), with alpha(v) what the discounts of v
    left, divided by the P of all words that did not follow it; P(w) itself is discounted, and what
    is left is the P of an unknown word. Each distribution sums to 1 over known words, the end and
    one unknown. base_score is that of single words with 0.1 added to each count.

    Bigrams are dealt by their second word (those of the at most HOT words that hold over 1/HOT of
    all tokens, by both), so that its count is known where they meet; contexts, by their hash; and
    sums of documents by the run of documents they came in. Groups hold about GROUP_BYTES of text.
    Unigram counts and contexts (with what backoff weights are made of) are written tables.

    Null and empty texts are one token, the end; null conditions count as held out. Repeated rows
    and rows without id are scored each. If nothing is learnt, all words are unknown with
    probability 1 and both scores are 0. Other columns are not carried.
    """
    docs = docs.select(F.col(id).alias("doc_id"), F.coalesce(~learn_from, F.lit(True)).alias("held_out"), F.col(text).alias("text"))
    unigrams = docs.where("NOT held_out").select("text").mapInArrow(_count_words, "word bigint, n bigint")
    unigrams = keep(unigrams.groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    levels = [F.sum(F.when(F.col("n") == r, 1).otherwise(0)).alias(f"n{r}") for r in range(1, K + 2)]
    seen = unigrams.agg(F.sum("n").alias("total"), F.count("*").alias("words"), *levels, F.sum(F.when(F.col("word") == int(END), F.col("n"))).alias("texts")).first()
    total, texts = seen["total"] or 0, seen["texts"] or 0
    unigram = discounts([0, *[seen[f"n{r}"] or 0 for r in range(1, K + 2)]])
    kept = sum(r * (seen[f"n{r}"] or 0) for r in range(1, K + 1))
    kept = sum(r * (seen[f"n{r}"] or 0) * unigram[r] for r in range(1, K + 1)) + (total - kept) * unigram[K + 1]
    unknown = 1 - kept / total if total else 1.0
    often = unigrams.where(F.col("n") * HOT > total).orderBy("word").collect()  # fewer than HOT rows
    hot, hot_counts = np.array([r["word"] for r in often], np.uint64), np.array([r["n"] for r in often], np.int64)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))

    numbered = docs.select(F.monotonically_increasing_id().alias("no"), "doc_id", "held_out", "text")
    found = numbered.mapInArrow(_bigrams(groups, hot), _ROWS)
    met = found.groupBy("to", "kind").applyInPandas(_meet(groups, hot, hot_counts, total, unigram, unknown), _ROWS)
    model = keep(met.groupBy("to").applyInPandas(_gather, "kind string, part bigint, data binary"), "katz_contexts")
    n = np.zeros(K + 2, np.int64)
    for row in model.where("kind = 'levels'").collect():
        x = _load(row["data"])
        n[1 : K + 1] += x["n"][1 : K + 1]
        n[K + 1] += x["last"][0]
    d = discounts(n.tolist())

    def asked(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for blob in batch["data"]:
                x = _load(blob)
                left = x["big"] * (1 - d[K + 1]) + sum(j * x[f"t{j}"] * (1 - d[j]) for j in range(1, K + 1))
                log = np.log10(left / (1 - x["p"]))[x["ask"]]
                for part in np.unique(x["part"]):
                    own = x["part"] == part
                    at, inverse = np.unique(x["doc"][own], return_inverse=True)
                    yield pd.DataFrame({"kind": ["asked"], "part": [part], "data": [_dump(doc=at, logs=np.bincount(inverse, log[own]))]})

    asked_rows = model.where("kind = 'contexts'").mapInPandas(asked, "kind string, part bigint, data binary")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        kinds = rows.groupby("kind")["data"].apply(list)
        ids, held, sizes = pickle.loads(_expand(kinds["docs"][0]))
        x = _load(kinds["sums"][0])
        score = x["logs"] + sum(x[f"k{j - 1}"] * (np.log10(j * d[j]) if j <= K else np.log10(d[j])) for j in range(1, K + 2))
        if texts:
            score = score - np.log10(texts)  # the context of first tokens
        for blob in kinds.get("asked", []):
            y = _load(blob)
            score[y["doc"]] += y["logs"]
        out = pd.DataFrame({id: ids, "held_out": held, "n_tokens": sizes, "n_known": x["known"].astype(np.int64)})
        out["train_tokens"] = total
        out["base_score"] = x["base"] - out["n_tokens"] * np.log10(total + 0.1 * (seen["words"] + 1))
        return out.assign(score=score)

    rows = model.where("kind IN ('docs', 'sums')").union(asked_rows)
    return rows.groupBy("part").applyInPandas(
        finish, f"`{id}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
