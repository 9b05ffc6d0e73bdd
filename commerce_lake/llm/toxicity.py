"""Toxicity scores learnt from confirmed examples and unlabelled text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.llm.text import LETTERS, blocks, words

FEATURES = 1 << 18
#: Bounds of the training sample of one classifier, and how many are averaged.
POSITIVES, UNLABELLED, MODELS = 4_000, 8_000, 3


def presence(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, features, row of each): distinct hashed words of each text."""
    for first, end, flat, at in blocks(column):
        h, w = words(flat, at, LETTERS)
        row = np.repeat(np.arange(end - first), np.diff(w))
        both = np.unique(row << 18 | (h & np.uint64(FEATURES - 1)).astype(np.int64))
        yield first, end, both & (FEATURES - 1), both >> 18


def evidence(x: np.ndarray, row: np.ndarray, is_p: np.ndarray, least: float) -> np.ndarray:
    """How far each feature may count, 0 to 1: 0 where its shares among the positives and the
    unlabelled differ by less than `least` standard errors, 1 from twice that on."""
    n_p, n_u = max(1, is_p.sum()), max(1, (~is_p).sum())
    p = np.bincount(x[is_p[row]], minlength=FEATURES)
    u = np.bincount(x[~is_p[row]], minlength=FEATURES)
    share = (p + u) / (n_p + n_u)
    error = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    z = np.abs(p / n_p - u / n_u) / np.where(error > 0, error, np.inf)
    return np.clip(z / least - 1, 0, 1)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, *, steps: int = 200, rate: float = 0.1, decay: float = 1e-4, least: float = 4.0) -> np.ndarray:
    """Weights (the last is the constant) of a linear classifier, by non-negative PU learning.

    The risk is prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss. Where the
    second part, an estimate of the risk on negatives, falls below zero, the step goes up its
    gradient instead of down (Kiryo et al., 2017). Adam on the whole sample; features are scaled by
    their `evidence`, so that words seen once or twice are not learnt by heart.
    """
    docs = positive + unlabelled
    x = np.concatenate([np.empty(0, np.int64), *docs])
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    is_p = np.arange(len(docs)) < len(positive)
    scale = evidence(x, row, is_p, least)
    useful = scale[x] > 0
    x, row, size = x[useful], row[useful], scale[x[useful]]
    share_p, share_u = 1 / max(1, len(positive)), 1 / max(1, len(unlabelled))
    w, m, v = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, steps + 1):
        g = np.bincount(row, w[x] * size, len(docs)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        as_negative = np.logaddexp(0, g)
        negative_risk = share_u * as_negative[~is_p].sum() - prior * share_p * as_negative[is_p].sum()
        down = np.where(is_p, -prior * share_p * p, share_u * p)  # gradient of the negative part
        d = np.where(is_p, -prior * share_p * (1 - p), 0) + down if negative_risk >= 0 else -down
        grad = np.bincount(x, d[row] * size, FEATURES + 1).astype(float)
        grad[-1] = d.sum()
        grad[:-1] += decay * w[:-1]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w[:-1] *= scale
    return w


def learn(docs: DataFrame, labels: DataFrame, *, learn_from: Column | None = None, id: str = "doc_id", text: str = "text", positives: int = POSITIVES, unlabelled: int = UNLABELLED, models: int = MODELS) -> np.ndarray:
    """Mean weights of `models` classifiers, each trained in a task of its own.

    Positives are documents labelled toxic = 1, unlabelled ones any documents; of both, only rows
    for which `learn_from` (a condition on the id) holds. The class prior is the toxic share of the
    labelled rows among them, which are taken to be a fair sample. Each classifier takes about `positives` and `unlabelled` documents,
    picked by a hash of the id, whole texts; this sample is the only bounded thing here. Without
    positives or without labels all weights are 0 but the constant, which is -10.
    """
    usable = F.lit(True) if learn_from is None else learn_from
    marks = labels.where(usable).groupBy(id).agg(F.max("toxic").alias("toxic")).where("toxic IS NOT NULL")
    seen = marks.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    nothing = np.zeros(FEATURES + 1)
    nothing[-1] = -10
    if not seen["n"] or not seen["p"]:
        return nothing
    prior = min(max(seen["p"] / seen["n"], 0.001), 0.5)
    pool = docs.where(usable).select(id, text)
    n = pool.count()
    dice = lambda salt: F.pmod(F.xxhash64(id, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    toxic = marks.where("toxic = 1").where(dice(1) < positives / seen["p"]).select(id)
    toxic = pool.join(F.broadcast(toxic) if positives <= 100_000 else toxic, id, "left_semi")
    toxic = toxic.select(text, F.lit(True).alias("confirmed"), F.explode(F.array(*map(F.lit, range(models)))).alias("model"))
    rest = F.array_compact(F.array(*[F.when(dice(2 + m) < unlabelled / max(1, n), F.lit(m)) for m in range(models)]))
    rest = pool.select(text, F.lit(False).alias("confirmed"), F.explode(rest).alias("model"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for first, end, x, row in presence(batch.column(0)):
                cuts = np.searchsorted(row, np.arange(end - first + 1))
                found += [x[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), *batch.columns[1:]], ["x", "confirmed", "model"])

    def one(sample: pd.DataFrame) -> pd.DataFrame:
        x = [np.frombuffer(b, np.int32).astype(np.int64) for b in sample["x"]]
        is_p = sample["confirmed"].to_numpy()
        w = train([d for d, p in zip(x, is_p, strict=True) if p], [d for d, p in zip(x, is_p, strict=True) if not p], prior)
        return pd.DataFrame({"w": [w.tobytes()]})

    sample = toxic.unionByName(rest).mapInArrow(featured, "x binary, confirmed boolean, model int")
    found = sample.groupBy("model").applyInPandas(one, "w binary").collect()  # `models` rows of 2 MB
    return np.mean([np.frombuffer(r["w"]) for r in found], 0) if found else nothing


def score(docs: DataFrame, weights: np.ndarray, *, text: str = "text", name: str = "score") -> DataFrame:
    """Add `name`, a probability (0 to 1) that the text is toxic, from the whole of it.

    Null and empty texts get the score of no words. A column of that name is replaced.
    """
    docs = docs.drop(name)
    weights = weights.astype(np.float32)
    at = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.empty(0)]
            for first, end, x, row in presence(batch.column(at)):
                g = np.bincount(row, weights[x], end - first) + weights[-1]
                out.append(1 / (1 + np.exp(-np.clip(g, -30, 30))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out), pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(add, T.StructType([*docs.schema, T.StructField(name, T.DoubleType())]))
