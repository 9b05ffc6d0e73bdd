"""Approximate nearest neighbours: a navigable small-world graph for each shard of the vectors."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.tables import keep

#: Distinct vectors in a shard; links of a vector (twice as many on the lowest level); beam width.
SHARD_ROWS, LINKS, BEAM = 4096, 16, 64
#: Queries searched together.
BLOCK = 256


def _select(near: np.ndarray, sims: np.ndarray, x: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1 for none) those that are nearer to the row than
    to any candidate taken before, then the nearest of the rest; at most `keep`."""
    own = x[near]
    between = own @ own.transpose(0, 2, 1)
    rows, width = near.shape
    valid = near >= 0
    taken = np.zeros((rows, width), bool)
    for j in range(width):
        blocked = (taken[:, :j] & (between[:, j, :j] > sims[:, j, None])).any(1) if j else False
        taken[:, j] = valid[:, j] & ~blocked & (taken.sum(1) < keep)
    order = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :keep]
    out = np.take_along_axis(near, order, 1)
    out = np.where(np.take_along_axis(valid, order, 1), out, -1)
    return np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)


def _beam(q: np.ndarray, start: np.ndarray, x: np.ndarray, links: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The `width` best nodes found for each query by best-first search along `links`, all queries
    in step, four nodes of each at a time."""
    n, at = len(q), np.arange(len(q))[:, None]
    seen = np.zeros((n, len(x) + 1), bool)
    ids = np.full((n, width), -1)
    sims = np.full((n, width), -np.inf, np.float32)
    ids[:, 0] = start
    sims[:, 0] = (q * x[start]).sum(1)
    seen[at[:, 0], start] = True
    done = np.zeros((n, width), bool)
    while True:
        open_sims = np.where(done | (ids < 0), -np.inf, sims)
        pick = np.argsort(-open_sims, axis=1)[:, :4]
        live = np.take_along_axis(open_sims, pick, 1) > -np.inf
        if not live.any():
            return ids, sims
        np.put_along_axis(done, pick, True, 1)
        near = np.where(live[:, :, None], links[np.take_along_axis(ids, pick, 1)], -1).reshape(n, -1)
        # The first of equal nodes counts; column len(x) takes the places without a node.
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        new = (near >= 0) & ~seen[at, near]
        seen[at, np.where(new, near, len(x))] = True
        near_sims = np.where(new, np.einsum("qd,qkd->qk", q, x[near]), -np.inf)
        all_ids = np.concatenate([ids, np.where(new, near, -1)], 1)
        all_sims = np.concatenate([sims, near_sims.astype(np.float32)], 1)
        all_done = np.concatenate([done, ~new], 1)
        best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
        ids, sims, done = (np.take_along_axis(a, best, 1) for a in (all_ids, all_sims, all_done))


def _join(links: np.ndarray, x: np.ndarray, new: np.ndarray, found: np.ndarray, sims: np.ndarray, keep: int) -> None:
    """Link the nodes `new` to the best of `found` and back; lists that overflow are selected anew."""
    order = np.argsort(-sims, axis=1, kind="stable")[:, : BEAM + 8]
    found, sims = np.take_along_axis(found, order, 1), np.take_along_axis(sims, order, 1)
    links[new] = _select(found, sims, x, keep // 2 if keep > LINKS else keep) if keep == LINKS else np.pad(
        _select(found, sims, x, LINKS), ((0, 0), (0, keep - LINKS)), constant_values=-1
    )
    ahead = links[new]
    frm, to = np.repeat(new, keep), ahead.ravel()
    frm, to = frm[to >= 0], to[to >= 0]
    order = np.lexsort((frm, to))
    frm, to = frm[order], to[order]
    nodes, first, many = np.unique(to, return_index=True, return_counts=True)
    have = (links[nodes] >= 0).sum(1)
    fits = have + many <= keep
    spot = np.arange(len(to)) - np.repeat(first, many) + np.repeat(have, many)
    simple = np.repeat(fits, many)
    links[to[simple], spot[simple]] = frm[simple]
    for part in np.array_split(np.flatnonzero(~fits), max(1, (~fits).sum() // BLOCK)):
        if not len(part):
            continue
        width = keep + many[part].max()
        pool = np.full((len(part), width), -1)
        pool[:, :keep] = links[nodes[part]]
        for i, k in enumerate(part):
            pool[i, keep : keep + many[k]] = frm[first[k] : first[k] + many[k]]
        s = np.where(pool >= 0, np.einsum("qd,qkd->qk", x[nodes[part]], x[pool]), -np.inf)
        order = np.argsort(-s, axis=1, kind="stable")[:, : 2 * keep]
        links[nodes[part]] = _select(np.take_along_axis(pool, order, 1), np.take_along_axis(s, order, 1), x, keep)


def build(x: np.ndarray, seed: int = 0) -> list[np.ndarray]:
    """Flat neighbour arrays (a row a vector, -1 for none) of each level, the top one first.

    `x` has unit rows. Each level holds about 1/LINKS of the one below; a level's vectors enter in
    growing batches, each searched for along the links that are there, from where the levels above
    lead.
    """
    rng = np.random.default_rng(seed)
    level = np.floor(-np.log(1 - rng.random(len(x))) / np.log(LINKS)).astype(int)
    levels: list[np.ndarray] = []
    for k in range(level.max(initial=0), -1, -1):
        nodes = rng.permutation(np.flatnonzero(level >= k))
        width = 2 * LINKS if k == 0 else LINKS
        links = np.full((len(x), width), -1, np.int32)
        there = 0
        while there < len(nodes):
            new = nodes[there : there + min(BLOCK, max(2 * LINKS, there))]
            q = x[new]
            mates = q @ q.T
            np.fill_diagonal(mates, -np.inf)
            best = np.argsort(-mates, axis=1)[:, :8] if there else np.argsort(-mates, axis=1)
            found, sims = new[best], np.take_along_axis(mates, best, 1)
            if there:
                far, far_sims = _beam(q, _descend(q, x, levels, nodes[0]), x, links, BEAM)
                found, sims = np.concatenate([far, found], 1), np.concatenate([far_sims, sims], 1)
            found = np.where(np.isfinite(sims), found, -1)
            _join(links, x, new, found, sims, width)
            there += len(new)
        levels.append(links)
    return levels


def _descend(q: np.ndarray, x: np.ndarray, levels: list[np.ndarray], default: int) -> np.ndarray:
    start = np.full(len(q), default)
    for i, links in enumerate(levels):
        if i == 0:
            start[:] = np.flatnonzero(links[:, 0] >= 0)[0] if (links[:, 0] >= 0).any() else default
        ids, _ = _beam(q, start, x, links, 4)
        start = ids[:, 0]
    return start


def search(q: np.ndarray, x: np.ndarray, levels: list[np.ndarray], width: int = BEAM) -> np.ndarray:
    """The `width` nearest rows of `x` found for each unit query, nearest first, -1 for none."""
    ids, _ = _beam(q, _descend(q, x, levels[:-1], 0), x, levels[-1], width)
    return ids


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; each side is first divided by its largest component."""
    a = a / np.abs(a).max(1, keepdims=True)
    b = b / np.abs(b).max(1, keepdims=True)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def valid_vectors(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part: no null id, and a vector that is neither null nor
    all zero and has no null, NaN or infinite component. Equal rows count once."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(id).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0))
    return rows.select(F.col(id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))


def build_index(df: DataFrame, *, id: str = "vec_id", vector: str = "embedding", k: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row a shard: (shard, rows, graph), where graph holds the vectors, for each the k + 1
    smallest ids that have it, and the neighbour arrays.

    Equal vectors are one node, however many rows have them. Shards are dealt by a hash of the
    vector, about `shard_rows` distinct vectors each, so a task's memory does not grow with the
    data. Vectors of different length never meet. An empty table has no shards.
    """
    first = Window.partitionBy("vec").orderBy("vec_id")
    few = valid_vectors(df, id, vector).withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)
    nodes = keep(few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann_nodes")
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.withColumns({"dim": F.size("vec"), "part": F.pmod(F.xxhash64("vec"), F.lit(shards))})

    def graph(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.iloc[np.argsort([i[0] for i in rows["ids"]], kind="stable")]
        vec = np.stack(rows["vec"].to_numpy()).astype(np.float64)
        levels = build(_unit(vec))
        ids = [np.unique(i) for i in rows["ids"]]
        blob = pickle.dumps((vec.astype(np.float32) if (vec == vec.astype(np.float32)).all() else vec, ids, levels))
        return pd.DataFrame({"dim": [vec.shape[1]], "rows": [len(vec)], "graph": [blob]})

    return keep(dealt.groupBy("dim", "part").applyInPandas(graph, "dim int, rows bigint, graph binary"), "ann_index")


def search_index(index: DataFrame, queries: DataFrame, *, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each query, but not the query's own.

    `queries` has vec_id and vec (see valid_vectors). They go in blocks of BLOCK to every shard;
    each block and shard is a task of its own, and the results are merged by query. Scores are
    cosines in double precision on the original vectors; ties go to the smaller id.
    """
    spark = queries.sparkSession
    queries = keep(queries, "ann_queries")
    many, shards = queries.count(), index.count()
    blocks = max(1, -(-many // BLOCK))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks))).withColumn("dim", F.size("vec"))
    asked = asked.groupBy("block", "dim").agg(F.collect_list(F.struct("vec_id", "vec")).alias("asked"))
    pairs = asked.join(index.select("dim", "graph"), "dim")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for asked, blob in zip(batch["asked"], batch["graph"], strict=True):
                vec, ids, levels = pickle.loads(blob)
                vec = vec.astype(np.float64)
                of = np.array([a["vec_id"] for a in asked])
                q = np.array([a["vec"] for a in asked], np.float64)
                found = search(_unit(q), _unit(vec), levels)[:, : k + 2]
                row, near = np.repeat(np.arange(len(q)), found.shape[1]), found.ravel()
                row, near = row[near >= 0], near[near >= 0]
                score = _cosine(q[row], vec[near])
                sizes = [len(ids[i]) for i in near]
                out = pd.DataFrame({"query_id": np.repeat(of[row], sizes), "vec_id": np.concatenate([ids[i] for i in near]), "score": np.repeat(score, sizes)})
                out = out[out["query_id"] != out["vec_id"]].drop_duplicates()
                out = out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
                yield out.groupby("query_id").head(k)

    spread = pairs.select("asked", "graph").repartition(max(1, min(blocks * shards, 4 * spark.sparkContext.defaultParallelism * max(1, blocks * shards // 64))))
    near = spread.mapInPandas(run, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
