"""Groups of linked rows, found without listing all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.tables import drop_shuffles, forget, keep, left_by_size

#: Bytes of a node with its component, for the choice of a join.
_NODE_BYTES = 64
#: Bytes of a node with its sketch.
_SKETCH_BYTES = 300
#: Times that each node is compared with one other node before the rest is looked at.
ROUNDS = 3


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b): the smallest node it is linked with.

    Large-star and small-star steps by turns (Kiveris et al., 2014): each replaces edges by edges
    to a smaller neighbour, until every node hangs on its component's smallest. Only minima are
    gathered by node, so a node with very many edges is no burden. Self-loops and repeated edges
    do no harm; no edges give no rows.
    """
    now = keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while not _flat(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = keep(large, "large_star")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = keep(small.union(down.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "small_star")
        forget(now)
        forget(large)
        now = after
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(now.select(F.col("b"), F.col("b")).distinct())


def _flat(edges: DataFrame) -> bool:
    """Whether each larger end of `edges` has one edge and is the smaller end of none."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1))).groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 OR up > 0 AND down > 0").agg(F.count("*")).first()[0] == 0


def sketch_apart(x: Column, y: Column, bits: int) -> Column:
    """In how many of `bits` bits two sketches differ (structs with p0, p1, ... of 64 bits).

    A sketch has a bit for each part of the space of hashes: whether an odd number of a node's
    items lie there. Adding or removing an item turns one bit, so the sketches of two nodes differ
    in at most as many bits as items have to be added and removed to make one into the other.
    """
    apart = [F.bit_count(x[f"p{k}"].bitwiseXOR(y[f"p{k}"])) for k in range(bits // 64)]
    return sum(apart[1:], apart[0])


def linked_components(
    postings: DataFrame,
    key: list[str],
    weights: DataFrame,
    plausible: Callable[[Column, Column], Column],
    verify: Callable[[DataFrame], DataFrame],
    sketches: Callable[[DataFrame], DataFrame],
    close: Callable[[Column, Column], Column],
    slices: int = 1,
) -> DataFrame:
    """`linked_members` of the keys in `postings` (key..., node, about) that several nodes hold.

    Most keys are held by one node and go at once. Keys are looked through in `slices` parts of their
    hash space, one after another, so that the shuffle of all postings is never on disk as a whole;
    each part makes the postings anew.
    """
    first = F.first(F.struct("node", "about")).over(
        Window.partitionBy(*key).orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    )
    shared = None
    for k in range(slices):
        part = postings if slices == 1 else postings.where(F.pmod(F.xxhash64(*key), F.lit(slices)) == k)
        part = keep(part.withColumn("hub", first).where("hub.node <> node"), "shared_keys")
        shared = part if shared is None else shared.union(part)
        if slices > 1:
            drop_shuffles(postings.sparkSession)
    members = shared.select(*key, "node", "about").union(shared.select(*key, "hub.node", "hub.about").distinct())
    return linked_members(members, key, weights, plausible, verify, sketches, close)


def linked_members(
    members: DataFrame,
    key: list[str],
    weights: DataFrame,
    plausible: Callable[[Column, Column], Column],
    verify: Callable[[DataFrame], DataFrame],
    sketches: Callable[[DataFrame], DataFrame],
    close: Callable[[Column, Column], Column],
    few: int = 0,
) -> DataFrame:
    """(node, component) of all nodes that are linked with another.

    Two nodes may be linked if they share a key in `members` (a written table, one row (key...,
    node, about) for a node and key) and `plausible(about, about)` holds; `verify` keeps those pairs
    (a, b) that are. Every link between two nodes counts, yet not every pair is formed: at first
    each node is compared with the hub of one of its keys alone, the node of the largest weight
    there (`weights`: node, weight), ROUNDS times over among the hubs it is not joined with. What
    that joins needs no further look. Then the nodes still outside the component of a key's hub are
    compared with the nodes of other components in that key, so no link between components is
    missed. These are as many pairs as there are, in groups that do not hang together; hence
    `sketches` adds a `sketch` to nodes (node), and where two of them are not `close`, the nodes are
    known not to be linked and no pair is formed. Where plausible pairs are at most `few` times as
    many as nodes, they are verified without sketches. Each pair is verified once. The files of
    `members` are deleted.
    """
    keys = members
    members = left_by_size(members, weights, "node", 16).withColumn("weight", F.coalesce("weight", F.lit(0)))
    heaviest = F.first(F.struct("weight", "node", "about")).over(
        Window.partitionBy(*key).orderBy(F.desc("weight"), "node").rowsBetween(Window.unboundedPreceding, 0)
    )
    star = members.withColumn("top", heaviest).where("top.node <> node")
    star = keep(
        star.select(
            *key, "node", "about", F.col("top.node").alias("hub"), F.col("top.weight").alias("weight"),
            plausible(F.col("top.about"), F.col("about")).alias("ok"),
        ),
        "star",
    )
    forget(keys)

    def with_component(df: DataFrame, joined: DataFrame, node: str, name: str) -> DataFrame:
        side = joined.select(F.col("node").alias("_node"), F.col("component").alias(name))
        df = df.withColumn("_node", F.col(node))
        return left_by_size(df, side, "_node", _NODE_BYTES).withColumn(name, F.coalesce(name, node)).drop("_node")

    def ordered(hub: str, node: str) -> list[Column]:
        return [F.least(hub, node).alias("a"), F.greatest(hub, node).alias("b")]

    def best(rows: DataFrame) -> DataFrame:
        """Each node with its heaviest plausible hub."""
        rows = rows.where("ok").groupBy("node").agg(F.min(F.struct(-F.col("weight"), "hub")).alias("m"))
        return keep(rows.select(*ordered("m.hub", "node")).distinct(), "round_pairs")

    def with_links(joined: DataFrame, links: DataFrame) -> DataFrame:
        """Edges that join what is joined already and what `links` join."""
        known = joined.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        return known.union(links)

    tried = best(star)
    edges = verify(tried)
    for last in range(1, ROUNDS + 1):
        joined = keep(components(edges), "round_components")
        placed = with_component(with_component(star, joined, "node", "c"), joined, "hub", "hub_c")
        placed = keep(placed.withColumn("stray", F.col("c") != F.col("hub_c")).drop("hub_c"), "placed")
        if last < ROUNDS:
            new = placed.where("stray AND ok").select("node", "hub", "weight", "ok", *ordered("hub", "node"))
            now = best(new.join(tried, ["a", "b"], "left_anti"))
            forget(placed)
            tried, edges = tried.union(now), with_links(joined, verify(now))
    forget(star)
    drop_shuffles(placed.sparkSession)
    left = placed.where("stray AND ok").select(*ordered("hub", "node"))
    open_keys = placed.groupBy(*key).agg(F.count("*").alias("n"), F.max("stray").alias("any")).where("any AND n > 1").select(*key)
    rest = keep(placed.join(open_keys, key).select(*key, "node", "about", "c", "stray"), "open_members")
    if not rest.isEmpty():
        nodes = keep(rest.select("node").distinct(), "open_nodes")

        def met(rest: DataFrame, *sketch: str) -> DataFrame:
            s = rest.where("stray").select(*key, *[F.col(x).alias(f"s_{x}") for x in ("node", "about", "c", *sketch)])
            pairs = s.join(rest, key).where("c <> s_c AND (NOT stray OR s_node < node)")
            near = plausible(F.col("s_about"), F.col("about"))
            return pairs.where(near & close(F.col("s_sketch"), F.col("sketch")) if sketch else near)

        more = met(rest)
        if not few or more.count() > few * nodes.count():
            near = keep(sketches(nodes), "sketches")
            rest = keep(left_by_size(rest, near, "node", _SKETCH_BYTES), "sketched_members")
            more = met(rest, "sketch")
        left = left.union(more.select(*ordered("s_node", "node")))
    left = keep(left.distinct().join(tried, ["a", "b"], "left_anti"), "rest_pairs")
    forget(placed)
    if left.isEmpty():
        return joined
    return components(with_links(joined, verify(left)))
