"""Connected groups of what shares buckets: exact, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import forget, release, stored


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The stored edges, and their number and the sum of their hashes, taken while they are written."""
    seen = Observation()
    edges = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")), "edges")
    return edges, (seen.get["n"], seen.get["sum"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), root being the least node of its group.

    Alternates large and small stars (each node's neighbours are linked to its least neighbour) until every
    group is one star; the number of rounds grows with the logarithm of a group's size. Edges stay
    distributed, and each round is written to the shared folder."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e, now = _written(e)
    last = None
    while now != last and now[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        old, last = e, now
        e, now = _written(small)
        forget(old)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def linked_groups(buckets: DataFrame, features: DataFrame, likely: Callable[[str, str], Column], confirm: Callable[[DataFrame], DataFrame], rounds: int = 2, sharper: tuple[DataFrame, Callable[[str, str], Column]] | None = None) -> DataFrame:
    """(node, root) for nodes that are linked to another; nodes without a link have no row.

    ``buckets``: (key, node), stored; candidates are nodes that share a key. ``features``: one narrow row for
    each node of a bucket (its signature). ``likely`` says, of two aliases of it, whether a pair may be a link;
    it must hold for every link, and it is tested within the join, before a pair is made. ``confirm`` takes
    likely pairs (a, b) and returns those that are links.

    In each round one pivot of every bucket is compared with those of its members that aren't yet known to
    be in the pivot's group, so a bucket of n costs n comparisons a round, not n squared. The first pivots are the
    same in all buckets of a group; later ones differ from bucket to bucket, so a node of many buckets meets many
    pivots in a round. After the last round the members outside a bucket's largest group are compared with
    all that aren't in their own group, so no link between groups is lost; ``sharper`` has larger features and a
    stricter test, which also holds for every link, for that comparison."""
    spark = buckets.sparkSession
    groups = spark.createDataFrame([], "node long, root long")
    tested = spark.createDataFrame([], "a long, b long")
    # buckets that are one group stay so, and their rows are left behind
    packed = features.select("node", F.struct(*[c for c in features.columns if c != "node"]).alias("f"))
    members = stored(buckets.join(packed, "node").select("key", "node", "f"), "members")
    linked = False
    for step in range(rounds + 1):
        rows = members.withColumn("root", F.col("node"))
        if linked:
            rows = members.join(groups, "node", "left").select("key", "node", "f", F.coalesce("root", "node").alias("root"))
        order = F.xxhash64("node", F.lit(step)) if not step else F.xxhash64("node", "key", F.lit(step))
        pivot = F.min(F.struct(order.alias("h"), F.col("node"), F.col("root"), F.col("f")))
        open_keys = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), pivot.alias("p")).filter("lo < hi")
        opened = rows = stored(rows.join(open_keys.select("key", "p"), "key"), "open")
        if rows.isEmpty():
            break
        if step < rounds:
            found = rows.filter((F.col("root") != F.col("p.root")) & likely("f", "p.f"))
            found = found.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()
        else:
            sizes = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
            core = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most")).select("key", F.col("most.root").alias("core"))
            own_keys = rows.groupBy("node").agg(F.collect_set("key").alias("keys"))
            rows, test = rows.drop("p").join(core, "key").join(own_keys, "node"), likely
            if sharper:
                large, test = sharper[0], sharper[1]
                large = large.select("node", F.struct(*[c for c in large.columns if c != "node"]).alias("f"))
                rows = rows.drop("f").join(large, "node")
            x = rows.filter("root <> core").select(F.col("key").alias("key_x"), F.col("keys").alias("keys_x"), F.col("node").alias("node_x"), F.col("root").alias("root_x"), F.col("f").alias("x"))
            y = rows.select("key", "keys", F.col("node").alias("node_y"), F.col("root").alias("root_y"), "core", F.col("f").alias("y"))
            apart = (F.col("root_x") < F.col("root_y")) | (F.col("root_y") == F.col("core"))
            once = F.array_min(F.array_intersect("keys_x", "keys")) == F.col("key")  # a pair is made in one of its buckets
            found = x.join(y, (F.col("key_x") == F.col("key")) & (F.col("root_x") != F.col("root_y")) & apart & test("x", "y") & once)
            found = found.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()
        found = stored(found.join(tested, ["a", "b"], "left_anti") if step else found, "likely")
        tested = tested.unionByName(found)
        links = stored(confirm(found), "links")
        if step < rounds:
            old, members = members, stored(opened.select("key", "node", "f"), "members")
            forget(old)
        if not links.isEmpty():
            stars = groups.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            groups = components(links.unionByName(stars) if linked else links)
            linked = True
        forget(opened)
        release(spark)
    forget(members)
    return groups
