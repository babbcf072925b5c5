"""Trie of conversation prefixes, built level by level.

Turns get places by order, every conversation takes its first turns from the first one of its block of ids, and
each turn is named by a digest of role and text, so no text is moved. At depth d the live conversations are grouped
by (parent node, turn d): the least conv_id of a group is the node's name. A conversation that is alone in its node
isn't live any more, as the rest of its turns is a chain of its own that needs no grouping; a level costs what its
shared nodes cost, and levels end with the longest shared prefix. Then joins from the deepest level up add leaves and
savings to parents.

Hot prefixes: groups are counted with partial sums. The names of groups with more than 10,000 members, and more
than one in 10,000 of all conversations, are at most 10,000 rows and go to the live rows by broadcast; the others by a
join. A conversation's places are counted in pieces of 1,024 turn numbers, and members that end in one node are listed in pieces
of 100,000 ids; a stream over these pieces makes the hash, so a group is never held by a task.

Defined results: rows with a null conv_id belong to no conversation; turns are ordered by number (null first), then by
role, then by the digest of the text, and repeated rows are turns of their own; null role and text are empty; an
empty turn is a turn of no words; very long texts count whole; negative ids take the remainder toward zero, as SQL
does; other columns are ignored; an empty table has no root and gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, forget, stored

PIECE, ENDS, HOT = 1024, 100_000, 10_000
_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, digest, words) of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        named.alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    rows = rows.withColumn("piece", F.floor(F.col("turn") / PIECE))
    inside = Window.partitionBy("conv_id", "piece").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    placed = stored(rows.withColumn("place", F.row_number().over(inside).cast("long")).select("conv_id", "piece", "digest", "words", "place"), "turns")
    sizes = placed.groupBy("conv_id", "piece").agg(F.max("place").alias("own"))
    pieces = sizes.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv_id")
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("piece")).rowsBetween(Window.unboundedPreceding, -1)
    later = sizes.join(pieces, "conv_id").withColumn("before", F.sum("own").over(before)).filter("before > 0")
    later = later.select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), "before")  # the null piece is a first one
    joined = placed.join(later, (F.col("conv_id") == F.col("c")) & (F.col("piece") == F.col("p")), "left")
    return joined.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "digest", "words")


def own_head(conv_id: Column) -> Column:
    """How many first turns a conversation takes over."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt(turns: DataFrame, block: int = 20) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, digest, words) of the rebuilt conversations, and (conv_id, length) of all of them."""
    sizes = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    first = F.col("conv_id") - F.col("conv_id") % block
    heads = sizes.select("conv_id", "n", first.alias("base"), own_head(F.col("conv_id")).alias("h"))
    lent = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    heads = heads.join(lent, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    heads = stored(heads.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "heads")
    own = turns.join(heads, "conv_id").filter("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "digest", "words")
    begin = turns.filter("place <= 3").withColumnRenamed("conv_id", "base")
    begin = begin.join(heads.filter("taken > 0"), "base").filter("place <= taken").select("conv_id", F.col("place").alias("depth"), "digest", "words")
    return own.unionByName(begin), heads.select("conv_id", "length")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order and one after the other."""
    node, digest = None, None
    for batch in batches:
        done = []
        for depth, conv_id, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "conv_id", "ids")), strict=True):
            if (depth, conv_id) != node:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (depth, conv_id), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield _ends(done)
    if node:
        yield _ends([(*node, digest.hexdigest())])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"depth": pa.array([r[0] for r in rows], pa.int64()), "conv_id": pa.array([r[1] for r in rows], pa.int64()), "ends_sha256": pa.array([r[2] for r in rows], pa.string())})


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(depth, conv_id, ends_sha256) from (depth, conv_id: the node, member)."""
    pieces = ends.groupBy("depth", "conv_id", F.floor(F.col("member") / ENDS).alias("piece")).agg(F.array_join(F.array_sort(F.collect_list("member")).cast("array<string>"), ",").alias("ids"))
    ordered = pieces.repartition("depth", "conv_id").sortWithinPartitions("depth", "conv_id", "piece")
    return ordered.select("depth", "conv_id", "ids").mapInArrow(_streamed, "depth long, conv_id long, ends_sha256 string")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def trie(conversations: DataFrame, block: int = 20) -> DataFrame:
    """A row for each node of the trie over the rebuilt conversations of (conv_id, turn, role, text)."""
    spark = conversations.sparkSession
    turns, sizes = rebuilt(turn_rows(conversations), block)
    turns = stored(turns.repartition("conv_id").sortWithinPartitions("depth", "conv_id"), "rebuilt")
    n, root = sizes.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    if not n:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    hot = max(HOT, n // HOT)
    live = sizes.withColumn("node", F.lit(root))
    levels = [spark.createDataFrame([(0, root, None, n, 0)], "depth long, conv_id long, parent_conv_id long, n_convs long, words long")]
    ends, alone = [live.filter("length = 0").select(F.lit(0).cast("long").alias("depth"), F.col("node").alias("conv_id"), F.col("conv_id").alias("member"))], []
    depth = 0
    while True:
        depth += 1
        step = stored(live.filter(F.col("length") >= depth).join(turns.filter(F.col("depth") == depth).select("conv_id", "digest", "words"), "conv_id"), "step")
        groups = step.groupBy("node", "digest").agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n"), F.min("words").alias("words"))
        groups = stored(groups, "groups")
        levels.append(groups.select(F.lit(depth).cast("long").alias("depth"), F.col("first").alias("conv_id"), F.col("node").alias("parent_conv_id"), F.col("n").alias("n_convs"), "words"))
        alone.append(levels[-1].filter("n_convs = 1"))
        shared = groups.filter("n > 1").select("node", "digest", "first", "n")
        if shared.isEmpty():
            forget(step)
            break
        found = step.join(F.broadcast(shared.filter(F.col("n") > hot).drop("n")), ["node", "digest"], "left")
        known = found.filter("first is not null").select("conv_id", "length", "first")
        rest = found.filter("first is null").drop("first").join(shared.filter(F.col("n") <= hot), ["node", "digest"]).select("conv_id", "length", "first")
        live = stored(known.unionByName(rest).withColumnRenamed("first", "node"), "live")
        forget(step)
        ends.append(live.filter(F.col("length") == depth).select(F.lit(depth).cast("long").alias("depth"), F.col("node").alias("conv_id"), F.col("conv_id").alias("member")))
    shared = _rolled_up(levels)
    hashed = ends_hashes(_union(ends))
    shared = shared.filter((F.col("n_convs") > 1) | (F.col("depth") == 0)).join(hashed, ["depth", "conv_id"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    return shared.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").unionByName(_chains(turns, sizes, alone))


def _rolled_up(levels: list[DataFrame]) -> DataFrame:
    """From the deepest level up: children, leaves and savings of every node."""
    out, below = [], None
    for level in reversed(levels):
        own = (F.col("n_convs") - 1) * F.col("words")
        if below is None:
            done = level.select("*", F.lit(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), own.alias("saved_tokens"))
        else:
            children = below.groupBy(F.col("parent_conv_id").alias("conv_id")).agg(F.count(F.lit(1)).alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
            done = level.join(children, "conv_id", "left").select(*level.columns, F.coalesce("c", F.lit(0)).alias("n_children"), F.coalesce("l", F.lit(1)).alias("n_leaves"), (own + F.coalesce("s", F.lit(0))).alias("saved_tokens"))
            done = stored(done, "level")
        out.append(done)
        below = done
    return _union(out)


def _chains(turns: DataFrame, sizes: DataFrame, alone: list[DataFrame]) -> DataFrame:
    """The nodes of conversations from where they are alone."""
    tops = _union(alone).select("conv_id", F.col("depth").alias("top"), "parent_conv_id").join(sizes, "conv_id")
    last = F.col("depth") == F.col("length")
    return turns.join(tops, "conv_id").filter("depth >= top").select(
        "conv_id",
        "depth",
        F.when(F.col("depth") == F.col("top"), F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(_EMPTY).alias("ends_sha256"),
    )
