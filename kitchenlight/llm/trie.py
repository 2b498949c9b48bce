"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

A node is a distinct sequence of first turns. It is named by its least conversation and its depth, and every member row
``(conv, depth)`` knows its node, so an ancestor is one look-up away. Subtree totals come from splitting: a component's centroid is its
deepest node with more than half of the component's nodes beneath; these nodes form the path from the component's top to the centroid.
The centroid's total, summed over the parts below it, is added to every node of that path; the centroid leaves, each part
below it becomes a component, and so does the rest above. Components of more than ``LOCAL_NODES`` nodes are split by
Spark, all of them in one round; smaller ones are finished many at a time in a task. Halving bounds the rounds by the logarithm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kitchenlight.llm.common import sorted_runs, stored

SHARED_TURNS = 6
BASE_EVERY = 100
LOCAL_NODES = 20_000
FRAME_NODES = 50_000
MOST_BROADCAST = 100_000
ROOT_KEY = bytes(16)

STATE = ("conv_id", "depth", "parent_conv_id", "top_conv", "top_depth", "size", "leaves", "saved", "sum_leaves", "sum_saved")


# ---- conversations and their members ----


def original_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, mark, chars)``: turns numbered from 1, their role and text as a 128-bit mark, the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    slim = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), mark.alias("mark"), F.char_length(text).cast("long").alias("chars")
    )
    by_turn = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "mark")
    return slim.withColumn("pos", F.row_number().over(by_turn).cast("long")).drop("turn")


def shared_turns(conv: Column) -> Column:
    """How many first turns a conversation takes from its base."""
    return F.crc32(conv.cast("string").cast("binary")) % SHARED_TURNS


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``(conv_id, depth, mark, chars)``: turns of every rebuilt conversation, and one row of depth 0 for each."""
    turns = stored(original_turns(conversations), "turns")
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn("h", shared_turns(F.col("conv_id")))
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE_EVERY)
    heads = turns.filter((F.col("pos") < SHARED_TURNS) & (F.col("conv_id") % BASE_EVERY == 0))
    heads = heads.select(F.col("conv_id").alias("base"), F.col("pos").alias("depth"), "mark", "chars")
    taken = convs.join(heads, "base").filter("depth <= h").select("conv_id", "depth", "mark", "chars")
    counts = heads.groupBy("base").agg(F.max("depth").alias("base_turns"))
    begins = convs.join(counts, "base", "left").select("conv_id", "h", F.least("h", F.coalesce("base_turns", F.lit(0))).alias("before"))
    own = turns.join(begins, "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("before")).alias("depth"), "mark", "chars")
    tops = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("mark"), F.lit(0).cast("long").alias("chars"))
    return tops.unionByName(taken).unionByName(own)


def members(turns: DataFrame) -> DataFrame:
    """``(conv_id, depth, key, chars, last)``: the 128-bit key of each sequence of first turns, and whether the conversation ends there.

    A task reads its conversations turn by turn and remembers one key, however long they are.
    """

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = ROOT_KEY
        for batch in batches:
            keys = []
            for depth, mark in zip(batch["depth"], batch["mark"]):
                key = hashlib.blake2b(key + mark, digest_size=16).digest() if depth else ROOT_KEY
                keys.append(key)
            yield batch.assign(key=keys)[["conv_id", "depth", "key", "chars", "last"]]

    lasts = turns.groupBy("conv_id").agg(F.max("depth").alias("end"))
    dealt = turns.join(lasts, "conv_id").withColumn("last", F.col("depth") == F.col("end")).drop("end")
    ordered = dealt.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return ordered.mapInPandas(chain, "conv_id long, depth long, key binary, chars long, last boolean")


def end_digests(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of ``(key, conv_id)``: the ascending ids of a key, comma-joined, hashed as they stream by."""
    ordered = ends.select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for batch in batches:
            out = []
            keys, ids = batch["key"].tolist(), batch["conv_id"].tolist()
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                listed = ",".join(map(str, ids[a:b])).encode()
                if keys[a] == key:
                    state.update(b"," + listed)
                    continue
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = keys[a], hashlib.sha256(listed)
            if out:
                yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if state is not None:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends_sha256"])

    return ordered.mapInPandas(digest, "key binary, ends_sha256 string")


# ---- one component after the other, in a task ----


def rolled_up(parent: np.ndarray, size: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of ``values`` (one row per node) in a forest, by centroid decomposition of all its trees at once.

    ``parent`` is a node's parent or -1; ``size`` the number of nodes beneath and including each.
    """
    count = len(parent)
    sums, size, up = np.zeros_like(values), size.copy(), parent.copy()
    depth = _depths(parent)
    by_depth = np.argsort(depth, kind="stable")
    edges = np.searchsorted(depth[by_depth], np.arange(depth.max(initial=0) + 2))
    levels = [by_depth[a:b] for a, b in zip(edges, edges[1:])]
    alive = np.ones(count, bool)
    while alive.any():
        top = np.arange(count)
        for level in levels[1:]:
            inner = level[(up[level] >= 0) & alive[level]]
            top[inner] = top[up[inner]]
        path = np.flatnonzero(alive & (2 * size > size[top]))
        path = path[np.argsort(depth[path], kind="stable")]
        centroid = np.full(count, -1)
        centroid[top[path]] = path  # of equal places the last, the deepest, stays
        middle = centroid[centroid >= 0]
        under = np.full(count, -1)
        under[middle] = middle
        for level in levels[1:]:
            inner = level[(up[level] >= 0) & alive[level]]
            inner = inner[under[inner] < 0]
            under[inner] = under[up[inner]]
        held = np.flatnonzero(under >= 0)
        totals = np.zeros_like(values)
        np.add.at(totals, under[held], values[held])
        totals = totals[middle]
        taken = size[middle].copy()
        sums[middle] += totals
        at, live = up[middle].copy(), np.arange(len(middle))
        while True:  # all centroids climb to their tops together
            live = live[at[live] >= 0]
            if not len(live):
                break
            sums[at[live]] += totals[live]
            size[at[live]] -= taken[live]
            at[live] = up[at[live]]
        alive[middle] = False
        loose = np.flatnonzero(up >= 0)
        up[loose[~alive[up[loose]]]] = -1
        up[middle] = -1
    return sums


def _depths(parent: np.ndarray) -> np.ndarray:
    depth, at = np.zeros(len(parent), np.int64), parent.copy()
    while (live := at >= 0).any():
        depth[live] += 1
        at[live] = parent[at[live]]
    return depth


def finish(frame: pd.DataFrame) -> pd.DataFrame:
    """The state of whole components with the sums of their nodes added."""
    frame = frame.reset_index(drop=True)
    component = [frame["top_conv"], frame["top_depth"]]
    own = pd.MultiIndex.from_arrays([frame["conv_id"], frame["depth"], *component])
    place = own.get_indexer(pd.MultiIndex.from_arrays([frame["parent_conv_id"].fillna(-1), frame["depth"] - 1, *component]))
    sums = rolled_up(place, frame["size"].to_numpy(), frame[["leaves", "saved"]].to_numpy())
    return frame.assign(sum_leaves=frame["sum_leaves"] + sums[:, 0], sum_saved=frame["sum_saved"] + sums[:, 1])


# ---- large components, in rounds ----


def _split(large: DataFrame, paths: DataFrame) -> DataFrame:
    """One round over components that are all large; centroids come back with ``top_conv`` null.

    ``paths`` has one row ``(conv_id, depth, node_conv, above_conv)`` per member: its node's and that node's parent's conversation.
    """
    top = ("top_conv", "top_depth")
    totals = large.groupBy(*top).agg(F.max("size").alias("total"))
    few = totals.count() <= MOST_BROADCAST

    def with_component(df: DataFrame, of: DataFrame) -> DataFrame:
        return df.join(F.broadcast(of) if few else of, list(top))

    heavy = with_component(large, totals).filter(2 * F.col("size") > F.col("total"))
    deepest = heavy.groupBy(*top).agg(F.max_by(F.struct("conv_id", "depth", "size"), "depth").alias("c"))
    centroids = stored(deepest.select(*top, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.size").alias("c_size")), "centroids")
    marked = with_component(with_component(large, centroids), totals)
    part = paths.select(F.col("conv_id").alias("conv_id"), F.col("depth").alias("part_depth"), F.col("node_conv").alias("part_conv"), "above_conv")
    placed = marked.withColumn("part_depth", F.col("c_depth") + 1).join(part, ["conv_id", "part_depth"], "left")
    below = (F.col("depth") > F.col("c_depth")) & F.coalesce(F.col("above_conv") == F.col("c_conv"), F.lit(False))
    middle = (F.col("depth") == F.col("c_depth")) & (F.col("conv_id") == F.col("c_conv"))
    placed = stored(placed.withColumns({"below": below, "middle": middle}).drop("above_conv"), "placed")
    sums = placed.filter("below OR middle").groupBy(*top).agg(F.sum("leaves").alias("add_leaves"), F.sum("saved").alias("add_saved"))
    on_path = F.col("middle") | (2 * F.col("size") > F.col("total"))
    added = with_component(placed, sums)
    changes = {
        "sum_leaves": F.col("sum_leaves") + F.when(on_path, F.col("add_leaves")).otherwise(0),
        "sum_saved": F.col("sum_saved") + F.when(on_path, F.col("add_saved")).otherwise(0),
        "size": F.col("size") - F.when(on_path & ~F.col("middle"), F.col("c_size")).otherwise(0),
        "top_conv": F.when(F.col("middle"), None).when(F.col("below"), F.col("part_conv")).otherwise(F.col("top_conv")),
        "top_depth": F.when(F.col("middle"), None).when(F.col("below"), F.col("part_depth")).otherwise(F.col("top_depth")),
    }
    return added.withColumns(changes).select(*STATE)


def roll_up(nodes: DataFrame, paths: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """``(conv_id, depth, sum_leaves, sum_saved)``: sums of ``leaves`` and ``saved`` over each node's subtree.

    ``nodes`` holds ``STATE`` with every tree as one component; a component of at most ``local_nodes`` nodes is finished in one task.
    """
    done: list[DataFrame] = []
    at = nodes
    while True:
        sizes = at.groupBy("top_conv", "top_depth").agg(F.max("size").alias("held")).filter(F.col("held") > local_nodes)
        named = stored(sizes.select("top_conv", "top_depth"), "large")
        few = named.count()
        if few == 0:
            break
        mark = F.broadcast(named) if few <= MOST_BROADCAST else named
        done.append(at.join(mark, ["top_conv", "top_depth"], "left_anti").select(*STATE))
        split = stored(_split(at.join(mark, ["top_conv", "top_depth"], "left_semi").select(*STATE), paths), "split")
        done.append(split.filter("top_conv IS NULL"))
        at = split.filter("top_conv IS NOT NULL")
    done.append(at.select(*STATE))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keyed = (b.assign(component=b["top_conv"].astype(str) + "," + b["top_depth"].astype(str)) for b in batches)
        for frame in sorted_runs(keyed, "component", FRAME_NODES):
            yield finish(frame)[["conv_id", "depth", "sum_leaves", "sum_saved"]]

    kind = "conv_id long, depth long, sum_leaves long, sum_saved long"
    open_parts = whole.filter("top_conv IS NOT NULL").repartition("top_conv", "top_depth").sortWithinPartitions("top_conv", "top_depth")
    closed = open_parts.mapInPandas(close, kind)
    return closed.unionByName(whole.filter("top_conv IS NULL").select("conv_id", "depth", "sum_leaves", "sum_saved"))


def prefix_trie(conversations: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by ``turn``, null first; of equal turns the order is that of a digest of role and text, so it does not depend on the
    input's order. Null role and text are empty; repeated rows are turns of their own; rows without a ``conv_id`` belong to
    no conversation and are left out; texts are read as 128-bit digests, however long; extra columns are ignored;
    an empty table has no members and gives no rows, not even a root.
    """
    held = stored(members(rebuilt(conversations)), "members")
    counted = held.groupBy("key").agg(F.min("conv_id").alias("node_conv"), F.first("depth").alias("depth"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"))
    nodes = stored(counted, "nodes")
    named = held.join(nodes.select("key", "node_conv"), "key").select("conv_id", "depth", "node_conv")
    above = Window.partitionBy("conv_id").orderBy("depth")
    paths = stored(named.withColumn("above_conv", F.lag("node_conv").over(above)), "paths")

    own = nodes.groupBy(F.col("node_conv").alias("conv_id")).agg(F.count("*").alias("own"), F.min("depth").alias("first"))
    beneath = paths.join(own, "conv_id").groupBy("node_conv", "depth").agg(F.sum("own").alias("held"))
    parents = paths.filter("conv_id = node_conv").select("node_conv", "depth", F.col("above_conv").alias("parent_conv_id"))
    children = parents.filter("depth > 0").groupBy(F.col("parent_conv_id").alias("node_conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    at = ["node_conv", "depth"]
    whole = nodes.join(parents, at).join(beneath, at).join(children, at, "left").join(own.select(F.col("conv_id").alias("node_conv"), "first"), "node_conv")
    whole = whole.withColumns({
        "conv_id": F.col("node_conv"), "n_children": F.coalesce("n_children", F.lit(0)), "size": F.col("held") - (F.col("depth") - F.col("first")),
        "saved": (F.col("n_convs") - 1) * F.col("chars"),
    })
    whole = stored(whole.select("conv_id", "depth", "parent_conv_id", "key", "n_convs", "n_children", "size", "saved"), "trie")

    root = whole.filter("depth = 0").select("conv_id").first()
    none = F.lit(0).cast("long")
    state = whole.withColumns({
        "top_conv": F.lit(root and root.conv_id).cast("long"), "top_depth": none, "leaves": (F.col("n_children") == 0).cast("long"), "sum_leaves": none, "sum_saved": none
    })
    sums = roll_up(stored(state.select(*STATE), "state"), paths, local_nodes)
    ends = end_digests(held.filter("last"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    found = whole.join(sums, ["conv_id", "depth"]).join(ends, "key", "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("sum_leaves").alias("n_leaves"),
        F.col("sum_saved").alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
