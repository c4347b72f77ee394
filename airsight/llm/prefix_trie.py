"""The prefix trie of conversations, rolled up by centroid decomposition of its parent edges."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsight.llm.common import whole
from airsight.operators.ordered import row_numbers, running
from airsight.session import lookup, stage

#: A conversation takes up to HEADS - 1 turns from the first conversation of its block of BLOCK ids.
BLOCK, HEADS = 100, 6
#: Turns below the top of a component that one task takes; larger components are split by rounds of joins.
COMPONENT_TURNS = 4096
#: Width of the id ranges whose ends are joined before a node's digest reads them in order.
ENDS_WIDTH = 16_384


def _key(*parts: Column) -> Column:
    """128 bits of SHA-256 over the parts."""
    return F.unhex(F.substring(F.sha2(F.concat_ws(",", *parts), 256), 1, 32))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, pos from 1, digest, chars) and all conversations (conv_id, n_turns), as ``prefix_trie`` defines them."""
    role, text = whole(F.col("role")), whole(F.col("text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    light = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars")
    )
    numbered = row_numbers(light, ["conv_id"], [F.asc_nulls_first("turn"), F.col("digest")], "own", total="n_own")
    numbered = stage(numbered.select("conv_id", "own", "n_own", "digest", "chars"), "turns")
    heads = (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h")
    convs = numbered.filter("own = 1").select("conv_id", "n_own", heads, (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("donor"))
    donors = numbered.filter(F.col("own") < HEADS).groupBy(F.col("conv_id").alias("donor")).agg(
        F.array_sort(F.collect_list(F.struct("own", "digest", "chars"))).alias("lent")  # HEADS - 1 turns at most
    )
    # a block has 2 * BLOCK - 1 conversations at most, so no donor is a hot key
    joined = convs.join(donors, "donor", "left").withColumn("taken", F.slice(F.coalesce("lent", F.array().cast(donors.schema["lent"].dataType)), 1, F.col("h").cast("int")))
    plan = lookup(joined.select("conv_id", "n_own", "h", F.size("taken").cast("long").alias("n_taken"), "taken"), "plans")
    lent = plan.select("conv_id", F.explode("taken").alias("t")).select("conv_id", F.col("t.own").alias("pos"), "t.digest", "t.chars")
    own = numbered.join(plan.select("conv_id", "h", "n_taken"), "conv_id").filter("own > h")
    own = own.select("conv_id", (F.col("own") - F.col("h") + F.col("n_taken")).alias("pos"), "digest", "chars")
    kept = F.greatest(F.col("n_own") - F.col("h"), F.lit(0)) + F.col("n_taken")
    return lent.union(own), plan.select("conv_id", kept.cast("long").alias("n_turns"))


def _prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, pos, chars, left, node, parent): the node of every prefix of every conversation and of its prefix one turn shorter.

    A turn counts as four 32-bit hashes of its place and digest; their running sums, hashed with the place, name the prefix.
    So a conversation of any length can be summed in pieces. ``left`` is the number of turns from this one to the last.
    """
    hashed = turns.withColumn("x", F.sha2(F.concat(F.col("pos").cast("string").cast("binary"), F.lit(b":"), F.col("digest")), 256))
    lanes = [f"x{i}" for i in range(4)]
    hashed = hashed.select("conv_id", "pos", "chars", *[F.conv(F.substring("x", 1 + 8 * i, 8), 16, 10).cast("long").alias(x) for i, x in enumerate(lanes)])
    summed = running(hashed, ["conv_id"], ["pos"], {f"s{i}": ("sum", x) for i, x in enumerate(lanes)})
    total = [F.col(f"s{i}") for i in range(4)]
    node = _key(F.col("pos"), *total)
    parent = _key(F.col("pos") - 1, *[t - F.col(x) for t, x in zip(total, lanes)])
    lengths = convs.select(F.col("conv_id").alias("of"), "n_turns")
    rows = summed.select("conv_id", "pos", "chars", node.alias("node"), parent.alias("parent"))
    rows = rows.join(lengths, F.col("conv_id") == F.col("of"))
    rows = rows.select("conv_id", "pos", "chars", (F.col("n_turns") - F.col("pos") + 1).alias("left"), "node", "parent")
    zero = [F.lit(0).cast("long")] * 5
    top = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("chars"), (F.col("n_turns") + 1).alias("left"), _key(*zero).alias("node"), F.lit(None).cast("binary").alias("parent"))
    return stage(rows.union(top), "prefixes")


def _ends(last: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes (conv_id, depth) where conversations (``ended``) end.

    The ids of a range of ENDS_WIDTH are joined to one string first; a node whose ends take several ranges is digested from these strings
    in order, holding one at a time, as a digest is sequential by definition.
    """
    ranged = last.groupBy("conv_id", "depth", F.floor(F.col("ended") / ENDS_WIDTH).alias("range")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("ended")), lambda x: x.cast("string")), ",").alias("ids")
    )
    ranged = stage(ranged, "ends")
    several = lookup(ranged.groupBy("conv_id", "depth").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "several-ends")
    one = ranged.join(several, ["conv_id", "depth"], "left_anti").select("conv_id", "depth", F.sha2("ids", 256).alias("ends_sha256"))
    rest = ranged.join(several, ["conv_id", "depth"], "left_semi").repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "range")
    return one.union(rest.mapInArrow(_digests, "conv_id long, depth long, ends_sha256 string"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(node, digest):
        return pa.RecordBatch.from_pylist([{"conv_id": node[0], "depth": node[1], "ends_sha256": digest.hexdigest()}])

    node, digest = None, None
    for batch in batches:
        for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids"))):
            if (conv, depth) != node:
                if node:
                    yield made(node, digest)
                node, digest = (conv, depth), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if node:
        yield made(node, digest)


def split(component: list[int], parent: list[int], weight: list[int], values: list[tuple[int, ...]], sums: list[list[int]]) -> list[list[int]]:
    """One step of the decomposition on a component given from its top down: its parts. ``sums`` and ``weight`` change in place.

    Nodes with over half of the weight below them form the path from the top to the centroid. What stands below the centroid is
    added up and given to every node of that path; without the centroid and what is below it, the path weighs so much less.
    """
    top = component[0]
    total = weight[top]
    path = [v for v in component if 2 * weight[v] > total]
    centroid = path[-1]
    label = {centroid: centroid}
    above, parts = [], {}
    for v in component:
        if v == centroid:
            continue
        over = parent[v] if v != top else -1
        if over in label:
            label[v] = v if over == centroid else label[over]
            parts.setdefault(label[v], []).append(v)
        else:
            above.append(v)
    below = [centroid, *(v for part in parts.values() for v in part)]
    found = [sum(x) for x in zip(*(values[v] for v in below))]
    less = weight[centroid]
    for v in path:
        for i, x in enumerate(found):
            sums[v][i] += x
        weight[v] -= less
    return ([above] if above else []) + list(parts.values())


def rollup(parent: list[int], weight: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Sums of ``values`` over every subtree. Nodes stand from the top (0) down, ``weight`` is a subtree's and above its children's sum."""
    sums = [[0] * len(values[0]) for _ in parent]
    weight = list(weight)
    open_ = [list(range(len(parent)))]
    while open_:
        component = open_.pop()
        if len(component) == 1:
            sums[component[0]] = [a + b for a, b in zip(sums[component[0]], values[component[0]])]
        else:
            open_.extend(split(component, parent, weight, values, sums))
    return sums


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components, each one's rows together and from the top down, with their own sums added."""
    names = ("top_conv", "top_depth", "conv_id", "depth", "parent_conv_id", "w", "leaf", "saved", "n_leaves", "saved_tokens")
    key, rows, out = None, [], []

    def done() -> None:
        at = {(r[2], r[3]): i for i, r in enumerate(rows)}
        parent = [-1] + [at[r[4], r[3] - 1] for r in rows[1:]]
        for r, (leaves, saved) in zip(rows, rollup(parent, [r[5] for r in rows], [(r[6], r[7]) for r in rows])):
            out.append((r[2], r[3], r[8] + leaves, r[9] + saved))

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["conv_id", "depth", "n_leaves", "saved_tokens"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if row[:2] != key:
                if rows:
                    done()
                key, rows = row[:2], []
                if len(out) > 20_000:
                    yield made()
                    out.clear()
            rows.append(row)
    if rows:
        done()
    if out:
        yield made()


def centroid_rollup(nodes: DataFrame, ancestors: DataFrame, most: int = COMPONENT_TURNS) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens): sums of ``leaf`` and ``saved`` over the subtree of every node.

    ``nodes`` has conv_id, depth, parent_conv_id, w (turns at and below the node, so at least one more than the children together),
    leaf, saved. ``ancestors`` has conv_id, pos, node_conv (the name of the node of the conversation's first ``pos`` turns) and over_conv (that of
    pos - 1). Each round splits every component of over ``most`` turns at its centroid: the nodes with more than half of the turns below
    them are the path from the top to the centroid, without any walk; what stands below is told from the ancestor at the depth of the centroid,
    by one join. Totals below the centroid are added along the path; parts have half of the turns at most, so rounds grow with the logarithm
    of the table. Components of up to ``most`` turns go on by the same steps in one task each.
    """
    state = stage(
        nodes.select(
            F.lit(None).cast("long").alias("top_conv"), F.lit(0).cast("long").alias("top_depth"), "conv_id", "depth", "parent_conv_id", "w", "leaf", "saved",
            F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        ).withColumn("top_conv", F.lit(nodes.agg(F.min("conv_id").alias("c")).first()["c"]).cast("long")),
        "components",
    )
    columns = state.columns
    ready, single = [], []
    while True:
        tops = state.filter("conv_id = top_conv AND depth = top_depth").select("top_conv", "top_depth", F.col("w").alias("total"))
        large = lookup(tops.filter(F.col("total") > most), "large-components")
        if large.isEmpty():
            ready.append(state)
            break
        component = ["top_conv", "top_depth"]
        ready.append(state.join(large, component, "left_anti"))
        open_ = stage(state.join(large, component), "open")
        heavy = open_.filter("2 * w > total")
        at = heavy.groupBy(*component).agg(F.max_by(F.struct("conv_id", "depth", "w"), "depth").alias("c"))
        at = lookup(at.select(*component, F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.w").alias("c_w")), "centroids")
        placed = open_.join(at, component)
        # a node below the centroid has its name one step down: the next component's top
        deeper = placed.filter("depth > c_depth").withColumn("step", F.col("c_depth") + 1)
        named = ancestors.select(F.col("conv_id").alias("a_conv"), F.col("pos").alias("a_pos"), "node_conv", "over_conv")
        deeper = deeper.join(named, (F.col("conv_id") == F.col("a_conv")) & (F.col("step") == F.col("a_pos")))
        deeper = deeper.withColumn("inside", F.col("over_conv") == F.col("c_conv")).drop("step", "a_conv", "a_pos", "over_conv")
        others = placed.filter("depth <= c_depth").withColumn("node_conv", F.lit(None).cast("long"))
        others = others.withColumn("inside", (F.col("depth") == F.col("c_depth")) & (F.col("conv_id") == F.col("c_conv")))
        told = stage(deeper.unionByName(others), "told")
        totals = told.filter("inside").groupBy(*component).agg(F.sum("leaf").alias("t_leaf"), F.sum("saved").alias("t_saved"))
        told = told.join(lookup(totals, "totals"), component)
        on_path = 2 * F.col("w") > F.col("total")
        told = told.withColumn("n_leaves", F.col("n_leaves") + F.when(on_path, F.col("t_leaf")).otherwise(0))
        told = told.withColumn("saved_tokens", F.col("saved_tokens") + F.when(on_path, F.col("t_saved")).otherwise(0))
        is_centroid = (F.col("depth") == F.col("c_depth")) & (F.col("conv_id") == F.col("c_conv"))
        told = stage(told.withColumn("is_centroid", is_centroid).withColumn("on_path", on_path), "rolled")
        single.append(told.filter("is_centroid").select("conv_id", "depth", "n_leaves", "saved_tokens"))
        below = F.col("inside")
        state = stage(told.filter("NOT is_centroid").select(
            F.when(below, F.col("node_conv")).otherwise(F.col("top_conv")).alias("top_conv"), F.when(below, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            "conv_id", "depth", "parent_conv_id", F.when(F.col("on_path"), F.col("w") - F.col("c_w")).otherwise(F.col("w")).alias("w"), "leaf", "saved", "n_leaves", "saved_tokens",
        ), "components")
    together = reduce(DataFrame.union, [r.select(*columns) for r in ready]).repartition("top_conv", "top_depth").sortWithinPartitions("top_conv", "top_depth", "depth", "conv_id")
    finished = together.mapInArrow(_finish, "conv_id long, depth long, n_leaves long, saved_tokens long")
    return reduce(DataFrame.union, [finished, *single])


def prefix_trie(turns: DataFrame, most: int = COMPONENT_TURNS) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations.

    ``turns`` has conv_id, turn, role, text; the turns of a conversation stand by turn (null first), equal ones by a digest of role and
    text. A conversation c is rebuilt from the first h turns of conversation c - c % 100 and its own turns after its first h, h = crc32(c) % 6.
    A node is a distinct sequence of the first ``depth`` rebuilt turns, the root that of none, and its members are the conversations that begin with it. Returns
    conv_id (the least member), depth, parent_conv_id (the parent's conv_id), n_convs, n_children, n_leaves (childless nodes at and below), saved_tokens (over the
    subtree, members but one times the code points of the last text) and ends_sha256 (of the ids, ascending and joined by commas, of members
    that have just these turns).

    Null roles and texts count as empty, rows without a conv_id take no part, repeated rows are turns each, other columns are ignored. Texts of any length are
    digested where they are read and never moved. A table without conversations has no nodes. A conversation or a first turn that a third of all rows share is
    no bound: numbering and running sums split large conversations, counts are added up before they are shuffled, and per-node tables are
    written so that adaptive execution can split a hot one.
    """
    turns, convs = rebuilt(turns.select("conv_id", "turn", "role", "text"))
    rows = _prefixes(turns, convs)
    nodes = stage(rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("pos").alias("depth"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"),
        F.sum("left").alias("w"), F.first("parent").alias("parent"),
    ), "nodes")
    if nodes.isEmpty():
        return nodes.select(
            "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), "n_convs", *[F.col("n_convs").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
            F.lit("").alias("ends_sha256"),
        )
    names = lookup(nodes.select("node", F.col("conv_id").alias("node_conv")), "node-names")
    over = names.select(F.col("node").alias("parent"), F.col("node_conv").alias("over_conv"))
    ancestors = stage(rows.join(names, "node").join(over, "parent", "left").select("conv_id", "pos", "left", "node_conv", "over_conv"), "ancestors")
    children = lookup(nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children")), "children")
    named = nodes.join(over, "parent", "left").join(children, "node", "left").select(
        "conv_id", "depth", F.col("over_conv").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "w",
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    named = stage(named.withColumn("leaf", (F.col("n_children") == 0).cast("long")), "named-nodes")
    rolled = centroid_rollup(named, ancestors.select("conv_id", "pos", "node_conv", "over_conv"), most)
    # turns left: one at the last prefix
    last = ancestors.filter("left = 1").select(F.col("node_conv").alias("conv_id"), F.col("pos").alias("depth"), F.col("conv_id").alias("ended"))
    ends = _ends(last)
    result = named.join(rolled, ["conv_id", "depth"]).join(ends, ["conv_id", "depth"], "left")
    return result.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    )
