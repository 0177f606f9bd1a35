"""Prefix trie of rebuilt conversations by burst tries.

Conversations are cut into windows of turns. In each window, suffix containers
hang below the nodes where they start. A container with too many turns bursts:
the turns that all its suffixes share and the node behind them become trie
nodes, and the suffixes go to a container for each next turn. The other
containers are sorted and swept into nodes by a stack of open ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweave.llm.turns import joined_digests, placed, turn_name
from goldweave.session import Scratch


@dataclass(frozen=True)
class Settings:
    """A container of more than ``capacity`` turns bursts. ``window`` turns of a conversation are handled at a time.

    ``span`` conversations share the head of one of them: the first turns of
    the conversation whose id is the next multiple of ``span`` towards zero, as
    many as the checksum of the own id leaves over ``heads``. Only the last two
    change the result.
    """

    capacity: int = 1 << 17
    window: int = 64
    span: int = 100
    heads: int = 6


# Fixed value: bytes of a turn's name.
_NAME = 16

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, sha string"


def _name(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def named_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, position, name, size): the turns of each conversation in order, named by role and text."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return placed(rows, scratch, turn_name().alias("name"), F.char_length("text").cast("long").alias("size"))


def rebuilt(turns: DataFrame, scratch: Scratch, cfg: Settings) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their turns by window (conv_id, w, path, sizes), heads exchanged."""
    few = F.when(F.col("position") < cfg.heads - 1, F.struct("position", "name", "size"))
    own = scratch.save(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(few)).alias("first")), "own")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(cfg.heads)).cast("int")
    asks = own.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % cfg.span).alias("base"))
    heads = asks.join(own.select(F.col("conv_id").alias("base"), "first"), "base", "left").withColumn(
        "head", F.slice(F.coalesce("first", F.array().cast(own.schema["first"].dataType)), F.lit(1), F.col("h")))
    convs = scratch.save(heads.select(
        "conv_id", "h", F.size("head").alias("k"), "head", (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "convs")
    tails = turns.join(convs.select("conv_id", "h", "k"), "conv_id").filter("position >= h").select(
        "conv_id", (F.col("position") - F.col("h") + F.col("k")).alias("place"), "name", "size")
    taken = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.position").alias("place"), "t.name", "t.size")
    pieces = tails.unionByName(taken).groupBy("conv_id", F.floor(F.col("place") / cfg.window).cast("int").alias("w")).agg(
        F.array_sort(F.collect_list(F.struct("place", "name", "size"))).alias("turns"))
    path = F.aggregate("turns", F.lit(b""), lambda path, t: F.concat(path, t["name"]))
    return convs.select("conv_id", "length"), scratch.save(pieces.select("conv_id", "w", path.alias("path"), F.col("turns.size").alias("sizes")), "windows")


class _Node:
    """An open node of the sweep; ``rows`` are its closed children, which wait for its smallest member."""

    __slots__ = ("size", "n", "low", "children", "leaves", "saved", "sha", "rows")

    def __init__(self, size):
        self.size, self.n, self.low, self.children, self.leaves, self.saved, self.sha, self.rows = size, 0, None, 0, 0, 0, None, []

    def member(self, low):
        self.low = low if self.low is None else min(self.low, low)


def _sweep(batches):
    """Nodes below each container's anchor, and one row with ``anchor`` for the anchor itself; rows come sorted by anchor and path."""
    import pyarrow as pa

    names = ["anchor", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "sha"]
    out: list[tuple] = []

    def flush():
        columns = list(zip(*out)) or [()] * len(names)
        types = [pa.binary(), *[pa.int64()] * 7, pa.string()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def close():
        node, level = stack.pop(), depth + len(stack)
        out.extend((None, *row[:2], node.low, *row[2:]) for row in node.rows)
        own = (node.n, node.children, node.leaves if node.children else 1)
        if stack:
            saved = node.saved + (node.n - 1) * node.size
            up = stack[-1]
            up.rows.append((node.low, level, *own, saved, node.sha))
            up.n, up.children, up.leaves, up.saved = up.n + node.n, up.children + 1, up.leaves + own[2], up.saved + saved
            up.member(node.low)
        else:
            out.append((anchor, node.low, level, None, *own, node.saved, node.sha))

    stack: list[_Node] = []
    anchor, depth, last = None, 0, b""
    for batch in batches:
        for row in batch.to_pylist():
            path = row["path"]
            if not stack or row["anchor"] != anchor:
                while stack:
                    close()
                anchor, depth, last = row["anchor"], row["depth"], b""
                stack.append(_Node(0))
            common, most = 0, min(len(path), len(last))
            while common < most and path[common:common + _NAME] == last[common:common + _NAME]:
                common += _NAME
            while len(stack) > common // _NAME + 1:
                close()
            stack.extend(_Node(size) for size in row["sizes"][common // _NAME:])
            node, last = stack[-1], path
            node.n, node.sha = node.n + row["n"], row["sha"]
            node.children, node.leaves, node.saved = row["more_children"], row["more_leaves"], row["more_saved"]
            node.member(row["low"])
        yield flush()
    while stack:
        close()
    yield flush()


def _shared(low: Column, high: Column) -> Column:
    """Turns at the start that two paths share."""
    least = F.floor(F.least(F.octet_length(low), F.octet_length(high)) / _NAME).cast("int")
    at = lambda path, i: F.substring(path, i * _NAME + 1, _NAME)
    same = F.transform(F.sequence(F.lit(0), least - 1), lambda i: low.substr(i * _NAME + 1, F.lit(_NAME)) == high.substr(i * _NAME + 1, F.lit(_NAME)))
    first = F.array_position(same, F.lit(False)).cast("int")
    return F.when(least == 0, 0).when(first == 0, least).otherwise(first - 1)


def _window_nodes(held: DataFrame, scratch: Scratch, cfg: Settings, label: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, anchors) of one window's containers.

    ``held`` has the distinct paths: anchor, depth, path, sizes, n (members),
    low (the smallest), sha (digest of those that end there), and what lies
    below the path's end in later windows: more_children, more_leaves, more_saved.
    """
    live, resting, bursts = held, [], []
    while True:
        r = f"{label}-{len(bursts)}"
        sizes = live.groupBy("anchor", "depth").agg(
            F.sum(F.size("sizes") + 1).alias("turns"), F.count(F.lit(1)).alias("paths"), F.min("path").alias("lo"), F.max("path").alias("hi"))
        big = scratch.save(sizes.filter((F.col("turns") > cfg.capacity) & (F.col("paths") > 1)).select(
            "anchor", "depth", _shared(F.col("lo"), F.col("hi")).alias("k"), F.col("hi").substr(F.lit(1), _shared(F.col("lo"), F.col("hi")) * _NAME).alias("chain")), f"big-{r}")
        if big.isEmpty():
            break
        resting.append(live.join(big.select("anchor"), "anchor", "left_anti"))
        split = scratch.save(live.join(big.select("anchor", "k"), "anchor"), f"split-{r}")
        goes = F.size("sizes") > F.col("k")
        next_name = F.col("path").substr(F.lit(1), (F.col("k") + 1) * _NAME)
        child = _name(F.col("anchor"), next_name)
        links = split.filter(goes).groupBy(child.alias("child")).agg(
            F.first("anchor").alias("anchor"), F.first(F.get("sizes", F.col("k"))).alias("size"))
        here = split.filter(~goes).select("anchor", *[F.col(c).alias(f"e_{c}") for c in ("n", "low", "sha", "more_children", "more_leaves", "more_saved")])
        chains = split.groupBy("anchor").agg(F.first(F.slice("sizes", F.lit(1), F.col("k"))).alias("chain_sizes"))
        bursts.append((big.join(chains, "anchor").join(here, "anchor", "left"), scratch.save(links, f"links-{r}")))
        live = scratch.save(split.filter(goes).select(
            child.alias("anchor"), (F.col("depth") + F.col("k") + 1).alias("depth"), F.col("path").substr((F.col("k") + 1) * _NAME + 1, F.octet_length("path")).alias("path"),
            F.slice("sizes", F.col("k") + 2, F.greatest(F.size("sizes") - F.col("k") - 1, F.lit(0))).alias("sizes"),
            "n", "low", "sha", "more_children", "more_leaves", "more_saved"), f"live-{r}")
    resting.append(live)
    shards = reduce(DataFrame.unionByName, resting).repartition("anchor").sortWithinPartitions("anchor", "path")
    swept = scratch.save(shards.mapInArrow(_sweep, f"anchor binary, {_NODE}"), f"swept-{label}")
    nodes, anchors = [swept.filter("anchor IS NULL").drop("anchor")], swept.filter("anchor IS NOT NULL")

    for step, (heads, links) in reversed(list(enumerate(bursts))):
        # The nodes above what this burst made: first the children, then the node they hang on and the turns before it.
        below = scratch.save(links.join(anchors.withColumnRenamed("anchor", "child"), "child").withColumn(
            "saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")), f"below-{label}-{step}")
        sums = below.groupBy("anchor").agg(
            F.sum("n_convs").alias("n"), F.min("conv_id").alias("low"), F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
        joint = scratch.save(sums.join(heads, "anchor").select(
            "anchor", "depth", "k", "chain_sizes", plus("n", "e_n"), F.least("low", "e_low").alias("low"), plus("children", "e_more_children"),
            plus("leaves", "e_more_leaves"), plus("saved", "e_more_saved"), F.col("e_sha").alias("sha")), f"joint-{label}-{step}")
        nodes.append(below.join(joint.select("anchor", F.col("low").alias("above")), "anchor").select(
            "conv_id", "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "sha"))
        # The node behind i of the k shared turns; the one behind all of them is where the container branches.
        deep = F.col("i") == F.col("k")
        left = lambda i: F.aggregate(F.slice("chain_sizes", i, F.greatest(F.col("k") - i + 1, F.lit(0))), F.lit(0).cast("long"), lambda a, b: a + b) * (F.col("n") - 1)
        line = joint.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k")))).select(
            "anchor", "i", F.col("low").alias("conv_id"), (F.col("depth") + F.col("i")).cast("long").alias("depth"), F.col("low").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.when(deep, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
            (F.col("saved") + F.when(F.col("i") > 0, left(F.col("i"))).otherwise(left(F.lit(1)))).alias("saved_tokens"), F.when(deep, F.col("sha")).alias("sha"))
        nodes.append(line.filter("i > 0").drop("anchor", "i"))
        anchors = anchors.unionByName(line.filter("i = 0").drop("i").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return reduce(DataFrame.unionByName, nodes), anchors


def prefix_trie(conversations: DataFrame, scratch: Scratch, cfg: Settings = Settings()) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    Turns are ordered by ``turn``, nulls first, equal ones by role and text;
    null roles and texts are empty. A conversation c is rebuilt from the first
    h turns of conversation c - c % ``span`` and its own turns after the first
    h, where h is the remainder of the CRC-32 of c in decimal over ``heads``.
    Each distinct sequence of first turns is a node, the empty one the root.

    Columns: conv_id (smallest conversation that starts so), depth,
    parent_conv_id (the parent's conv_id; null for the root), n_convs,
    n_children, n_leaves (nodes without children in the subtree, the node
    itself counted), saved_tokens (sum over the subtree of (n_convs - 1) times
    the code points of the node's last text) and ends_sha256 (SHA-256 of the ids
    of the conversations that are just this sequence, ascending, comma-joined).

    Rows without a conv_id belong to no conversation. Repeated rows are turns
    of their own. Empty input has no conversation and so no root: the result is
    empty. Extra columns are left out. Roles and texts, however long, are told
    apart by a 128-bit hash.
    """
    turns = scratch.save(named_turns(conversations, scratch), "turns")
    lengths, windows = rebuilt(turns, scratch, cfg)
    root = F.lit(b"")
    # Down the windows: who walks on together. A window's paths are distinct; whoever is alone at the end of one is a chain from there.
    walkers = lengths.select("conv_id", "length", root.alias("anchor"))
    levels, alone = [], []
    while True:
        w = len(levels)
        here = walkers.join(windows.filter(F.col("w") == w).drop("w"), "conv_id", "left" if w == 0 else "inner").select(
            "conv_id", "length", "anchor", F.coalesce("path", root).alias("path"), F.coalesce("sizes", F.array().cast("array<bigint>")).alias("sizes"))
        walked = scratch.save(here.withColumns({
            "key": F.when(F.col("path") == root, F.col("anchor")).otherwise(_name(F.col("anchor"), F.col("path"))),
            "on": F.col("length") > cfg.window * (w + 1)}), f"walked-{w}")
        paths = scratch.save(walked.groupBy("key").agg(
            *[F.first(c).alias(c) for c in ("anchor", "path", "sizes")], F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"),
            F.count_if("on").alias("n_on")), f"paths-{w}")
        ends = joined_digests(walked.filter("NOT on"), F.col("key"), F.col("conv_id").cast("string"), ",", "conv_id")
        levels.append(scratch.save(paths.join(ends, "key", "left"), f"level-{w}"))
        going = walked.filter("on").join(paths.select("key", (F.col("n") > 1).alias("together")), "key").select("conv_id", "length", F.col("key").alias("anchor"), "together")
        going = scratch.save(going, f"going-{w}")
        alone.append(going.filter("NOT together").select("conv_id", "length", F.lit(w).alias("since")))
        walkers = going.filter("together").drop("together")
        if walkers.isEmpty():
            break

    # Up again: a path's end takes over what the next window found below it.
    nodes, below = [], None
    for w, level in reversed(list(enumerate(levels))):
        lone = F.when((F.col("n") == 1) & (F.col("n_on") == 1), 1).otherwise(0).cast("long")
        more = [lone.alias("more_children"), lone.alias("more_leaves"), F.lit(0).cast("long").alias("more_saved")]
        if below is not None:
            level = level.join(below, "key", "left")
            more = [F.coalesce(f"b_{c}", value).alias(f"more_{c}") for c, value in zip(("children", "leaves", "saved"), more)]
        held = level.select("anchor", F.lit(w * cfg.window).cast("long").alias("depth"), "path", "sizes", "n", "low", "sha", *more)
        if w:  # the node that a window starts at may have a smaller member that ends there
            none = F.lit(0).cast("long")
            held = held.unionByName(levels[w - 1].filter("n > 1 AND n_on > 0").select(
                F.col("key").alias("anchor"), F.lit(w * cfg.window).cast("long").alias("depth"), root.alias("path"), F.array().cast("array<bigint>").alias("sizes"),
                none.alias("n"), "low", F.lit(None).cast("string").alias("sha"), *[none.alias(f"more_{c}") for c in ("children", "leaves", "saved")]))
        held = scratch.save(held, f"held-{w}")
        found, anchors = _window_nodes(held, scratch, cfg, str(w))
        nodes.append(found)
        below = anchors.select(F.col("anchor").alias("key"), F.col("n_children").alias("b_children"), F.col("n_leaves").alias("b_leaves"), F.col("saved_tokens").alias("b_saved"))
    top = anchors.filter(F.col("anchor") == root).drop("anchor")

    lonely = windows.join(reduce(DataFrame.unionByName, alone), "conv_id").filter("w > since").select(
        "conv_id", "length", (F.posexplode("sizes").alias("i", "size")), "w")
    depth = F.col("w").cast("long") * cfg.window + F.col("i") + 1
    last = depth == F.col("length")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    chains = lonely.select(
        "conv_id", depth.alias("depth"), F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"), F.when(last, none).otherwise(one).alias("n_children"),
        one.alias("n_leaves"), none.alias("saved_tokens"), F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).alias("sha"))
    every = reduce(DataFrame.unionByName, [top, *nodes, chains])
    return every.select(*[c for c in every.columns if c != "sha"], F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
