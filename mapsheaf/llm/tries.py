"""The trie of conversations that begin alike, as balanced parentheses per shard.

Conversations are rebuilt from a shared head and their own turns, sorted by their turns and
cut into shards of about ``SHARD`` turns. A shard writes its trie as balanced parentheses:
``findclose``, through blocks of least excess, delimits a subtree, the rank of ``()`` counts
its leaves, cumulative arrays in preorder give members and saved bytes. Only nodes on the
paths of a shard's first and last conversation, its spines, can be in other shards too. They
leave it with what hangs beside the spines; equal nodes are merged, and sums run up the lines.

Nothing is gathered by conversation or by prefix. Turns are ordered by a range sort, a
conversation's turns go on as pieces of ``SEGMENT`` at most, and those beyond it are units of
their own: a trie below each node of that depth. Totals of units are added up by pointer
doubling and enter the level above as weights. Copies are neighbours in the sorted order, so
any number of them are spread over shards. Nodes are told apart by 128-bit digests of
their turns; texts are not shuffled.

Turns are ordered by ``turn``, null first; turns of one number by the MD5 of
``length(role):role text`` . Null roles and texts are empty; repeated rows are turns of their
own. Rows without ``conv_id`` belong to no conversation and are left out; further columns are
ignored. No conversations give no nodes, not even a root.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapsheaf.llm.common import BROADCAST_KEYS, materialize
from mapsheaf.llm.parentheses import Parentheses

# Turns of a conversation that one unit holds, turns of a shard, bytes of a list of members.
SEGMENT, SHARD, CHUNK = 256, 1 << 18, 16 << 10
# Fixed values of the rule that rebuilds conversations.
GROUP, HEADS = 5, 9

EMPTY = sha256(b"").hexdigest()
PIECES = "part int, no long, conv_id long, start long, path array<struct<a:long,b:long,size:long>>"
NODES = ("line long, chunk int, k long, rel long, x long, y long, px long, py long, parent_line boolean,"
         " conv_id long, parent_conv long, n long, children long, leaves long, saved long, size long,"
         " below_children long, below_leaves long, below_saved long, goes_on boolean, ends string")
BELOW = ("below_children", "below_leaves", "below_saved")


def _few(df: DataFrame) -> DataFrame:
    """``df``, a written table, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


def _pieces(conversations: DataFrame) -> DataFrame:
    """``conv_id, start, path``: each conversation's turns in order, in pieces; the first starts at 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = ["conv_id", F.col("turn").asc_nulls_first(), "digest", "row"]
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("row"))
    ordered = turns.repartitionByRange(*key).sortWithinPartitions(*key).select("conv_id", "digest", "size")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, last, before = TaskContext.get().partitionId(), 0, None, 0
        for batch in parts:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            first = np.flatnonzero(np.diff(conv, prepend=conv[0] - 1))
            run = np.repeat(np.arange(len(first)), np.diff(first, append=len(conv)))
            start = np.arange(len(conv)) - first[run]
            start[run == 0] += before if conv[0] == last else 0
            cut = np.flatnonzero((np.arange(len(conv)) == first[run]) | (start % SEGMENT == 0))
            words = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">i8").reshape(-1, 2).astype(np.int64)
            path = pa.StructArray.from_arrays(
                [pa.array(words[:, 0]), pa.array(words[:, 1]), batch.column(2)], ["a", "b", "size"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cut), part, np.int32)), pa.array(no + np.arange(len(cut))),
                 pa.array(conv[cut]), pa.array(start[cut]),
                 pa.ListArray.from_arrays(pa.array(np.append(cut, len(conv)).astype(np.int32)), path)],
                ["part", "no", "conv_id", "start", "path"])
            no, last, before = no + len(cut), conv[-1], start[-1] + 1

    pieces = materialize(ordered.mapInArrow(batches, PIECES), "pieces")
    # Only the first conversation of a task can have begun in an earlier one.
    entering = _few(materialize(pieces.where("no = 0").select("part", "conv_id"), "entering"))
    spans = pieces.join(entering.select("conv_id").distinct(), "conv_id", "left_semi").groupBy(
        "conv_id", "part").agg(F.sum(F.size("path")).cast("long").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = materialize(spans.withColumn("carry", F.sum("n").over(earlier)).where("carry > 0").drop("n"), "carried")
    return pieces.join(_few(carried), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("start") + F.coalesce("carry", F.lit(0))).alias("start"), "path")


def _segments(pieces: DataFrame) -> DataFrame:
    """``conv_id, k, path``: the rebuilt conversations in segments of ``SEGMENT`` turns.

    ``path`` holds two hashes of each turn at its depth, and the size of its text.
    """
    most = HEADS - 1
    leading = pieces.where((F.col("conv_id") % GROUP == 0) & (F.col("start") < most)).select(
        F.col("conv_id").alias("base"), "start", F.slice("path", 1, most).alias("path"))
    heads = leading.groupBy("base").agg(F.slice(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("start", "path"))), lambda p: p["path"])), 1, most).alias("head"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    first = pieces.where("start = 0")
    lead = first.select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")).join(
        heads, "base", "left").select("conv_id", taken.cast("int").alias("h"), F.when(
            F.col("head").isNotNull(), F.slice("head", F.lit(1), taken.cast("int"))).otherwise(
            F.slice(F.array(F.struct(*(F.lit(0).cast("long").alias(c) for c in ("a", "b", "size")))), 1, 0)).alias("head"))
    more = pieces.where("start > 0")
    of_more = _few(materialize(lead.join(more.select("conv_id").distinct(), "conv_id", "left_semi"), "long"))
    whole = F.lit(SEGMENT)
    begun = first.join(lead, "conv_id").select("conv_id", F.lit(0).cast("long").alias("at"), F.concat(
        "head", F.slice("path", F.col("h") + 1, whole)).alias("path"))
    dropped = F.greatest(F.col("h") - F.col("start"), F.lit(0)).cast("int")
    going_on = more.join(of_more, "conv_id").select(
        "conv_id", (F.size("head") + F.greatest(F.col("start") - F.col("h"), F.lit(0))).alias("at"),
        F.slice("path", dropped + 1, whole).alias("path")).where(F.size("path") > 0)
    at, size = F.col("at"), F.size("path")

    def part(k: Column) -> Column:
        begin = F.greatest(at, k * SEGMENT)
        return F.struct(k.alias("k"), begin.alias("at"), F.slice(
            "path", (begin - at + 1).cast("int"), ((k + 1) * SEGMENT - begin).cast("int")).alias("path"))

    parts = begun.union(going_on).select("conv_id", F.explode(F.transform(F.sequence(
        F.floor(at / SEGMENT), F.floor(F.greatest(at + size - 1, at) / SEGMENT)), part)).alias("p")).select("conv_id", "p.*")
    joined = parts.groupBy("conv_id", "k").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "path"))), lambda p: p["path"])).alias("path"))
    return joined.select("conv_id", "k", F.transform("path", lambda t, i: F.struct(
        F.xxhash64(t["a"], t["b"], F.col("k") * SEGMENT + i).alias("x"),
        F.xxhash64(t["b"], F.col("k") * SEGMENT + i, t["a"]).alias("y"), t["size"].alias("size"))).alias("path"))


def _units(segments: DataFrame) -> DataFrame:
    """``conv_id, k, x, y, px, py, nx, ny``: the units of conversations of several segments.

    A unit is known by the digest of all turns above it; also those of the units before and after.
    """
    long = segments.where("k > 0").select("conv_id").distinct()

    def digest(of: str) -> Column:
        return F.aggregate("path", F.lit(0).cast("long"), lambda total, t: total.bitwiseXOR(t[of]))

    sums = segments.select("conv_id", "k", digest("x").alias("x"), digest("y").alias("y")).join(
        long, "conv_id", "left_semi")
    order = Window.partitionBy("conv_id").orderBy("k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    own = sums.select("conv_id", "k", *(F.coalesce(F.expr(f"bit_xor({c})").over(before), F.lit(0)).alias(c) for c in "xy"))
    return own.select("*", *(F.lag(c).over(order).alias(f"p{c}") for c in "xy"),
                      *(F.lead(c).over(order).alias(f"n{c}") for c in "xy"))


class _Shard:
    """The trie of some neighbouring segments, sorted by unit, path and conversation."""

    def __init__(self, rows: pa.Table):
        def column(name: str) -> np.ndarray:
            return rows.column(name).to_numpy()

        paths = rows.column("path").combine_chunks()
        turns = paths.flatten()
        self.x, self.y, self.size = (turns.field(n).to_numpy() for n in ("x", "y", "size"))
        self.length = np.diff(paths.offsets.to_numpy()).astype(np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.k, self.ux, self.uy, self.conv = (column(c) for c in ("k", "ux", "uy", "conv_id"))
        self.goes_on = rows.column("goes_on").to_numpy(zero_copy_only=False)
        self.below = {c: column(c) for c in BELOW}

    def common(self) -> np.ndarray:
        """Turns that each row shares with the one before; -1 in another unit, and for the first."""
        row = np.repeat(np.arange(len(self.length)), self.length)
        depth = np.arange(len(row)) - self.first[row]
        inside = (row > 0) & (depth < self.length[row - 1])
        before = np.where(inside, self.first[row - 1] + depth, 0)
        differs = ~inside | (self.x != self.x[before]) | (self.y != self.y[before])
        shared = self.length.copy()
        at = np.flatnonzero(differs)
        np.minimum.at(shared, row[at], depth[at])
        same = np.zeros(len(shared), bool)
        same[1:] = ((self.k[1:] == self.k[:-1]) & (self.ux[1:] == self.ux[:-1]) & (self.uy[1:] == self.uy[:-1]))
        return np.where(same, shared, -1)

    def nodes(self, shard: int) -> pa.RecordBatch:
        rows = len(self.length)
        shared = self.common()
        opened = self.length - shared
        closed = np.append([0], self.length[:-1] - shared[1:])
        runs = np.append(np.stack([closed, opened], axis=1).ravel(), self.length[-1] + 1)
        tree = Parentheses(runs)
        close = tree.find_close()
        row = np.repeat(np.arange(rows), opened)
        node = np.arange(len(row))
        begin = np.cumsum(opened) - opened
        rel = shared[row] + 1 + node - begin[row]
        end = tree.rank[close]  # of the subtree, in preorder

        # The node before in preorder, or for a row's first one the last before it a level higher.
        parent = node - 1
        heads = begin[(opened > 0) & (shared >= 0)]
        wide = len(node) + 1
        by_depth = np.sort(rel * wide + node)
        parent[heads] = by_depth[np.searchsorted(by_depth, (rel[heads] - 1) * wide + heads) - 1] % wide
        parent[rel == 0] = -1

        last = np.cumsum(opened) - 1  # the node that each row ends at

        def summed(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            return total[end] - total[node]

        n = summed(np.bincount(last, minlength=len(node)))
        bottom = np.zeros(len(node), bool)
        bottom[last[self.goes_on]] = True
        below = {}
        for name, values in self.below.items():
            below[name] = np.zeros(len(node), np.int64)
            below[name][last[self.goes_on]] = values[self.goes_on]
        at = np.where(rel > 0, self.first[row] + rel - 1, 0)

        def turn(values: np.ndarray) -> np.ndarray:
            return np.where(rel > 0, values[at] if len(values) else 0, 0)

        size = turn(self.size)
        leaves = tree.pairs[close] - tree.pairs[tree.opens] - summed(
            bottom & (end == node + 1)) + summed(below["below_leaves"])
        saved = summed((n - 1) * size + below["below_saved"])
        children = np.bincount(parent[parent >= 0], minlength=len(node)) + below["below_children"]

        def digest(values: np.ndarray, unit: np.ndarray) -> np.ndarray:
            running = np.concatenate([[0], np.bitwise_xor.accumulate(values)])
            return unit[row] ^ running[self.first[row] + rel] ^ running[self.first[row]]

        x, y = digest(self.x, self.ux), digest(self.y, self.uy)
        stop = np.searchsorted(last, end, "left")
        conv = np.minimum.reduceat(
            np.append(self.conv, self.conv[-1]), np.stack([row, stop], axis=1).ravel())[::2]

        first_line = np.arange(opened[0])
        last_line = [int(last[-1])]
        while parent[last_line[-1]] >= 0:
            last_line.append(int(parent[last_line[-1]]))
        lines = np.concatenate([first_line, last_line])
        line = np.repeat(np.array([0, 1]) + 2 * shard, [len(first_line), len(last_line)])
        once = np.ones(len(lines), bool)  # a node of both lines counts on the first
        once[len(first_line):] = ~np.isin(last_line, first_line)
        spine = np.zeros(len(node), bool)
        spine[lines] = True
        beside = (parent >= 0) & ~spine
        beside &= spine[parent]

        def hanging(values: np.ndarray) -> np.ndarray:
            out = np.zeros(len(node), np.int64)
            np.add.at(out, parent[beside], values[beside])
            return out

        ending = np.flatnonzero(~self.goes_on)
        groups = np.flatnonzero(np.diff(last[ending], prepend=-1))
        ends = np.full(len(node), EMPTY, object)
        chunks = []
        for a, b in zip(groups, np.append(groups[1:], len(ending)), strict=False):
            at_node, ids = last[ending[a]], self.conv[ending[a:b]]
            text = ",".join(map(str, ids.tolist()))
            if spine[at_node]:
                chunks += [(at_node, i, text[i * CHUNK:(i + 1) * CHUNK]) for i in range(-(-len(text) // CHUNK))]
            else:
                ends[at_node] = sha256(text.encode()).hexdigest()
        held = np.array([c[0] for c in chunks], np.int64)

        inner = np.flatnonzero(~spine)
        pick = np.concatenate([inner, lines, held])
        counts = [len(inner), len(lines), len(held)]
        up = np.maximum(parent[pick], 0)

        def column(inside: np.ndarray, at_line: np.ndarray) -> pa.Array:
            return pa.array(np.concatenate([inside[inner], at_line, np.zeros(len(held), np.int64)]))

        kept = np.where(once, 1, 0)
        empty = pa.nulls(len(inner), pa.int64())
        fields = {
            "line": pa.concat_arrays([empty, pa.array(line), pa.array(np.full(len(held), 2 * shard))]),
            "chunk": pa.concat_arrays([
                pa.nulls(counts[0] + counts[1], pa.int32()), pa.array([c[1] for c in chunks], pa.int32())]),
            "k": pa.array(self.k[row[pick]]), "rel": pa.array(rel[pick]), "x": pa.array(x[pick]), "y": pa.array(y[pick]),
            "px": pa.array(x[up]), "py": pa.array(y[up]), "parent_line": pa.array(spine[up]),
            "conv_id": pa.array(conv[pick]), "parent_conv": pa.array(conv[up]),
            "n": column(n, n[lines] * kept), "children": column(children, hanging(np.ones(len(node), np.int64))[lines] * kept),
            "leaves": column(leaves, hanging(leaves)[lines] * kept), "saved": column(saved, hanging(saved)[lines] * kept),
            "size": pa.array(size[pick]), **{c: pa.array(v[pick]) for c, v in below.items()},
            "goes_on": pa.array(bottom[pick]),
            "ends": pa.concat_arrays([pa.array(ends[inner], pa.string()), pa.nulls(len(lines), pa.string()),
                                      pa.array([c[2] for c in chunks], pa.string())])}
        return pa.RecordBatch.from_arrays(list(fields.values()), list(fields))


def _encoded(segments: DataFrame) -> DataFrame:
    """The nodes of all shards: inner ones, spines by line, and members that end on spines."""
    key = ["k", "ux", "uy", "path", "conv_id"]
    ordered = segments.repartitionByRange(*key).sortWithinPartitions(*key)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, turns = TaskContext.get().partitionId() << 32, [], 0
        for part in parts:
            if part.num_rows:
                held.append(part)
                turns += len(part.column("path").flatten()) + part.num_rows
            if turns >= SHARD:
                yield _Shard(pa.Table.from_batches(held)).nodes(shard)
                shard, held, turns = shard + 1, [], 0
        if held:
            yield _Shard(pa.Table.from_batches(held)).nodes(shard)

    return materialize(ordered.mapInArrow(batches, NODES), "shards")


NODE = ["k", "rel", "x", "y"]


def _ends(encoded: DataFrame) -> DataFrame:
    """``k, rel, x, y, ends``: the SHA-256 of the members' list of each node on a spine, read as a stream."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for part in parts:
            for *key, text, begins in zip(*(part.column(c).to_pylist() for c in [*NODE, "ends", "begins"]), strict=True):
                if key != node:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = key, sha256()
                elif begins:
                    state.update(b",")
                state.update(text.encode())
            yield pa.RecordBatch.from_pylist([dict(zip([*NODE, "ends"], row, strict=True)) for row in out], schema)
            out = []
        if node:
            yield pa.RecordBatch.from_pylist([dict(zip([*NODE, "ends"], (*node, state.hexdigest()), strict=True))], schema)

    schema = pa.schema([*((c, pa.int64()) for c in NODE), ("ends", pa.string())])
    chunks = encoded.where("chunk is not null").select(*NODE, "line", "chunk", "ends", (F.col("chunk") == 0).alias("begins"))
    ordered = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "line", "chunk")
    return ordered.mapInArrow(batches, "k long, rel long, x long, y long, ends string")


def _merged(encoded: DataFrame) -> DataFrame:
    """The spine nodes of all shards, each once, with the sums of their subtrees."""
    lines = encoded.where("line is not null and chunk is null")
    merged = lines.groupBy(NODE).agg(
        F.min("line").alias("owner"), *(F.max(c).alias(c) for c in ("px", "py", "size", "goes_on", *BELOW)),
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")))
    merged = materialize(merged, "spines")
    inner = merged.where("rel > 0").groupBy(
        "k", (F.col("rel") - 1).alias("rel"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count("*").alias("of_spine"))
    children = F.col("children") + F.coalesce("of_spine", F.lit(0)) + F.col("below_children")
    leaf = F.when((children == 0) & ~F.col("goes_on"), 1).otherwise(0)
    merged = merged.join(inner, NODE, "left").select(
        *NODE, "owner", "px", "py", "conv_id", "n", "goes_on", children.alias("children"),
        (F.col("leaves") + F.col("below_leaves") + leaf).alias("leaves"),
        (F.col("saved") + F.col("below_saved") + (F.col("n") - 1) * F.col("size")).alias("saved"))
    merged = materialize(merged, "spines")
    # Along each line, what its own nodes add from here to the end; then over the lines through a node.
    deeper = Window.partitionBy("line").orderBy(F.desc("rel"))
    own = F.col("line") == F.col("owner")
    along = lines.select("line", *NODE).join(merged.select(*NODE, "owner", "leaves", "saved"), NODE).select(
        *NODE, *(F.sum(F.when(own, F.col(c)).otherwise(0)).over(deeper).alias(c) for c in ("leaves", "saved")))
    sums = along.groupBy(NODE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    parents = merged.select("k", (F.col("rel") + 1).alias("rel"), F.col("x").alias("px"), F.col("y").alias("py"),
                            F.col("conv_id").alias("parent_conv"))
    return materialize(
        merged.drop("leaves", "saved").join(sums, NODE).join(parents, ["k", "rel", "px", "py"], "left")
        .join(_ends(encoded), NODE, "left").withColumn("ends", F.coalesce("ends", F.lit(EMPTY))), "merged")


OUT = [*NODE, "px", "py", "conv_id", "parent_conv", "n", "children", "leaves", "saved", "goes_on", "ends"]


def _nodes(segments: DataFrame) -> DataFrame:
    """All nodes of the segments' units, tops of units included."""
    encoded = _encoded(segments)
    merged = _merged(encoded)
    parents = materialize(merged.select(
        "k", (F.col("rel") + 1).alias("rel"), F.col("x").alias("px"), F.col("y").alias("py"),
        F.col("conv_id").alias("spine_conv")), "parents")
    inner = encoded.where("line is null")
    near = inner.where("parent_line and rel > 0").join(_few(parents), ["k", "rel", "px", "py"])
    return (inner.where("not parent_line or rel = 0").select(OUT)
            .union(near.withColumn("parent_conv", F.col("spine_conv")).select(OUT)).union(merged.select(OUT)))


def _totals(nodes: DataFrame, units: DataFrame) -> DataFrame:
    """``k, x, y, children, leaves, saved``: of everything below each unit's top, deeper units included.

    By pointer doubling: each round adds the sums of the units that far below.
    """
    tops = nodes.where("rel = 0").select("k", "x", "y", "children", "leaves", "saved")
    links = units.where("k > 0").select("k", "x", "y", F.when(F.col("k") > 1, F.col("px")).alias("px"),
                                        F.when(F.col("k") > 1, F.col("py")).alias("py")).distinct()
    at = ["k", "x", "y"]
    state = materialize(tops.join(links, at), "totals")
    reach, levels = 1, units.agg(F.max("k")).first()[0]
    while reach < levels:
        given = state.where("px is not null").groupBy(
            (F.col("k") - reach).alias("k"), F.col("px").alias("x"), F.col("py").alias("y")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = state.select((F.col("k") + reach).alias("k"), F.col("x").alias("px"), F.col("y").alias("py"),
                               F.col("px").alias("ppx"), F.col("py").alias("ppy"))
        state = materialize(state.join(given, at, "left").join(further, ["k", "px", "py"], "left").select(
            *at, "children", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            F.col("ppx").alias("px"), F.col("ppy").alias("py")), "totals")
        reach *= 2
    return state.drop("px", "py")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    One row for each distinct beginning of the rebuilt conversations, the root included.
    """
    segments = materialize(_segments(_pieces(conversations)), "segments")
    zero = F.lit(0).cast("long")
    units = materialize(_units(segments), "units")
    if units.isEmpty():
        nodes = _nodes(segments.select(
            "k", zero.alias("ux"), zero.alias("uy"), "path", "conv_id", F.lit(False).alias("goes_on"),
            *(zero.alias(c) for c in BELOW)))
    else:
        known = units.select("conv_id", "k", F.col("x").alias("ux"), F.col("y").alias("uy"), "nx", "ny")
        placed = materialize(segments.join(_few(known), ["conv_id", "k"], "left").select(
            "k", F.coalesce("ux", zero).alias("ux"), F.coalesce("uy", zero).alias("uy"), "path", "conv_id",
            F.col("nx").isNotNull().alias("goes_on"), "nx", "ny"), "placed")
        plain = placed.withColumns(dict.fromkeys(BELOW, zero)).drop("nx", "ny")
        totals = _totals(_nodes(plain.where("k > 0")), units).select(
            (F.col("k") - 1).alias("k"), F.col("x").alias("nx"), F.col("y").alias("ny"),
            *(F.col(c.removeprefix("below_")).alias(c) for c in BELOW))
        weighed = placed.where("goes_on").join(totals, ["k", "nx", "ny"])
        nodes = materialize(_nodes(plain.where("not goes_on").unionByName(weighed.drop("nx", "ny"))), "nodes")
        # A unit's first nodes are children of a node of the unit above.
        deeper = nodes.where(F.col("goes_on")).select(
            (F.col("k") + 1).alias("k"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("above"))
        first = (F.col("k") > 0) & (F.col("rel") == 1)
        nodes = nodes.where(~first).select(OUT).union(nodes.where(first).join(deeper, ["k", "px", "py"]).withColumn(
            "parent_conv", F.col("above")).select(OUT))
    return nodes.where("k = 0 or rel > 0").select(
        "conv_id", (F.col("k") * SEGMENT + F.col("rel")).alias("depth"),
        F.when((F.col("k") > 0) | (F.col("rel") > 0), F.col("parent_conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
