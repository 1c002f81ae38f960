"""Prefix trie of conversations by z-fast tries (operator 11).

Every distinct sequence of a conversation's first d turns is a node.  The trie is built compacted
(only nodes where conversations branch or end, with the edges between them) and expanded at the end.

1. *Prefixes.*  A turn becomes two 64-bit hashes of its content and its byte length; texts travel no farther.
   The 128-bit hash of a prefix is the exclusive or of its turns' hashes, each mixed with its depth, so it
   comes from a running aggregate.  Equal conversations are one class with a count.
2. *Batches.*  Classes are inserted in batches, grouped by where they leave the trie built so far: by the hash
   of the first turn that is not in it (first: by their first turn).  Of a group with more than ``PART_TURNS``
   turns one class alone is inserted, and the others regroup where they leave its path; every batch does so for all
   such groups at once.  The class is chosen by hash, so an expected logarithmic number of batches is enough.
3. *Z-fast tries.*  A smaller group is one z-fast trie, built in a task: compacted nodes are hashed by the prefix at
   their handle, the depth in their edge that the highest power of two divides.  A fat binary search over
   the handles locates a class's exit node in a logarithmic number of probes; a search on its edge finds
   where to split it (:class:`ZFastTrie`).
4. *Expansion.*  The extents found are marked on every class's path; counts, leaves and savings are summed
   per extent over the classes below it, and edges are expanded along the path of each extent's smallest
   conversation.

Scale: turns are hashed, ranked and marked in stretches of ``STRETCH`` turns, so neither a very long conversation
nor a hot first turn lands in one task; a task holds a group of at most ``PART_TURNS`` turns; every
table between the steps is stored.  The digest of the conversations that end in a node is, by its
definition, one pass over their sorted ids: chunks of ids are joined before they meet.

Defined results: turns are ordered by position (null first), then role and text; null role or text is empty; rows with a null
conversation id belong to no conversation; an empty table gives an empty result (no root); other columns
do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import exact_rank
from ..session import Intermediates, materialize

#: Groups of at most so many turns are one task's trie.
PART_TURNS = 200_000
#: Turns of one conversation that one window orders.
STRETCH = 4_096
#: Ids of a chunk of the digest's text.
CHUNK = 4_096
#: Rows of a table that is broadcast (counted first).
BROADCAST_ROWS = 100_000
#: Digest of no conversation.
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- prefixes ----------------------------------------------------------------------
def facts(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``conv_id, pos, c_lo, c_hi, n_bytes`` per turn: position from 1 and what the trie needs of its content."""
    rows = df.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ranked = exact_rank(rows, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], ["conv_id"], rn="pos")
    return ranked.select("conv_id", F.col("pos").cast("long").alias("pos"), F.xxhash64(F.lit(1), "role", "text").alias("c_lo"),
                         F.xxhash64(F.lit(2), "role", "text").alias("c_hi"),
                         F.octet_length("text").cast("long").alias("n_bytes"))


def small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint, if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def running(df: DataFrame, values: dict[str, tuple[str, str]], last: bool = False) -> DataFrame:
    """``df`` (``conv_id, d, ...``) with running aggregates ``name: (function, column)`` along each conversation's
    turns, from its first turn on (``last``: from its last turn back).

    A window covers one stretch of a conversation; what the stretches before give is added
    from a table that has a row per stretch of the conversations with several."""
    names = list(values)
    df = df.withColumn("_s", F.floor((F.col("d") - 1) / STRETCH))
    way = F.col("d").desc() if last else F.col("d")
    stretch = F.col("_s").desc() if last else F.col("_s")
    aggregate = {"sum": F.sum, "xor": F.bit_xor, "last": lambda c: F.last(c, ignorenulls=True)}
    join = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + b, "xor": lambda a, b: F.coalesce(a, F.lit(0)).bitwiseXOR(b),
            "last": lambda a, b: F.coalesce(b, a)}
    here = Window.partitionBy("conv_id", "_s").orderBy(way).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.select("*", *[aggregate[f](F.col(c)).over(here).alias(n) for n, (f, c) in values.items()])
    longest = df.agg(F.max("_s")).first()[0] or 0
    if longest == 0:
        return out.drop("_s")
    ends = out.withColumn("_at", F.row_number().over(Window.partitionBy("conv_id", "_s").orderBy(
        F.col("d") if last else F.col("d").desc()))).filter("_at = 1").select("conv_id", "_s", *names)
    before = Window.partitionBy("conv_id").orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("conv_id", "_s", *[aggregate[f](F.col(n)).over(before).alias(f"_{n}") for n, (f, _) in values.items()])
    out = out.join(carried, ["conv_id", "_s"])
    return out.select(*df.columns[:-1], *[join[f](F.col(f"_{n}"), F.col(n)).alias(n) for n, (f, _) in values.items()])


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, d, lo, hi, n_bytes, bytes_to`` per turn: hash of the first d turns, bytes of the
    turn's text and of all texts to it."""
    salted = turns.select("conv_id", F.col("pos").alias("d"), F.xxhash64("c_lo", "c_hi", "pos").alias("s_lo"),
                          F.xxhash64("pos", "c_hi", "c_lo").alias("s_hi"), "n_bytes")
    return running(salted, {"lo": ("xor", "s_lo"), "hi": ("xor", "s_hi"), "bytes_to": ("sum", "n_bytes")}).drop("s_lo", "s_hi")


# --- the trie of one group -----------------------------------------------------------
def fattest(a: int, b: int) -> int:
    """The number in (a, b] that the highest power of two divides."""
    return b & -1 << ((a ^ b).bit_length() - 1)


class ZFastTrie:
    """Compacted trie of sequences given by the hashes of their prefixes.

    ``path[d]`` is the hash of the first d elements, from ``depth`` (that of the root) on.  A node has the
    edge of depths (top, extent] on the path of one of its sequences; ``handles`` finds it by the hash at its handle,
    ``children`` by the hash at the first depth of its edge."""

    def __init__(self, depth: int):
        self.depth = depth
        self.top, self.extent, self.path = [depth], [depth], [None]
        self.handles: dict = {}
        self.children: dict = {}

    def _place(self, node: int) -> None:
        path, top = self.path[node], self.top[node]
        self.children[path[top + 1]] = node
        self.handles[path[fattest(top, self.extent[node])]] = node

    def _add(self, path, top: int, extent: int) -> int:
        self.top.append(top)
        self.extent.append(extent)
        self.path.append(path)
        self._place(len(self.top) - 1)
        return len(self.top) - 1

    def locate(self, path, length: int) -> tuple[int, int]:
        """``(node, depth)``: the exit node of a sequence and the depth to which the trie holds it."""
        low, high, node = self.depth, length, 0
        while low < high:
            f = fattest(low, high)
            hit = self.handles.get(path[f])
            if hit is None:
                high = f - 1
                continue
            end = self.extent[hit]
            if end > length or self.path[hit][end] != path[end]:
                return hit, self._leaves(hit, path, f, min(end - 1, length))
            low, node = end, hit
        child = self.children.get(path[low + 1]) if low < length else None
        if child is None:
            return node, low
        return child, self._leaves(child, path, low + 1, min(self.extent[child], length))

    def _leaves(self, node: int, path, low: int, high: int) -> int:
        """The last depth in ``[low, high]`` at which the sequence is still on the node's path (at ``low`` it is)."""
        own = self.path[node]
        while low < high:
            middle = (low + high + 1) // 2
            if own[middle] == path[middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def insert(self, path, length: int) -> None:
        node, depth = self.locate(path, length)
        if depth < self.extent[node]:  # leaves inside the edge: split it
            del self.handles[self.path[node][fattest(self.top[node], self.extent[node])]]
            upper = self._add(self.path[node], self.top[node], depth)
            self.top[node] = depth
            self._place(node)
            node = upper
        if depth < length:
            self._add(path, depth, length)

    def extents(self) -> list:
        """Hashes of the extents of all nodes below the root."""
        return [p[e] for p, e in list(zip(self.path, self.extent))[1:]]


class Shifted:
    """Hashes of the depths from ``first`` on, by depth."""

    __slots__ = ("first", "hashes")

    def __init__(self, first: int, hashes: list):
        self.first, self.hashes = first, hashes

    def __getitem__(self, depth: int):
        return self.hashes[depth - self.first]


def group_extents(table: pa.Table) -> list[tuple[int, int]]:
    """Extents of the trie of one group: rows ``conv_id, d, lo, hi``, by conversation and depth."""
    conv, d = table["conv_id"].to_numpy(), table["d"].to_numpy()
    hashes = list(zip(table["lo"].to_pylist(), table["hi"].to_pylist()))
    first = int(d[0])
    trie = ZFastTrie(first - 1)
    starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]]).tolist() + [len(conv)]
    for s, e in zip(starts, starts[1:]):
        trie.insert(Shifted(first, hashes[s:e]), first + e - s - 1)
    return trie.extents()


def part_extents(rows: DataFrame) -> DataFrame:
    """``lo, hi``: the extents of one trie per group ``g_lo, g_hi``."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(table: pa.Table) -> pa.RecordBatch:
            lo, hi = table["g_lo"].to_numpy(), table["g_hi"].to_numpy()
            starts = np.flatnonzero(np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]).tolist() + [len(lo)]
            found = [x for s, e in zip(starts, starts[1:]) for x in group_extents(table.slice(s, e - s))]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["lo", "hi"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            lo, hi = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = int(np.argmax((lo == lo[-1]) & (hi == hi[-1])))  # where the last group begins
            whole = new > 0 or held and (held[-1].column(0)[0].as_py(), held[-1].column(1)[0].as_py()) != (lo[0], hi[0])
            if whole and (held or new):
                yield flush(pa.Table.from_batches([*held, batch.slice(0, new)]).combine_chunks())
                held = []
            held.append(batch.slice(new))
        if held:
            yield flush(pa.Table.from_batches(held).combine_chunks())

    by = ["g_lo", "g_hi"]
    return (rows.select(*by, "conv_id", "d", "lo", "hi").repartition(*by).sortWithinPartitions(*by, "conv_id", "d")
            .mapInArrow(build, "lo long, hi long"))


# --- batches -------------------------------------------------------------------------
def extents(paths: DataFrame, classes: DataFrame, own: Intermediates) -> DataFrame:
    """Stored distinct ``lo, hi``: the extents of the compacted trie of ``classes (conv_id, length)``."""
    found = paths.join(classes, (paths["conv_id"] == classes["conv_id"]) & (paths["d"] == classes["length"])).select("lo", "hi")
    first = paths.filter("d = 1").select("conv_id", F.col("lo").alias("g_lo"), F.col("hi").alias("g_hi"))
    # Classes outside the trie so far, the hash they leave it with, and its depth.
    left = own.store(classes.select("conv_id", "length").join(first, "conv_id").withColumn("depth", F.lit(1).cast("long")), "trie-left")
    by = ["g_lo", "g_hi"]
    while True:
        size = F.sum(F.col("length") - F.col("depth") + 1)
        groups = left.groupBy(*by).agg(size.alias("turns"), F.min_by("conv_id", F.xxhash64("conv_id")).alias("chosen"))
        hot = own.store(groups.filter(F.col("turns") > PART_TURNS).select(*by, "chosen"), "trie-hot")
        if hot.isEmpty():
            break
        hot = small(hot)
        parts = left.join(hot, by, "left_anti")
        found = found.unionByName(part_extents(paths.join(parts, "conv_id").filter("d >= depth")))
        # The chosen class of a group is inserted; the others leave the trie on its path.
        members = own.store(left.join(hot, by), "trie-members")
        path = members.filter("conv_id = chosen").select("conv_id", "depth").join(paths, "conv_id").filter("d >= depth").select("lo", "hi")
        others = members.filter("conv_id != chosen").select("conv_id", "length", "depth")
        rest = own.store(paths.join(others, "conv_id").filter("d >= depth").select("conv_id", "length", "d", "lo", "hi"), "trie-rest")
        on_path = rest.join(small(own.store(path, "trie-path")), ["lo", "hi"])
        leave = own.store(on_path.groupBy("conv_id").agg(F.max("d").alias("at")), "trie-leave")
        here = rest.join(leave, "conv_id")
        found = own.store(found.unionByName(here.filter("d = at").select("lo", "hi")).distinct(), "trie-extents")
        left = own.store(here.filter("d = at + 1").select(
            "conv_id", "length", F.col("lo").alias("g_lo"), F.col("hi").alias("g_hi"), F.col("d").alias("depth")), "trie-left")
    found = found.unionByName(part_extents(paths.join(left, "conv_id").filter("d >= depth")))
    return own.store(found.distinct(), "trie-extents")


# --- results ---------------------------------------------------------------------------
def ends_digest(ends: DataFrame) -> DataFrame:
    """``class_id, ends_sha256``: digest of the sorted ids, joined by commas, of ``ends (class_id, conv_id)``.

    Chunks of ids in range order are joined first, so that the tasks that chain the
    chunks of a class read a row per ``CHUNK`` ids."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, conv = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            new = set(np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]).tolist()) if len(owner) else set()
            cuts = sorted(new | set(range(0, len(owner), CHUNK))) + [len(owner)]
            rows = [(int(owner[s]), conv[s], ",".join(map(str, conv[s:e]))) for s, e in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (pa.int64(), pa.int64(), pa.string()))], names=["class_id", "first", "ids"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for owner, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if owner != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = owner, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _digests(done)
        if digest is not None:
            yield _digests([(now, digest.hexdigest())])

    chunks = (ends.select("class_id", "conv_id").repartitionByRange("class_id", "conv_id")
              .sortWithinPartitions("class_id", "conv_id").mapInArrow(joined, "class_id long, first long, ids string"))
    return (chunks.repartition("class_id").sortWithinPartitions("class_id", "first")
            .mapInArrow(chained, "class_id long, ends_sha256 string"))


def _digests(rows: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
                                      names=["class_id", "ends_sha256"])


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")


def nodes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of ``turns`` (as from :func:`facts`) of ``conversations (conv_id)``, which also lists those without turns.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_bytes`` (over the subtree, bytes of each node's last text that storing it once saves) and
    ``ends_sha256`` (digest of the members that end here)."""
    with Intermediates(turns.sparkSession) as own:
        everyone = own.store(conversations.select(F.col("conv_id").cast("long")).filter("conv_id IS NOT NULL").distinct(), "trie-conversations")
        paths = own.store(prefixes(turns), "trie-prefixes")
        last = paths.groupBy("conv_id").agg(F.max("d").alias("length"), F.max_by(F.struct("lo", "hi"), "d").alias("whole"))
        last = own.store(last.join(everyone, "conv_id", "left_semi"), "trie-ends")
        classes = own.store(last.groupBy("whole", "length").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")), "trie-classes")
        # One path per class from here on.
        paths = own.store(paths.join(classes.select("conv_id"), "conv_id", "left_semi"), "trie-paths")
        marks = extents(paths, classes, own)

        # Extents on every class's path, with the one above.
        marked = paths.join(marks.withColumn("is_extent", F.lit(True)), ["lo", "hi"], "left")
        at = F.when(F.col("is_extent"), F.struct("d", "lo", "hi", "bytes_to"))
        marked = running(marked.select("conv_id", "d", "lo", "hi", "n_bytes", "bytes_to", at.alias("at")), {"next": ("last", "at")}, last=True)
        marked = own.store(marked, "trie-marked")
        above = marked.filter(F.col("d") == 1).select("conv_id", F.lit(0).cast("long").alias("d"), F.lit(None).cast(
            "struct<d:bigint,lo:bigint,hi:bigint,bytes_to:bigint>").alias("up"), F.col("next"))
        step = marked.filter("at IS NOT NULL").select("conv_id", "d", F.col("at").alias("up"))
        following = marked.select("conv_id", (F.col("d") - 1).alias("d"), "next")
        steps = above.select("conv_id", "up", "next").unionByName(
            step.join(following, ["conv_id", "d"]).select("conv_id", "up", "next"))
        on = own.store(steps.select("conv_id", F.col("next.lo").alias("lo"), F.col("next.hi").alias("hi"), F.col("next.d").alias("d"),
                                    F.col("next.bytes_to").alias("bytes_to"), "up")
                       .join(classes.select("conv_id", "n", "length"), "conv_id"), "trie-steps")
        node = own.store(on.groupBy("lo", "hi").agg(F.sum("n").alias("n_convs"), F.count("*").alias("n_classes"), F.min("conv_id").alias("rep"),
                                                    F.max(F.when(F.col("d") == F.col("length"), F.col("conv_id"))).alias("ends")), "trie-nodes")
        leaf = on.filter("d = length").join(node.filter("n_classes = 1").select("lo", "hi"), ["lo", "hi"], "left_semi")
        leaf = leaf.select("conv_id", F.lit(1).alias("leaf"))
        # What an edge saves is counted once, with the class of its smallest conversation, for all extents above.
        edge = F.when(F.col("rep") == F.col("conv_id"), (F.col("n_convs") - 1) * (F.col("bytes_to") - F.coalesce("up.bytes_to", F.lit(0)))).otherwise(0)
        counted = on.join(node.select("lo", "hi", "n_convs", "rep"), ["lo", "hi"]).join(leaf, "conv_id", "left")
        counted = running(counted.select("conv_id", "d", "lo", "hi", F.coalesce("leaf", F.lit(0)).alias("leaf"), edge.alias("edge")),
                          {"saved": ("sum", "edge")}, last=True)
        counted = own.store(counted, "trie-counted")
        below = counted.groupBy("lo", "hi").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved"))
        own_edge = on.join(node, ["lo", "hi"]).filter("conv_id = rep").join(below, ["lo", "hi"])
        parent = node.select(F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), F.col("rep").alias("up_rep"))
        facts_of = own.store(own_edge.withColumn("up_lo", F.col("up.lo")).withColumn("up_hi", F.col("up.hi")).join(
            parent, ["up_lo", "up_hi"], "left"), "trie-edges")
        children = facts_of.filter("up_lo IS NOT NULL").groupBy(F.col("up_lo").alias("lo"), F.col("up_hi").alias("hi")).agg(
            F.count("*").alias("children"))
        digests = ends_digest(last.join(classes.select("whole", "length", F.col("conv_id").alias("class_id")), ["whole", "length"]))
        extent = facts_of.join(children, ["lo", "hi"], "left").join(
            digests.withColumnRenamed("class_id", "ends"), "ends", "left")

        # Expansion along the smallest conversation's path.
        edges = extent.select("conv_id", F.col("d").alias("extent"), "n_convs", "n_leaves", "saved", "children", "ends_sha256", "up_rep",
                              F.coalesce("up.d", F.lit(0)).alias("top"), F.coalesce("up.bytes_to", F.lit(0)).alias("bytes_above"))
        turns_of = marked.select("conv_id", "d", (F.col("bytes_to") - F.col("n_bytes")).alias("bytes_before"), F.col("next.d").alias("extent"))
        full = turns_of.join(edges, ["conv_id", "extent"])
        total = everyone.agg(F.min("conv_id").alias("root"), F.count("*").alias("n")).first()
        if total["n"] == 0:
            return _root(turns.sparkSession, [])
        ends = F.col("d") == F.col("extent")
        first = F.col("d") == F.col("top") + 1
        below_root = full.select(
            "conv_id", F.col("d").alias("depth"), F.when(~first, F.col("conv_id")).otherwise(
                F.coalesce("up_rep", F.lit(total["root"]))).alias("parent_conv_id"), "n_convs",
            F.when(ends, F.coalesce("children", F.lit(0))).otherwise(1).cast("long").alias("n_children"), "n_leaves",
            (F.col("saved") - (F.col("n_convs") - 1) * (F.col("bytes_before") - F.col("bytes_above"))).alias("saved_bytes"),
            F.when(ends, F.coalesce("ends_sha256", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"))
        below_root = own.store(below_root, "trie-below-root")
        top = below_root.filter("depth = 1").agg(_total("n_leaves").alias("n_leaves"), _total("saved_bytes").alias("saved"),
                                                 F.count("*").alias("n_children")).first()
        silent = everyone.join(last, "conv_id", "left_anti").select(F.lit(0).cast("long").alias("class_id"), "conv_id")
        silent = [r["ends_sha256"] for r in ends_digest(silent).collect()]
        root = _root(turns.sparkSession, [(total["root"], 0, None, total["n"], top["n_children"], max(1, top["n_leaves"]), top["saved"],
                                           silent[0] if silent else NO_ENDS)])
        return materialize(below_root.unionByName(root), "trie-result")


def _root(spark, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                       "n_leaves long, saved_bytes long, ends_sha256 string")
