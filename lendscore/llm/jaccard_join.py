"""N-gram Jaccard join with parity sketches (operator 7).

Texts are sets of word shingles; two link when 100 * intersection >= 85 * union.  The
join is exact: every link between different texts is found or already implied.

1. *Sketch.*  A set's shingle hashes are XOR-ed into a sketch of 64-bit words.  Sketches differ in at most
   as many words as their sets do in elements, so sketches of sets
   that link agree in all but a few words, and some word of a fixed few must be
   equal (pigeonhole, see ``parity.join_keys``).  Sizes are cut into overlapping bands.  Words that are
   joined take whole hashes; a parity sketch takes one bit per element, so that its bits bound the difference too.
   Shingles that very many texts share are left out of both sketches alike (which
   keeps the bound), unless they are most of a set.
2. *Join.*  Equal words make groups.  Every set is compared with some pivots of its groups, by
   sizes and sketches, and the nearest are verified.  These links give first components.
3. *Rest.*  Sets of a group whose component is not its first pivot's are compared with all members of
   other components, by sizes, sketches and the number of words that they must share;
   nothing is capped.
4. *Verify* by the exact shingle sets of the whole texts, then components of all links.

Scale: equal sets are one row before the join (``classes``); keys are 16-byte rows that are shuffled
once; texts are read again only for pairs to verify and meet at the pivot, the rarer side; pair
tables are broadcast up to ``BROADCAST_BYTES`` (counted) and joined by shuffle beyond.

Stored tables are removed as soon as nothing reads them any more, and shuffled rows when the query that made them ends.

Defined results: null, empty and blank texts have no shingles and link with nothing; rows that repeat
an id count as one document with the links of all and one component; a row with a null id takes the component of
equal texts, if one has an id, else null; an empty table gives an empty result; columns other than id and
text do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Intermediates, materialize
from . import parity
from .common import list_array, released_shuffles
from .components import component_labels

BROADCAST_BYTES = 32 << 20
#: Shingles of so many texts at least, and of this share of all, are left out of sketches;
#: they are counted in stretches of ``STRETCH`` elements that hold ``LOCAL`` of them.
COMMON_TEXTS, COMMON_SHARE, STRETCH, LOCAL = 16, 0.0005, 1 << 22, 3
#: Members of a group that all others are first compared with; first links per set.
PIVOTS, FIRST_LINKS = 32, 2
#: Rows of a group that one task compares with as many; larger groups are cut into parts.
GROUP_ROWS = 4_096
#: Pairs that a task looks at at once.
PAIRS_AT_ONCE = 1 << 16


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint, if its counted rows fit ``BROADCAST_BYTES``."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def _texts(batch: pa.RecordBatch, column: int) -> Iterator:
    for s in range(0, batch.num_rows, 256):
        yield s, batch.column(column).slice(s, 256).to_pylist()


def common_shingles(docs: DataFrame, shingle: int) -> np.ndarray:
    """Sorted hashes of shingles in ``COMMON_SHARE`` of the texts or more: at most
    (mean set size / COMMON_SHARE) of them, however many texts there are."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(sets: list[np.ndarray]) -> pa.RecordBatch:
            every = np.concatenate(sets)
            sets.clear()
            every.sort()
            value = np.unique(every[LOCAL - 1:][every[LOCAL - 1:] == every[:len(every) - LOCAL + 1]])
            n = np.searchsorted(every, value, side="right") - np.searchsorted(every, value)
            return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n)], names=["h", "n"])

        sets, size = [], 0
        for batch in batches:
            for _, texts in _texts(batch, 1):
                sets += parity.shingle_sets(texts, shingle)
                size += sum(map(len, sets[-len(texts):]))
                if size >= STRETCH:
                    yield flush(sets)
                    sets, size = [], 0
        if sets:
            yield flush(sets)

    least = max(COMMON_TEXTS, int(COMMON_SHARE * docs.count()))
    found = docs.mapInArrow(local, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    return np.sort(np.array([r["h"] for r in found.select("h").collect()], dtype=np.int64).view(np.uint64))


def sketches(docs: DataFrame, common: np.ndarray, shingle: int, percent: int, own: Intermediates) -> DataFrame:
    """Stored ``id, n, print, bound, keys, row`` per text; ``print`` identifies the set and ``row`` the row."""
    held = docs.sparkSession.sparkContext.broadcast(common)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = held.value
        for batch in batches:
            for s, texts in _texts(batch, 1):
                sets = parity.shingle_sets(texts, shingle)
                keys = []
                for h in sets:
                    if not len(h):
                        keys.append(np.empty(0, np.int64))
                        continue
                    at = np.searchsorted(common, h)
                    at[at == len(common)] = 0
                    rare = h[common[at] != h] if len(common) else h
                    keys.append(np.unique(parity.join_keys(h, rare, percent)).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s, 256), pa.array([len(h) for h in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None for h in sets], pa.binary()),
                     list_array([parity.sketch(h, parity.bound_words(len(h), percent)).view(np.int64) for h in sets], np.int64, pa.int64()),
                     list_array(keys, np.int64, pa.int64())], names=["id", "n", "print", "bound", "keys"])

    made = docs.mapInArrow(make, "id long, n long, print binary, bound array<long>, keys array<long>")
    return own.store(made.withColumn("row", F.monotonically_increasing_id()), "jaccard-sketches")


def one_per_class(table: DataFrame, rows: DataFrame, classes: DataFrame, own: Intermediates) -> DataFrame:
    """The rows of ``table`` that stand for a class, with their id as ``rep``.  Sketches stay where they are while
    the narrow rows of the classes, or else those of the copies, can travel instead."""
    chosen = classes.filter("rep IS NOT NULL").select("row")
    named = table.filter("n > 0 AND id IS NOT NULL").withColumnRenamed("id", "rep")
    if chosen.count() * 16 <= BROADCAST_BYTES:
        return named.join(F.broadcast(chosen), "row", "left_semi")
    copies = rows.filter("n > 0 AND id IS NOT NULL").select("row").join(chosen, "row", "left_anti")
    return named.join(small(own.store(copies, "jaccard-copies"), 16), "row", "left_anti")


def verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int, own: Intermediates) -> DataFrame:
    """The ``pairs (a, b)`` that link, by the shingles of their whole texts.  The texts
    of the ``a`` side travel to those of ``b``, which should be the fewer."""
    pairs = own.store(pairs, "jaccard-pairs")
    # An id that repeats has all its texts compared.
    left = docs.join(small(pairs, 16), docs["id"] == pairs["a"]).select("a", "b", F.col("text").alias("text_a"))
    ends = own.store(pairs.select("b").distinct(), "jaccard-ends")
    right = docs.join(small(ends, 8), docs["id"] == ends["b"]).select("b", F.col("text").alias("text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right_set = None, None
        for batch in batches:
            for s, texts in _texts(batch, 2):
                part = batch.slice(s, 256)
                keep = []
                for x, y in zip(parity.shingle_sets(texts, shingle), part.column(3).to_pylist()):
                    if y != last:
                        last, right_set = y, parity.shingle_set(y, shingle)
                    keep.append(parity.linked(x, right_set, percent))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = left.join(right, "b").select("a", "b", "text_a", "text_b")
    return own.store(joined.mapInArrow(check, "a long, b long").distinct(), "jaccard-links")


def known_sets(reps: DataFrame, labels: DataFrame | None, own: Intermediates) -> DataFrame:
    """Stored ``row, rep, n, bound, c``: document, size, sketch and component of each distinct set."""
    if labels is None:
        return own.store(reps.withColumn("c", F.col("rep")), "jaccard-facts")
    labels = labels.select(F.col("id").alias("rep"), "component")
    return own.store(reps.join(labels, "rep", "left").select(
        "row", "rep", "n", "bound", F.coalesce("component", "rep").alias("c")), "jaccard-facts")


def compared(placed: DataFrame, facts: DataFrame, percent: int, first: bool) -> DataFrame:
    """Near pairs ``a, b, least, shared, apart`` of the members of one ``key, i, j``: those with role
    1 or 3 against those with role 2 or 3, in different components."""
    pivots = small(facts.select(F.col("row").alias("pivot"), F.col("c").alias("pivot_c")), 16)
    if (facts.agg(F.sum(F.size("bound") * 8 + 32)).first()[0] or 0) <= BROADCAST_BYTES:
        # Narrow rows travel; what is known of each set joins them where they arrive.
        rows = placed.repartition("key", "i", "j").join(F.broadcast(facts), "row").join(pivots, "pivot")
    else:
        rows = placed.join(pivots, "pivot").join(facts, "row").repartition("key", "i", "j")
    minor = F.lit(True) if first else F.col("c") != F.col("pivot_c")
    rows = rows.select("key", "i", "j", "rep", "role", "n", "c", minor.alias("minor"), "bound")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            if held is not None:
                now = pa.concat_tables([held, now]).combine_chunks()
            key, i, j = (now[name].to_numpy() for name in ("key", "i", "j"))
            done = int(np.argmax((key == key[-1]) & (i == i[-1]) & (j == j[-1])))
            yield from _pairs(now.slice(0, done), percent, first)
            held = now.slice(done)
        if held is not None:
            yield from _pairs(held, percent, first)

    return rows.sortWithinPartitions("key", "i", "j").mapInArrow(
        compare, "a long, b long, least long, shared long, apart double")


def first_pairs(groups: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """``a, b``: each set with the ``FIRST_LINKS`` nearest of the pivots of its groups, if near.  The
    pivots go to every part of a large group, so the work grows with the members."""
    parts = F.ceil(F.col("members") / GROUP_ROWS).cast("int")
    own = F.pmod(F.xxhash64("row"), parts).cast("int")
    alone = F.array(F.struct(own.alias("j"), F.lit(1).alias("role")))
    everywhere = F.transform(F.sequence(F.lit(0), parts - 1),
                             lambda j: F.struct(j.alias("j"), F.when(j == own, 3).otherwise(2).alias("role")))
    placed = groups.select("key", "row", "pivot", F.lit(0).alias("i"),
                           F.inline(F.when(F.col("place") <= PIVOTS, everywhere).otherwise(alone)))
    near = compared(placed, facts, percent, True).groupBy("a", "b").agg(F.min("apart").alias("apart"))
    best = Window.partitionBy("a").orderBy("apart", "b")
    near = near.withColumn("best", F.row_number().over(best)).filter(F.col("best") <= FIRST_LINKS)
    return near.select("a", "b").distinct()


def remaining_pairs(groups: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """``a, b``: all pairs of one group in different components that may link.

    One of the two is *minor*: not in its pivot's component.  Only minor members are compared with all
    others.  A group of more than ``GROUP_ROWS`` members is cut into parts, and every part's minor members
    meet every part, so that a task never holds more than two parts."""
    parts = F.ceil(F.col("members") / GROUP_ROWS).cast("int")
    own = F.pmod(F.xxhash64("row"), parts).cast("int")
    others = F.sequence(F.lit(0), parts - 1)
    as_a = F.transform(others, lambda j: F.struct(own.alias("i"), j.alias("j"), F.lit(1).alias("role")))
    as_b = F.transform(others, lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(2).alias("role")))
    whole = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(3).alias("role")))
    placed = groups.select("key", "row", "pivot", F.inline(F.when(parts == 1, whole).otherwise(F.concat(as_a, as_b))))
    counted = compared(placed, facts, percent, False).groupBy("a", "b", "least").agg(F.sum("shared").alias("shared"))
    return counted.filter(F.col("shared") >= 1 + F.floor(F.col("least") * parity.MORE_KEYS)).select("a", "b")


def _pairs(table: pa.Table, percent: int, first: bool) -> Iterator[pa.RecordBatch]:
    """Near pairs of the sorted groups in ``table``, with the keys they share here; of
    first pairs, the ``FIRST_LINKS`` nearest per member."""
    if not table.num_rows:
        return
    rows = {name: table[name].to_numpy() for name in table.column_names if name != "bound"}
    lists = table["bound"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy().astype(np.int64)
    bounds = (offsets[:-1], np.diff(offsets), lists.values.to_numpy().view(np.uint64))
    short = parity.short_sketches(*bounds)
    new = np.r_[True, (rows["key"][1:] != rows["key"][:-1]) | (rows["i"][1:] != rows["i"][:-1])
                | (rows["j"][1:] != rows["j"][:-1])]
    group = np.cumsum(new) - 1
    left = np.flatnonzero((rows["role"] & 1 > 0) & rows["minor"])
    right = np.flatnonzero(rows["role"] & 2 > 0)
    begin = np.searchsorted(group[right], group[left])
    size = np.searchsorted(group[right], group[left], side="right") - begin
    ends = np.cumsum(size)
    rep, c = rows["rep"], rows["c"]
    start = 0
    while start < len(left):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] - size[start] + PAIRS_AT_ONCE)))
        own = size[start:stop]
        a = np.repeat(left[start:stop], own)
        b = right[np.repeat(begin[start:stop] - (np.cumsum(own) - own), own) + np.arange(own.sum())]
        start = stop
        keep = c[a] != c[b]
        if not first:
            keep &= ~rows["minor"][b] | (rep[a] < rep[b])  # each pair once per key
        a, b = a[keep], b[keep]
        at, apart = parity.near_pairs(a, b, rows["n"], short, *bounds, percent)
        if not len(at):
            continue
        a, b = a[at], b[at]
        if first:
            order = np.lexsort((rep[b], apart, a))
            a, b, apart = a[order], b[order], apart[order]
            best = np.arange(len(a)) - np.searchsorted(a, a) < FIRST_LINKS
            yield _batch(rep[a[best]], rep[b[best]], rows["n"][a[best]], np.ones(best.sum(), np.int64), apart[best])
        else:
            found = np.stack([np.maximum(rep[a], rep[b]), np.minimum(rep[a], rep[b]),
                              np.minimum(rows["n"][a], rows["n"][b])], axis=1)
            found, shared = np.unique(found, axis=0, return_counts=True)
            yield _batch(*found.T, shared, np.zeros(len(shared)))


def _batch(a, b, least, shared, apart) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(x), pa.int64()) for x in (a, b, least, shared)),
                                       pa.array(apart, pa.float64())], names=["a", "b", "least", "shared", "apart"])


def components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = parity.SHINGLE,
               percent: int = parity.PERCENT) -> DataFrame:
    """``id_col, n_shingles, component_id`` per row: the size of the shingle set and the smallest
    id that links reach."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with Intermediates(df.sparkSession) as own, released_shuffles(df.sparkSession):
        table = sketches(docs, common_shingles(docs, shingle), shingle, percent, own)
        rows = own.store(table.select("id", "n", "print", "row"), "jaccard-rows")
        # One row per distinct set: one of its smallest id.
        first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row"))
        classes = table.filter("n > 0").groupBy("print").agg(first.alias("first"))
        classes = own.store(classes.select("print", F.col("first.id").alias("rep"), F.col("first.row").alias("row")), "jaccard-classes")
        sets = one_per_class(table, rows, classes, own)
        reps = own.store(sets.select("row", "rep", "n", "bound"), "jaccard-sets")

        by_key = Window.partitionBy("key").orderBy(F.xxhash64("row"), "row")
        whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        groups = own.store(
            sets.select("row", F.explode("keys").alias("key")).select(
                "key", "row", F.first("row").over(whole).alias("pivot"), F.count("*").over(whole).alias("members"),
                F.row_number().over(by_key).alias("place")).filter("members > 1"), "jaccard-groups")
        own.drop(table)

        facts = known_sets(reps, None, own)
        links = verified(first_pairs(groups, facts, percent), docs, shingle, percent, own)
        own.drop(facts)
        facts = known_sets(reps, component_labels(links), own)
        links = links.unionByName(verified(remaining_pairs(groups, facts, percent), docs, shingle, percent, own))
        own.drop(groups)

        # The sets of one id are one document.
        several = rows.filter("id IS NOT NULL").groupBy("id").agg(
            F.min("print").alias("a"), F.max("print").alias("b"), F.max(F.col("n") == 0).alias("empty"))
        several = own.store(several.filter("a != b OR empty AND a IS NOT NULL").select("id"), "jaccard-several")
        repeated = not several.isEmpty()
        if repeated:
            shared = rows.join(several, "id").join(classes, "print").select(F.col("id").alias("a"), F.col("rep").alias("b"))
            links = links.unionByName(shared.distinct())
        final = component_labels(links)
        found = (rows.join(classes.select("print", "rep"), "print", "left").join(final.withColumnRenamed("id", "rep"), "rep", "left")
                 .select("id", "n", F.coalesce("component", "rep", "id").alias("component")))
        if repeated:
            found = own.store(found, "jaccard-found")
            least = found.join(several, "id").groupBy("id").agg(F.min("component").alias("least"))
            found = found.join(least, "id", "left").select("id", "n", F.coalesce("least", "component").alias("component"))
        return materialize(found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                                        F.col("component").alias("component_id")), "jaccard-result")
