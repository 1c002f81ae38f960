"""Benchmark decontamination with spaced seeds (operator 6, DataFrame functions only).

A training text *overlaps* a benchmark item where, for some offset, at least
``MATCHES`` of ``WINDOW`` consecutive tokens of the item equal the text's tokens at that
offset: up to three may be substituted.  A shorter item is its own window, in which the same
share may be substituted (``n * 3 // 16`` of n tokens).  Items under ``SHORTEST`` tokens
are left out, as ordinary text holds them; ``shortest`` takes them too, as they are.

Tokens are runs of letters and digits; in scripts that write no spaces each letter is one.

Both sides hash the tokens under a few fixed masks, which ignore the positions between
theirs.  The masks are lossless: however the substitutions fall into a window, one of
its masks fits between them somewhere (tests/llm check all cases).  Equal hashes give
candidate offsets, and the candidates' texts are then compared token by token around them.

Scale: texts stream through without a shuffle while the benchmark's hashes are small; their
size is counted, and beyond ``BROADCAST_BYTES`` the hashes are joined by a shuffle.  Candidates are
reduced to distinct offsets per text in each task first, and only texts with
candidates are read again.

Defined results: null and empty texts overlap nothing; texts or items without an id
take no part; rows that repeat an id count as one document; several offsets of one item
are several rows; an empty table on either side gives an empty result; columns other
than id and text do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

WINDOW, MATCHES, SHORTEST = 16, 13, 5
#: Positions that each mask compares.
MASKS = ((0, 1, 3, 4, 5, 6), (0, 2, 3, 7, 9, 10), (0, 3, 6, 8, 9, 10))
#: Masks of items too short for those; items of up to 5 tokens are compared whole.
SHORT_MASKS = {
    6: ((0, 1, 2, 3), (0, 1, 3, 4)),
    7: ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 3, 4, 5)),
    8: ((0, 1, 2, 4, 5), (0, 1, 2, 3, 4)),
    9: ((0, 1, 2, 3, 5, 6), (0, 1, 3, 4, 5, 6)),
    10: ((0, 1, 2, 4, 5, 6),),
    11: ((0, 1, 3, 5, 6), (0, 1, 2, 5, 6)),
    12: ((0, 1, 2, 4, 6, 7), (0, 1, 3, 7, 8, 9), (0, 1, 2, 3, 4, 5)),
}
#: Letters of scripts without spaces between words.
UNSPACED = (r"[\p{L}&&[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\p{IsThai}\p{IsLao}\p{IsKhmer}"
            r"\p{IsMyanmar}\p{IsTibetan}]]")
#: The benchmark's hashes are broadcast up to this size (at 40 bytes each).
BROADCAST_BYTES = 64 << 20


def allowed(n: int) -> int:
    """How many of an item's ``n`` tokens, or of a window, may be substituted."""
    return min(n, WINDOW) * (WINDOW - MATCHES) // WINDOW


def masks_of(n: int) -> tuple[tuple[int, ...], ...]:
    """The masks of items of ``n`` tokens."""
    return SHORT_MASKS.get(n, MASKS) if allowed(n) else (tuple(range(n)),)


def token_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits, and of single unspaced letters."""
    low = F.lower(F.coalesce(text, F.lit("")))
    low = F.when(low.rlike(UNSPACED), F.regexp_replace(low, UNSPACED, " $0 ")).otherwise(low)
    words = F.array_remove(F.split(low, r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def mask_hashes(df: DataFrame, key: str, masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """``key, pos, seed`` for every mask and place of the ``tokens`` of ``df``."""
    span = max(m[-1] for m in masks.values()) + 1
    shifted = [F.when(F.size("tokens") > i, F.slice("tokens", i + 1, F.greatest(F.size("tokens") - i, F.lit(0))))
               .otherwise(F.array().cast("array<bigint>")).alias(f"t{i}") for i in range(span)]
    zipped = df.select(key, *shifted).select(key, F.posexplode(F.arrays_zip(*[F.col(f"t{i}") for i in range(span)])))
    # A window that runs over the end has no last token and gets no hash.
    seeds = [F.when(F.col(f"col.t{m[-1]}").isNotNull(), F.xxhash64(F.lit(k), *[F.col(f"col.t{i}") for i in m]))
             for k, m in masks.items()]
    return zipped.select(key, "pos", F.explode(F.array(*seeds)).alias("seed")).filter("seed IS NOT NULL")


def overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
             text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``doc_id, item_id, offset, n_matched``: the text's token at which the item would
    begin, and the most equal tokens of one window.  Items have at least ``shortest`` tokens."""
    items = materialize(benchmark.filter(F.col(item_id).isNotNull()).select(
        F.col(item_id).alias("item_id"), token_hashes(F.col(text)).alias("tokens"))
        .filter(F.size("tokens") >= max(1, shortest)).distinct(), "benchmark-items")
    width = F.least(F.size("tokens"), F.lit(WINDOW))
    lengths: dict[tuple, list[int]] = {}
    for r in items.select(width.alias("n")).distinct().orderBy("n").collect():
        lengths.setdefault(masks_of(r["n"]), []).append(r["n"])
    lengths = lengths or {MASKS: [WINDOW]}
    masks = dict(enumerate(sorted({m for own in lengths for m in own})))
    parts = [mask_hashes(items.filter(width.isin(ns)), "item_id", {k: m for k, m in masks.items() if m in own})
             for own, ns in lengths.items()]
    in_items = materialize(reduce(DataFrame.unionByName, parts).distinct(), "benchmark-seeds")
    rows = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    seeds = mask_hashes(rows.select("doc_id", token_hashes(F.col("text")).alias("tokens")), "doc_id", masks)
    known = in_items.select("seed", "item_id", F.col("pos").alias("item_pos"))
    if known.count() * 40 <= BROADCAST_BYTES:
        known = F.broadcast(known)
    hits = seeds.join(known, "seed").select("doc_id", "item_id", (F.col("pos") - F.col("item_pos")).alias("offset")).distinct()
    per_doc = materialize(hits.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "offset")).alias("hits")), "seed-hits")
    return verify(rows.join(per_doc, "doc_id"), items)


def verify(candidates: DataFrame, items: DataFrame) -> DataFrame:
    """Compare the texts of ``candidates`` with the items at their ``hits``' offsets."""
    each = (candidates.select("doc_id", token_hashes(F.col("text")).alias("own"), "hits")
            .select("doc_id", "own", F.explode("hits").alias("hit"))
            .select("doc_id", "own", "hit.item_id", "hit.offset").join(items, "item_id"))
    n = F.size("tokens")
    same = each.withColumn("same", F.transform("tokens", lambda t, i: F.when(
        (i + F.col("offset") >= 0) & (F.get("own", i + F.col("offset")) == t), F.lit(1)).otherwise(F.lit(0))))
    width = F.least(n, F.lit(WINDOW))
    sums = F.transform(F.sequence(F.lit(1), n - width + 1), lambda i: F.aggregate(
        F.slice("same", i, width), F.lit(0), lambda a, x: a + x))
    needed = width - F.floor(width * (WINDOW - MATCHES) / WINDOW).cast("int")
    return (same.select("doc_id", "item_id", "offset", F.array_max(sums).alias("n_matched"), needed.alias("needed"))
            .filter(F.col("n_matched") >= F.col("needed")).select("doc_id", "item_id", "offset", "n_matched").distinct())


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
          text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``docs`` without the documents that overlap an item; documents without an id stay."""
    found = overlaps(docs, benchmark, doc_id, item_id, text, shortest).select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(found, doc_id, "left_anti")
