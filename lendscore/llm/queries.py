"""Registered queries of the subpackage: ``opN_<name>(spark, sf_dir)``.

Each applies its operator, with the parameters a production run would use, to
the whole of its table and derives the columns of its result from the
operator's own output.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import materialize, scratch_path
from . import (bpe, decontamination, embedding_dedup, jaccard_join, langid, neighbours, periodic, prefix_trie, quality,
               secret_scan, sharding, toxicity, wavelet)
from .common import crc_fold, read_table


def _labelled_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents with the fold of operator 1, and those outside it with their labels."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", F.coalesce(crc_fold(F.col("doc_id"), 5) == 0, F.lit(False)))
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return docs, docs.filter(~F.col("held_out")).join(labels, "doc_id")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labelled = _labelled_documents(spark, sf_dir)
    scored = toxicity.predict(docs, toxicity.fit(labelled))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades from the labels: 0 poor, 1 good but toxic, 2 good."""
    docs, labelled = _labelled_documents(spark, sf_dir)
    grade = F.col("quality") * (2 - F.coalesce(F.col("toxic"), F.lit(0)))
    scored = quality.predict(docs, quality.fit(labelled.withColumn("grade", grade)))
    tail = F.col("tail_probs")
    return scored.select("doc_id", "held_out", "expected_grade", tail[0].alias("p_good"),
                         F.element_at(tail, -1).alias("p_best"), (tail[0] >= 0.5).alias("selected"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(crc_fold(F.col("doc_id"), 4) == 2, F.lit(False)))
    labelled = docs.filter(F.col("doc_id").isNotNull() & ~F.col("held_out"))
    model = langid.fit(labelled, public_tokenizers.path("piece_bpe_32k.model"))
    return (langid.predict(docs.select("doc_id", "held_out", "text"), model)
            .select("doc_id", "held_out", "lang_pred", "score"))


#: Byte limit of op4's shards.
SHARD_BYTES = 1 << 20


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards as ``depth:prefix``, with the bytes of the document."""
    placed = sharding.assign(read_table(spark, sf_dir, "documents"), limit_bytes=SHARD_BYTES)
    return placed.select(F.col("key").alias("doc_id"), "n_bytes",
                         F.concat_ws(":", "depth", "prefix").alias("shard"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read_table(spark, sf_dir, "embeddings"), F.pmod("id", F.lit(20)) == 0, k=20)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(read_table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, out_col="ids")
    coded = bpe.decode(coded, ranks, public_tokenizers.PATTERN, "ids", "decoded")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.fit(docs))
    base = F.filter("spans", lambda s: s["rank"] < 3)

    def count(rank: int):
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"),
                        count(2).alias("n_hex"),
                        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
                        secret_scan.span_text(F.col("spans")).alias("spans"))


def op10_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wavelet")
    wavelet.write(read_table(spark, sf_dir, "documents"), path,
                  public_tokenizers.path("word_bpe_49k.json"))
    return wavelet.documents(spark, path)


def shared_beginnings(facts: DataFrame, everyone: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations: conversation c begins with the first h turns of conversation
    c - c % 5, h = crc32(c) % 9 (all, if fewer), and goes on with its own turns after its first h."""
    h = crc_fold(F.col("conv_id"), 9).alias("h")
    content = ["c_lo", "c_hi", "n_bytes"]
    start = facts.filter("pos <= 8").withColumnRenamed("conv_id", "base")
    every = everyone.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), h)
    every = every.join(start.groupBy("base").agg(F.max("pos").alias("first")), "base", "left")
    every = materialize(every.withColumn("taken", F.least("h", F.coalesce("first", F.lit(0)))), "rebuilt")
    begun = every.join(start, "base").filter("pos <= h").select("conv_id", "pos", *content)
    own = facts.join(every.select("conv_id", "h", "taken"), "conv_id").filter("pos > h")
    return begun.unionByName(own.select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), *content))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations")
    facts = materialize(prefix_trie.facts(turns), "turns")
    everyone = facts.select("conv_id").distinct()
    nodes = prefix_trie.nodes(shared_beginnings(facts, everyone), everyone)
    return nodes.withColumnRenamed("saved_bytes", "saved_tokens")


@F.arrow_udf(StringType())
def planted_repeats(crc: pa.Array, text: pa.Array) -> pa.Array:
    """The texts, in a tenth of the documents rewritten: with h the id's CRC-32, g = h // 10 and n words,
    word i from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8)."""
    def rewritten(h: int | None, t: str | None) -> str | None:
        words = t.encode().split() if t and h is not None and h % 10 == 0 else []
        if not words:
            return t
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join(words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]).decode()

    return pa.array(map(rewritten, crc.to_pylist(), text.to_pylist()), pa.string())


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", planted_repeats(crc, F.col("text")).alias("text"))
    found = periodic.detect(docs).select("doc_id", "periodic.*")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    found = found.select("doc_id", "runs", "collapsed", longest.alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language_id": op2_language_id,
    "op3_quality": op3_quality,
    "op4_sharding": op4_sharding,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_decontamination": op6_decontamination,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_secret_scan": op9_secret_scan,
    "op10_wavelet_ids": op10_wavelet_ids,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_embedding_dedup": op13_embedding_dedup,
}

ORACLE: dict[str, str] = {
    # Document ids are unique, so the first 32 bits decide alone.
    "op4_sharding": f"""
WITH d AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
                  CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM documents),
     s AS (SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth, h >> CAST(32 - depth AS BIGINT) AS prefix
           FROM d, range(0, 33) AS r(depth)),
     b AS (SELECT depth, prefix FROM s GROUP BY depth, prefix HAVING sum(n_bytes) <= {SHARD_BYTES} OR count(*) = 1),
     l AS (SELECT doc_id, min(depth) AS depth FROM s JOIN b USING (depth, prefix) GROUP BY doc_id)
SELECT doc_id, n_bytes, l.depth || ':' || (h >> CAST(32 - l.depth AS BIGINT)) AS shard
FROM d JOIN l USING (doc_id)""",
    # An item of n tokens may lose n * 3 / 16 of them (a window of longer ones three of 16): what is left holds
    # three in a row, which give the offsets here.  Letters of unspaced scripts are tokens of their own.
    "op6_decontamination": r"""
WITH spaced AS (SELECT 'b' AS side, item_id AS id, text FROM benchmark UNION ALL SELECT 'd', doc_id, text FROM documents),
     tokens AS (SELECT side, id, regexp_extract_all(regexp_replace(lower(text),
                '([\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}])', ' \1 ', 'g'),
                '[\p{L}\p{N}]+') AS t FROM spaced),
     b AS (SELECT id AS item_id, len(t) AS n, unnest(t) AS tok, generate_subscripts(t, 1) - 1 AS p FROM tokens
           WHERE side = 'b' AND len(t) >= 5),
     d AS (SELECT id AS doc_id, unnest(t) AS tok, generate_subscripts(t, 1) - 1 AS p FROM tokens WHERE side = 'd'),
     bg AS (SELECT item_id, p, tok AS a, lead(tok, 1) OVER w AS b, lead(tok, 2) OVER w AS c
            FROM b WINDOW w AS (PARTITION BY item_id ORDER BY p)),
     dg AS (SELECT doc_id, p, tok AS a, lead(tok, 1) OVER w AS b, lead(tok, 2) OVER w AS c
            FROM d WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
     o AS (SELECT DISTINCT doc_id, item_id, dg.p - bg.p AS off FROM dg JOIN bg USING (a, b, c)),
     m AS (SELECT o.doc_id, o.item_id, o.off, b.p, b.n, CASE WHEN d.tok = b.tok THEN 1 ELSE 0 END AS same
           FROM o JOIN b USING (item_id) LEFT JOIN d ON d.doc_id = o.doc_id AND d.p = b.p + o.off),
     s AS (SELECT doc_id, item_id, off, p, n, sum(same) OVER (PARTITION BY doc_id, item_id, off ORDER BY p
                  ROWS 15 PRECEDING) AS found FROM m)
SELECT doc_id, item_id, CAST(off AS INTEGER) AS "offset", CAST(max(found) AS INTEGER) AS n_matched
FROM s WHERE p >= least(n, 16) - 1 GROUP BY doc_id, item_id, off, n
HAVING max(found) >= least(n, 16) - least(n, 16) * 3 // 16""",
}
