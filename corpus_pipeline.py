"""The corpus pipeline: stages of ``lendscore.llm`` operators over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``.  Every stage works
on all that its predecessor kept, and all but the last return the columns of
``documents``.  Rows with a null ``doc_id`` pass the stages that cannot name them.

A stage with two steps in Python stores what is between them.  In one task they would run in two
workers per core, and Spark uses all of them in turn in the stages after, so that none ends and each keeps its memory.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscore.llm import bpe, decontamination, jaccard_join, langid, secret_scan
from lendscore.llm.common import find_package, read_table, small_batches, temp_name
from lendscore.session import materialize


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language.  Rejected: texts without letters (``und``), and
    texts for which no learned language has half of the probability."""
    find_package(spark)
    small_batches(spark)
    model = langid.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    lang, score = temp_name(docs, "lang"), temp_name(docs, "score")
    scored = langid.predict(docs, model, lang_col=lang, score_col=score)
    return scored.filter((F.col(lang) != langid.UNDETERMINED) & (F.col(score) >= 0.5)).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links join, the one with the smallest id (shingles of
    five words, similarity 0.8), and one of rows that repeat it; texts without words are no
    copies and stay."""
    find_package(spark)
    small_batches(spark)
    groups = jaccard_join.components(docs, shingle=5, percent=80)
    copies = groups.filter("component_id != doc_id").select("doc_id").distinct()
    # Texts stay where they are while the ids of the copies can travel instead.
    kept = docs.join(jaccard_join.small(copies, 16), "doc_id", "left_anti").select(docs.columns)
    if not has_repeated_ids(kept):
        return kept
    named = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    return named.unionByName(kept.filter("doc_id IS NULL"))


def has_repeated_ids(docs: DataFrame) -> bool:
    """Whether an id occurs twice (counted per task before the ids meet)."""
    ids = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count()
    return not ids.filter("count > 1").isEmpty()


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark")).select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and ``n_chars`` counted again where one was."""
    find_package(spark)
    small_batches(spark)
    spans = temp_name(docs, "spans")
    found = secret_scan.scan(docs, secret_scan.fit(docs), out_col=spans)
    hidden = secret_scan.redact(materialize(found, "pipeline-spans"), spans)
    recount = F.when(F.size(spans) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return hidden.withColumn("n_chars", recount.otherwise(F.col("n_chars"))).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept document, checked by decoding them again."""
    find_package(spark)
    small_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = docs.select("doc_id", "lang", "source", "text")
    coded = materialize(bpe.encode(texts, ranks, public_tokenizers.PATTERN, out_col="token_ids"), "pipeline-tokens")
    checked = bpe.checked_round_trip(coded, ranks, public_tokenizers.PATTERN, "text", "token_ids")
    return checked.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES: list[tuple[str, Callable]] = [
    ("language_id", keep_known_languages),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("byte_bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs


#: The first stage's model is not expressible in SQL; tests/llm compare each
#: stage with a brute-force version.
ORACLE_SQL = None
