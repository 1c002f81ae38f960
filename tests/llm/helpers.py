"""Small tables with the awkward cases that every operator must take."""

ODD_DOCS = [
    (1, "the cat sat on the mat and the dog ran", "en", "a", 38),
    (2, None, "en", "a", 0),
    (3, "", None, "a", 0),
    (4, "   \n\t ", "en", None, 6),
    (5, "12345 !!! ???", "en", "b", 13),
    (None, "the cat sat on the mat and the dog ran", None, None, None),
    (7, "the cat sat on the mat and the dog ran", "en", "a", 38),
    (7, "the cat sat on the mat and the dog ran", "en", "a", 38),
    (9, "ein Hund und eine Katze sind im Haus " * 3000, "de", "b", 111000),
    (10, "x" * 30000 + " " * 9000 + "y 中文 é́ \U0001f600", "de", "b", 39010),
]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark):
    """The odd documents with extra columns whose names clash with outputs."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA)
    return df.select("*", *[F.lit("extra").alias(c) for c in (
        "score", "lang_pred", "spans", "token_ids", "decoded", "id", "key", "n", "depth", "prefix", "tokens", "pos",
        "expected_grade", "tail_probs", "rank", "rep")])


def no_docs(spark):
    return odd_docs(spark).limit(0)
