"""Small tables with NULLs, empty and very long texts, ties, repeated rows and clashing column names."""

LONG = "word " * 30_000 + "x" * 20_000
ROWS = [
    (1, "The cat sat on the mat and looked at me", "en", "a", 39),
    (1, "The cat sat on the mat and looked at me", "en", "a", 39),
    (2, "the CAT sat on the mat and looked at me", None, None, None),
    (3, None, "en", "a", 0),
    (4, "", "de", "b", 0),
    (None, "no id here at all", "en", None, 17),
    (5, " \n\t ", "en", "b", 4),
    (6, LONG, "en", "c", len(LONG)),
    (7, "Ünïcödé wörds — and 漢字 <|endoftext|> end", "de", "c", 40),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["id", "fp", "row", "ids", "size", "spans", "shuffle", "k0", "kept", "n_words", "_text", "vkey", "c1", "key", "shared", "component_id"]


def odd_documents(spark):
    from pyspark.sql import functions as F

    plain = spark.createDataFrame(ROWS, SCHEMA)
    return plain.withColumns({c: F.lit("clash") for c in CLASHES})


def no_documents(spark):
    return odd_documents(spark).filter("false")
