"""Messy documents that every operator must take, with columns named like the operators' own."""

from pyspark.sql import functions as F

CLASHES = ("fingerprint component_id component_first spans n_links kept lang_pred score shard slot size source_size target "
           "taken n_lines n_dropped n_words base_failed log_prob n_tokens id row fp h none name bucket key doc rest raw "
           "d1 d2 pos label node vector range e copy bitmap done model cell").split()
HELLO = "Hello world this is a test of words that people write"
ROWS = [
    (1, HELLO, "en", "a"),
    (1, HELLO, "en", "a"),  # repeated row
    (2, None, None, None),
    (3, "", "en", ""),
    (None, "Ein Satz ohne Nummer aber mit schönen Wörtern", "de", None),
    (4, " ".join(f"word{i}" for i in range(30_000)), "en", "b"),  # very long
    (5, "   \t\n  ", None, "b"),
    (6, HELLO, "en", "a"),  # tie
    (7, "1234 5678 !!", "fr", "a"),
    (8, "\n".join(["same line"] * 40 + ["other"]), "en", "b"),
]


def messy(spark, rows=ROWS):
    df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


def read(spark, name, sf="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark, sf="/root/testdata/sf0.001"):
    return {r["doc_id"]: r["text"] for r in read(spark, "documents", sf).select("doc_id", "text").collect()}
