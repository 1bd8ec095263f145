import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Null and empty texts, a very long one, ties, repeated rows, null ids.
PROSE = "The quick brown fox jumps over the lazy dog while ten old ships leave port at dawn"
ODD_ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", "a", 4),
    (4, PROSE, "en", "a", len(PROSE)),
    (4, PROSE, "en", "a", len(PROSE)),
    (5, PROSE, "en", None, len(PROSE)),
    (None, PROSE + " again", "fr", "b", len(PROSE) + 6),
    (7, "wörd ünd <|endoftext|> 𝔘nicode\x1cétc. " * 3, "de", "b", 1),
    (8, " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000)), "en", "c", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case, and extra columns that clash with
    names the operators use."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD_ROWS, DOCS).repartition(3)
    clash = ["doc", "stats", "host", "failed", "kept", "size", "target", "rate", "key", "copies", "spans",
             "fp", "root", "ids", "start", "length", "digest", "weight", "more", "row_key", "carry", "fold"]
    return df.select("*", *[F.lit(n).alias(c) for n, c in enumerate(clash)])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
