import pytest
from pyspark.sql import functions as F

WORDS = ("alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo "
         "sierra tango uniform victor whiskey xray yankee zulu").split()


def prose(seed: int, n: int) -> str:
    import random
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns with the names of added ones."""
    text = prose(1, 40)
    rows = [(1, text), (1, text), (2, text), (3, None), (4, ""), (5, " \n\t"), (6, "x"), (7, "one two three"), (None, prose(2, 60)),
            (8, prose(3, 30_000)), (9, "0123 !!! ???"), (10, "日本語 ÄÖ é ​ \x00"), (11, prose(1, 39) + " changed"), (3, None),
            (12, "a" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ["n_words", "score", "predicted", "h", "band", "comp", "similarity", "token_ids", "decoded", "lang_pred", "contaminated",
             "labels", "class_id", "_label", "_row", "v", "n"]
    return df.select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"),
                     *[F.lit("mine").alias(c) for c in clash])
