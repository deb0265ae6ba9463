import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns of clashing names."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abdeilnorst") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = text(30_000)
    shared = text(120)
    rows = [(i, text(rng.randint(1, 150)), "en", f"s{i % 3}", 1) for i in range(60)]
    rows += [(100 + i, shared, "en", "s0", 2) for i in range(25)]  # copies
    rows += [(200 + i, shared + f" tail{i}", "en", "s1", 2) for i in range(5)]  # near copies
    rows += [(300, None, None, None, None), (301, "", "", "", 0), (302, " \n\t ", "en", "s2", 0), (303, long, "en", "s0", 3)]
    rows += [(None, text(20), "en", "s1", 1), (None, None, "en", None, 1), (304, "x", None, "s0", 1), (305, "123 !!", "en", "s2", 1)]
    rows += [rows[3], rows[3], rows[61]]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = ("score", "size", "fp", "component_id", "key", "rank", "h", "length", "row", "nil", "id", "hash", "_size", "_key", "_row", "salt", "cell", "shard")
    return df.withColumns({c: F.lit(c) for c in (*extra, "mid", "part", "a.dot", "back`tick")}).repartition(4)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf(request):
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def brute_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
