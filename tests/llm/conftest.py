"""Small tables with every awkward case: nulls, empty and long texts, repeated rows, clashing columns."""

import pytest
from llm_samples import changed, sentence


@pytest.fixture(scope="session")
def odd_rows():
    base = [sentence(s, 120) for s in range(8)]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, changed(base[0], 60, i), "en", "src0", 1) for i in range(12)]
    rows += [(200 + i, base[1].upper() if i % 2 else base[1], "en", None, 2) for i in range(9)]
    rows += [(300, None, None, None, None), (301, "", "en", "src1", 0), (302, " \t\n ", "en", "src1", 4)]
    rows += [(303, "one two", "en", "src1", 7), (304, "ONE  two", "en", "src1", 8), (305, "one", "en", "é", 3)]
    rows += [(None, "text without an id at all", "en", "src2", 5), (None, None, "en", "src2", 5)]
    rows += [(400, sentence(50, 30000), "en", "src2", 9), (401, "a" * 50000, "en", "src2", 9)]
    rows += [(7, base[7], "en", "src1", len(base[7])), (7, "same id, other text and more words", "en", "src1", 1)]
    rows += [(500 + i, "\n".join(f"line {j} of a passage that repeats" for j in range(6)) + f"\nend {i}", "en", "src0", 3) for i in range(5)]
    rows += [(510, "a\na\na\na\na", "en", "src0", 9), (511, "Ünïcode 中文 \U0001f600 don't we'll 1½ x", "de", "src0", 9)]
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with columns named like results and helpers."""
    from pyspark.sql import functions as F

    names = ["id", "kept", "component_id", "keep_id", "size", "copies", "_k1", "_row", "score", "row", "name", "n"]
    return odd.select("*", *[F.lit(f"own {n}").alias(n) for n in names], F.create_map(F.lit("a"), F.lit(1)).alias("extra"))
