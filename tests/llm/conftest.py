import random

import pytest


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    parts = ["an", "the", "or", "in", "re", "st", "ou", "ti", "er", "ha", "ed", "ble"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(900)]


@pytest.fixture(scope="session")
def rows(words):
    """(doc_id, text, lang, source): near and exact copies, nulls, empty and very long texts, repeated rows, a null id and source."""
    rng = random.Random(7)
    base = [[rng.choice(words) for _ in range(rng.randint(12, 90))] for _ in range(40)]
    out = []
    for i, text in enumerate(base):
        out.append((i, " ".join(text), ["en", "de", None][i % 3], f"s{i % 4}"))
    for i in range(40, 90):
        text = list(base[i % 7])
        for _ in range(i % 3):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append((i, ("\n" if i % 5 == 0 else " ").join(text), "en", "s0"))
    long = " ".join(rng.choice(words) for _ in range(40_000))
    out += [(200, None, "en", "s1"), (201, "", "en", None), (202, " \n\t ", "de", "s1"), (203, long, "en", "s2"), (204, long + " end", "en", "s2"),
            (None, out[3][1], "en", "s3"), (205, "one", "en", None), (206, "One", "fr", None), (207, "a b", "fr", None),
            (208, "\n".join(["same old line again and"] * 9), "en", "s1"), (3, out[3][1], out[3][2], out[3][3]), (3, out[3][1], out[3][2], out[3][3])]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With further columns whose names clash with those used inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "1 AS size", "2 AS n", "'x' AS quality", "3 AS shard", "4 AS digest", "5 AS m", "6 AS taken", "7 AS root").repartition(3)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, int(i % 6 != 0), int(i % 9 == 0)) for i in range(90)] + [(None, 1, 1), (5, None, None), (3, 1, 0)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
