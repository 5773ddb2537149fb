import random

import pytest

SF = "/root/testdata/sf0.001"
#: Names that operators use inside; documents may have them as well.
CLASHING = "row size taken bits kept hash key version position keep n words shingles label score rep root first last id".split()


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = ". ".join(prose(12) for _ in range(8)) + "."
    long = "\n".join(prose(12) + "." for _ in range(4000))
    rows = [
        (1, passage, "en", "a"),
        (2, passage, "en", "a"),
        (2, passage, "en", "a"),
        (3, "Own words here first. " + passage + "\n" + prose(30), "de", None),
        (4, None, None, None),
        (5, "", "en", "b"),
        (6, " \t\n ", "en", "b"),
        (7, "\n\n\n", None, "b"),
        (8, "word", "en", "c"),
        (9, "word", "en", "c"),
        (10, "a shared line of text\na shared line of text\nx", "en", "c"),
        (11, "A Shared Line of text \nunlike this line here", "en", "c"),
        (12, long, "en", "a"),
        (13, long + " one more", "en", "a"),
        (None, passage, "en", "a"),
        (None, None, None, None),
        (14, "x" * 3000, "fr", "d"),
        (15, "\U0001f600 Été İ ß \x00 \x01\x02 !?", "fr", "d"),
        (16, "12345 67890 !!!", None, "d"),
        (2, "another text under the same id", "en", "a"),
    ]
    return [(*r, len(r[1]) if r[1] is not None else None, *[None] * len(CLASHING)) for r in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


@pytest.fixture(scope="session")
def edges(spark, edge_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges") / "documents.parquet")
    spark.createDataFrame(edge_rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark, edges):
    return spark.createDataFrame([], edges.schema)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2 if i != 8 else None, i % 3 == 0) for i in range(1, 17)] + [(1, 1, False), (None, 1, True), (99, 0, False)]
    return spark.createDataFrame([(i, q, int(t)) for i, q, t in rows], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
