import pytest

CLASHES = {"kept": "x", "n": 1, "bytes": 2, "size": 3, "fp": 4, "shard": 5, "bucket": 6, "component_id": 7, "hilbert": 8}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} {'string' if isinstance(v, str) else 'long'}" for c, v in CLASHES.items()
)

LONG = " ".join(f"w{i % 977}q{i}" for i in range(30_000))
STORY = " ".join(f"tale{i}" for i in range(120))
NEAR = STORY.replace("tale60", "other60")

#: Nulls, empty and very long texts, ties, repeated rows, shared ids, odd white space.
ROWS = [
    (1, STORY, "en", "b"),
    (2, STORY, "en", "b"),
    (3, NEAR, "en", "a"),
    (3, NEAR, "en", "a"),
    (4, None, None, None),
    (5, "", "en", "a"),
    (6, " \n\t ", "de", "c"),
    (7, LONG, "fr", "c"),
    (8, LONG + " end", "fr", None),
    (None, "a null id has some words", "en", "a"),
    (None, STORY, None, "b"),
    (9, "x", "en", "d"),
    (10, "repeat this line of words\n" * 40, "en", "a"),
    (11, "Größe çé 東京 　 😀 it's  I'll\r\n\n <|endoftext|> 123 ##$", "de", "ä"),
    (12, "tie", "en", "d"),
    (12, "other text, same id", "en", "d"),
    (-5, "negative id", "es", "𐀀"),
    (13, "a" * 5000, "en", "z"),
]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(*r, len(r[1] or ""), *CLASHES.values()) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
