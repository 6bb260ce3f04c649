import pytest

SF = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def words(n, k=0):
    return " ".join(f"w{(i * 7 + k * 13) % 97}x{(i * i + k) % 89}" for i in range(n))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties and clashing extra columns."""
    long = words(200_000)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, None, None),
        (4, long, "en", "a", len(long)),
        (5, words(60), "de", "b", 9),
        (5, words(60), "de", "b", 9),
        (6, words(60), "de", "b", 9),
        (None, words(60, 5), "fr", None, 9),
        (None, None, None, None, None),
        (7, "1234 !? ### ｆｏｏ 漢字 <|endoftext|> a\u0085b c d", "xx", "c", 3),
        (8, "x", "en", "c", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    extra = ["fp", "size", "place", "x", "component_id", "unit", "id", "label", "shard", "_part", "start", "copy"]
    return docs.selectExpr("*", *[f"cast(null AS string) AS {c}" for c in extra])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
