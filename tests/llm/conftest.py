import pytest

#: Columns that bear the names operators use inside, or that only differ in case.
EXTRA = ("id", "n", "key", "digest", "h", "label", "score", "block", "row", "v", "locator", "Norm")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in EXTRA)


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text[, lang, source]) rows -> a documents table with clashing extra columns, read from Parquet."""
    def make(rows, path):
        full = [(r + (None,) * (4 - len(r)))[:4] for r in rows]
        data = [(i, t, la, s, len(t) if t is not None else None, *["x"] * len(EXTRA)) for i, t, la, s in full]
        spark.createDataFrame(data, SCHEMA).repartition(3).write.mode("overwrite").parquet(str(path))
        return spark.read.parquet(str(path))
    return make


LONG = "lorem ipsum dolor sit amet " * 40_000
EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three"), (6, LONG), (7, LONG), (8, "same text here, twice over again"),
         (9, "same text here, twice over again"), (9, "same text here, twice over again"), (10, "ÀÉ naïve 日本語 ́ 🙂 x y"), (11, "a" * 5000), (12, None)]


@pytest.fixture(scope="session")
def edges(make_docs, tmp_path_factory):
    """Nulls, empty, blank, very long, tied and repeated rows."""
    return make_docs([(i, t, "en" if i % 2 else None, "s" if i % 3 else None) for i, t in EDGES], tmp_path_factory.mktemp("edges") / "documents.parquet")


@pytest.fixture(scope="session")
def nothing(make_docs, tmp_path_factory):
    return make_docs([], tmp_path_factory.mktemp("none") / "documents.parquet")


@pytest.fixture(scope="session")
def edge_rows():
    return EDGES
