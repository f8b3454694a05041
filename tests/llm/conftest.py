import pytest

from sheaftext.llm.common import importable

ODD = [
    (1, None, "en", "a", None, "x"),
    (2, "", "en", "a", 0, "x"),
    (3, " \n\t ", "en", "a", 4, "x"),
    (4, "One single short line", "en", "a", 21, "x"),
    (4, "One single short line", "en", "a", 21, "x"),
    (5, "a much repeated line of text here\n" * 3, None, None, 9, "x"),
    (6, "A MUCH repeated line of text here \nother words follow after it", "de", "b", 9, "x"),
    (7, "  a much repeated line of text here\x0b", "de", "b", 9, "x"),
    (None, "words of a row without an id and more of them still", "de", "b", 9, "x"),
    (None, None, "de", "b", None, None),
    (8, "éÀß 中文 😀 <|endoftext|> x" * 20, "fr", "c", 9, "x"),
    (9, "long " * 30_000, "fr", "c", 150_000, "x"),
    (10, "w" * 20_000, "fr", "c", 20_000, "x"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_lines string"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and a column whose name clashes with results."""
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (5, 0, 1), (7, 1, 0), (8, 0, 1)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame([(1, "much repeated line of"), (2, ""), (3, None), (None, "single short"), (1, "words of a row without an id and more of them")], "item_id bigint, text string")


@pytest.fixture(scope="session")
def folder(spark, odd, labels, items, tmp_path_factory):
    """The odd rows as a folder of tables, and the same without rows."""
    paths = []
    for name, keep in (("odd", True), ("none", False)):
        path = tmp_path_factory.mktemp(name)
        pages = spark.createDataFrame(
            [(1, "https://A.example.com/en/1.html", "<p>x</p>"), (2, None, None), (3, "no scheme", ""), (4, "http://b.org?x", "<p>x</p>"), (4, "http://b.org?x", "<p>x</p>"), (None, "http://c.net/fr/\r\nEvil: 1", "\r\n\r\nWARC/1.1 é"), (6, "x://www.example.com/en/a/b/c/d", None)],
            "page_id bigint, url string, html string",
        )
        vectors = spark.createDataFrame([(0, [0.5, 1.0]), (20, [0.25, -1.0]), (20, None), (None, [0.5, None]), (3, [0.0, 0.0])], "vec_id bigint, embedding array<float>")
        for table, df in (("documents", odd), ("labels", labels), ("benchmark", items), ("pages", pages), ("embeddings", vectors)):
            df.where(str(keep)).write.parquet(f"{path}/{table}.parquet")
        paths.append(str(path))
    return paths
