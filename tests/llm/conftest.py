from __future__ import annotations

import pytest

from tests.llm.data import SCHEMA, awkward_rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def folders(spark, awkward, nothing, tmp_path_factory):
    """Tables with awkward rows and without rows, as folders that queries read."""
    made = {}
    vectors = spark.createDataFrame(
        [(1, [0.5, -1.0, 2.0], "a"), (1, [0.5, -1.0, 2.0], "a"), (None, [1.0, 0.0, 0.25], None), (2, None, "b"),
         (3, [1.0, None, 2.0], "c"), (4, [], "d"), (5, [float("nan"), 1.0, 1.0], "e"), (6, [1.0, float("inf"), 0.0], "f"),
         (7, [1.0, 2.0], "g"), (8, [0.125, 3.0, -2.5], "h"), (9, [-0.7, 0.3, 0.9], "i")],
        "vec_id bigint, embedding array<float>, n string",
    )
    benchmark = spark.createDataFrame(
        [(1, "House of Stone"), (1, "and was house"), (2, "Überall"), (None, "river stone green walks"), (3, None), (4, ""),
         (5, "--- !!"), (6, "the of and was house river stone green walks quickly under license"), (7, "two, WORDS")],
        "item_id bigint, text string",
    )
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 1), (2, 0, 0), (None, 1, 1), (5, None, 1), (6, 1, None), (8, 1, 1), (999, 1, 1), (100, 7, -1)],
        "doc_id bigint, quality int, toxic int",
    )
    pages = spark.createDataFrame(
        [(1, "http://a.example.com/x?y#z", None), (1, "http://a.example.com/x?y#z", ""), (None, None, "h"),
         (2, "no url", "h"), (3, "HTTPS://User@B.Example.ORG.:8080/p", "h"), (4, "", "")],
        "page_id bigint, url string, html string",
    )
    for name, docs, some in (("awkward", awkward, pages), ("nothing", nothing, pages.limit(0))):
        folder = str(tmp_path_factory.mktemp(name))
        docs.write.parquet(f"{folder}/documents.parquet")
        some.write.parquet(f"{folder}/pages.parquet")
        for table, rows in (("embeddings", vectors), ("benchmark", benchmark), ("labels", labels)):
            (rows if name == "awkward" else rows.limit(0)).write.parquet(f"{folder}/{table}.parquet")
        made[name] = folder
    return made
