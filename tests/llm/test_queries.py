"""The text queries agree with their SQL on the smallest tables, and on tables that repeat, lack or empty their texts."""

import os

import pytest

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


def _names():
    from marlstone.llm import queries

    return sorted(queries.QUERIES)


def _agrees(spark, folder, name):
    from compare import compare

    from marlstone.llm import queries

    if name in queries.ORACLE:
        assert compare(spark, folder, name, queries.QUERIES[name], queries.ORACLE[name]) == ""
    else:
        assert queries.QUERIES[name](spark, folder).count() >= 0


@pytest.mark.parametrize("name", _names())
def test_query_agrees_with_sql(spark, name):
    _agrees(spark, FOLDER, name)


@pytest.mark.parametrize("name", ["p9_found", "p9_cleaned", "p10_found", "p10_sources"])
def test_query_agrees_on_hard_texts(spark, tmp_path, name):
    texts = [None, "", " \n ", "!?", "One two. Three", "One two. Three", "one\ntwo\nthree four five six seven eight nine ten eleven twelve END thirteen", "a…", "```\nopen", "x https://a.example/b/", "é ǃ 价格 12.5"]
    docs = [(i, t, None if i % 4 == 3 else f"s{i % 3}", 5) for i, t in enumerate(texts * 3)]
    spark.createDataFrame(docs, "doc_id bigint, text string, source string, tokens int").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, "ONE two, three four five six seven eight nine ten eleven twelve"), (2, None), (3, "too short"), (4, "")]
    spark.createDataFrame(items, "item_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "eval_item.parquet"))
    _agrees(spark, str(tmp_path), name)
