import pytest

from leafmill.operators import taxonomy

OUTLINE = {
    "topics": [{"id": "a", "chapter_stopwords": ["triangle unit"], "children": [{"id": "a-1"}, {"id": "a-2"}]}, {"id": "b"}],
    "vocabulary": {"a-1": {"keywords": ["Triangle", "angle"], "patterns": ["tri.*le"], "priority": 1}, "a-2": {"keywords": ["angle"], "negative_keywords": ["circle"]}, "b": {"keywords": ["line", "line"]}},
}


def top(spark, text):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    return [(r["topic_id"], r["score"]) for r in taxonomy.top_topics(df, taxonomy.load_outline(OUTLINE), ["id"]).orderBy("rank").collect()]


def test_scores(spark):
    assert top(spark, "A TRIANGLE here") == [("a-1", 3), ("a-2", 1)]
    assert top(spark, "triangle unit") == [("a-1", 1)]  # keywords are scrubbed, patterns are not
    assert top(spark, "angle in a circle") == [("a-1", 1)]
    assert top(spark, "a line") == [("b", 2)]
    assert top(spark, "nothing") == [("_misc", 0)]


@pytest.mark.parametrize("bad", [{"topics": [{"id": "A b"}]}, {"topics": [{"id": "a"}, {"id": "a"}]}, {"topics": [{"id": "a", "children": [{"id": "b"}]}], "vocabulary": {"a": {}}}, {"topics": [{"id": "a"}], "vocabulary": {"z": {}}}, {"topics": [{"id": "a"}], "vocabulary": {"a": {"patterns": ["("]}}}, {"topics": [], "strategy": {"default": "X"}}])
def test_bad_outlines(bad):
    with pytest.raises(ValueError):
        taxonomy.load_outline(bad)


def test_top4_is_a_group_limit(spark):
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    plan = taxonomy.top_topics(df, taxonomy.load_outline(OUTLINE), ["id"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
