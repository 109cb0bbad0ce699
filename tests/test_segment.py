from collections import Counter

from pyspark.sql import functions as F

from leafmill.operators import segment

CHAPTER = """# 第一章 三角形

## 1.1 概念

**定义 1** 三条线段围成的图形。

![image](a.png)

### 例子

**例 1** 求周长。

**解** 周长为 12。

## 1.2 习题

**习题集** 不是习题
**习题 1** 求面积。
"""


def items(spark, text):
    return segment.extract_items(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("item_seq").collect()


def test_items_types_and_paths(spark):
    got = items(spark, CHAPTER)
    assert Counter(r["item_type"] for r in got) == {"chapter": 1, "section": 2, "definition": 1, "other": 1, "example": 1, "solution": 1, "exercise": 1}
    assert [r["item_id"] for r in got] == [f"item-{k:04d}" for k in range(1, len(got) + 1)]
    assert got[0]["chapter_path"] == ["第一章 三角形"]
    assert got[-1]["chapter_path"] == ["第一章 三角形", "1.2 习题"]
    assert got[3]["title"] == "例子" and got[3]["chapter_path"] == ["第一章 三角形", "1.1 概念"]


def test_section_before_chapter_and_empty(spark):
    got = items(spark, "## only section\ntext")
    assert got[0]["chapter_path"] == ["only section"]
    assert items(spark, "") == [] and items(spark, None) == []


def test_new_chapter_forgets_section(spark):
    got = items(spark, "# a\n## s\nx\n# b\ny")
    assert [r["chapter_path"] for r in got] == [["a"], ["a", "s"], ["b"]]


def test_blocks(spark):
    df = spark.createDataFrame([(1, "one\ntwo\n\n- a\n- b\n\n\nlast\n")], "doc_id long, text string")
    got = [(r["kind"], r["body"]) for r in segment.text_blocks(df).orderBy("block_no").collect()]
    assert got == [("paragraph", "one\ntwo"), ("list", "- a\n- b"), ("paragraph", "last")]


def test_no_python_in_plan(spark):
    df = segment.extract_items(spark.createDataFrame([(1, CHAPTER)], "doc_id long, text string"))
    assert "Python" not in df._jdf.queryExecution().toString() and df.agg(F.count("*")).first()[0] == 8
