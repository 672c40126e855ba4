"""Line dedup where texts are shorter than a window."""

import corpus_pipeline
from tablewarden.llm import line_dedup


def test_pipeline_removes_copies_of_short_texts(spark):
    texts = ["one line", "one line", "a\n\nb", "a\nb", "a", "x\na\nb\nc", "b\na", " \n", "", None, " \n"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.lines(spark, docs, "")
    assert {r.doc_id: r.text for r in left.collect()} == {i: t for i, t in enumerate(texts) if i not in (1, 3)}


def test_what_is_gathered_is_bounded(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), *[(None, "a\nb\nc\nd")] * 50], "doc_id long, text string")
    gone = line_dedup.repeated_lines(docs)
    assert "collect_list" not in gone._jdf.queryExecution().toString()
    # the first of all rows keeps its lines; rows that repeat throughout are cut alike
    assert [sorted(r["__gone"]) for r in gone.collect()] == [[0, 1, 2]]
