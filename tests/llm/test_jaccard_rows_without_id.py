"""Rows with and without an id that make one set are found by the text of the row that names them."""

from basketry.llm import jaccard_join


def test_equal_sets_of_a_row_with_and_one_without_id(spark):
    base = [f"w{i}" for i in range(60)]
    near = [*base[:59], "other"]
    docs = [(None, " ".join(base).upper()), (5, " ".join(base)), (6, " ".join(near)), (None, "\t".join(near)), (7, " ".join([*base, "more"]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    found = jaccard_join.report(frame).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in found), key=repr) == [(5, 5), (6, 5), (7, 5), (None, 5), (None, 5)]
