"""The stages that rewrite or drop documents, and the pipeline of them: awkward rows, odd columns."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import decontamination, frames, jaccard_join, line_dedup, line_quality, pii_spans

CLASHES = ("dropped", "text_hash", "v_doc_id", "cut", "g_key", "g_doc_id", "doc", "k_id", "k_hash", "kept", "bad_id", "g_id", "h", "shard")
BASE = ("doc_id", "text", "source", "lang", "n_chars")


def stages(spark):
    items = spark.createDataFrame([(1, "word3 word4 word5")], "item_id long, text string")
    return {
        "rewrite": line_dedup.rewrite,
        "clean lines": line_quality.clean,
        "clean copies": jaccard_join.clean,
        "clean benchmark": lambda docs: decontamination.clean(docs, items),
    }


@pytest.fixture(scope="module")
def plain(awkward):
    return awkward.select("doc_id", "text", "source", "lang", F.lit(0).alias("n_chars"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["rewrite", "clean lines", "clean copies", "clean benchmark"])
def test_extra_columns_of_any_name_are_carried_along(spark, plain, name):
    stage = stages(spark)[name]
    clashing = plain.select("*", *(F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHES))
    found = stage(clashing)
    assert found.columns == clashing.columns
    assert rows(found.select(*BASE)) == rows(stage(plain))
    for r in found.collect():
        assert [r[c] for c in CLASHES] == [f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}" for c in CLASHES]
    assert stage(clashing.limit(0)).collect() == []


def test_lines_of_one_long_text(spark):
    lines = [f"line number {i} that is long enough" for i in range(100_000)]
    docs = spark.createDataFrame([(k, "\n".join(lines + [f"own {k}"])) for k in range(3)], "doc_id long, text string")
    start = time.time()
    kept = {r.doc_id: r.text for r in line_dedup.rewrite(docs).collect()}
    assert kept == {0: "own 0", 1: "own 1", 2: "\n".join(lines + ["own 2"])}
    assert time.time() - start < 120


def test_spans_of_one_long_text(spark):
    n = 20_000
    text = " ".join(f"mail user{i:05d}@host.org" for i in range(n))
    start = time.time()
    found = pii_spans.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    spans = [tuple(map(int, s.split(":")[1:])) for s in found["spans"].split(",")]
    assert found["n_email"] == n and [text[a:b] for a, b in spans] == text.split()[1::2]
    assert time.time() - start < 120


def test_running_sums_over_many_chunks(spark):
    values = [(7 * i) % 11 for i in range(1000)]
    sums = [sum(values[:i]) for i in range(1000)]
    df = spark.createDataFrame([(values,), ([],)], "v array<int>")
    for chunk in (1, 7, 256, 5000):
        found = df.select(frames.running(F.col("v"), lambda a, b: a + b, F.lit(0), chunk).alias("s")).collect()
        assert [r["s"] for r in found] == [sums, []]


def base_verdict(text):
    import re

    words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    return len(words) >= 50


def test_pipeline_on_awkward_rows_and_on_none(spark, awkward, plain, tmp_path):
    for name, docs in (("some", awkward), ("none", awkward.limit(0))):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, "word3 word4 word5")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        found = corpus_pipeline.run(spark, folder).collect()
        if name == "none":
            assert found == []
            continue
        # Each stage by itself, from what its predecessor kept.
        kept = docs
        for label, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, kept, folder)
            assert after.columns == docs.columns, label
            kept = frames.stored(after, label)
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r["doc_id"]) for r in kept.collect())
        assert all(base_verdict(r["text"]) for r in docs.join(kept.select("doc_id").distinct(), "doc_id", "left_semi").collect() if r["doc_id"] not in (3, 8))


def test_near_copies_of_the_pipeline_take_five_words_and_four_fifths(spark):
    words = [f"w{i}" for i in range(100)]
    near = words[:40] + ["x"] + words[41:80] + ["y"] + words[81:]
    far = words[:20] + ["x"] + words[21:40] + ["y"] + words[41:60] + ["z"] + words[61:]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert sorted(r.doc_id for r in stage(spark, docs, "").collect()) == [1, 3]
    assert sorted(r.doc_id for r in jaccard_join.clean(docs).collect()) == [1, 2, 3]
