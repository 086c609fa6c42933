"""Every conversation with an assistant turn gives a pair."""

from basketry.llm import preference, registered

SHAPE = "turn long, role string, text string"


def pairs(spark, turns, kind="long"):
    frame = spark.createDataFrame(turns, f"conv_id {kind}, {SHAPE}").repartition(3)
    found = preference.report(frame, preference.following_replies).collect()
    assert len(found) == len({r["conv_id"] for r in found})
    return {r["conv_id"]: r for r in found}


def said(completion):
    return completion.removeprefix("<|im_start|>assistant\n").removesuffix("<|im_end|>\n")


def test_sparse_ids_trailing_users_and_the_greatest_id(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (900, 0, None, "q"), (900, 1, "assistant", "a900"), (900, 2, "user", "thanks"), (900, 3, None, None),
             (50, 0, "user", "alone"), (None, 0, "assistant", "lost"), (70, 0, "assistant", "")]
    got = pairs(spark, turns)
    assert {k: (said(r["chosen"]), said(r["rejected"])) for k, r in got.items()} == {1: ("a1", ""), 70: ("", "a900"), 900: ("a900", "a1")}
    assert got[900]["prompt"] == "<|im_start|>unknown\nq<|im_end|>\n"


def test_many_ids_as_text(spark):
    ids = sorted(f"{i * 7919 % 1000:03d}x" for i in range(300))
    got = pairs(spark, [(i, t, "assistant", f"{i}{t}") for i in ids for t in range(2)], "string")
    assert [said(got[i]["rejected"]) for i in ids] == [f"{i}1" for i in ids[1:] + ids[:1]]


def test_a_single_conversation_has_an_empty_rejected_side(spark):
    got = pairs(spark, [(4, 0, "assistant", "only")])
    assert (said(got[4]["chosen"]), got[4]["rejected"], got[4]["n_prompt"]) == ("only", "", 0)


def test_the_registered_query_loses_no_conversation(spark, tmp_path):
    turns = [(i, t, r, f"{i}") for i in (2, 5, 9) for t, r in enumerate(("user", "assistant", "user"))]
    spark.createDataFrame(turns, f"conv_id long, {SHAPE}").write.parquet(f"{tmp_path}/conversations.parquet")
    assert {r["conv_id"] for r in registered.op7_preference(spark, str(tmp_path)).collect()} == {2, 5, 9}
