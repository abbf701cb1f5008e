from lakesearch.llm.perspectives import rotated

SCHEMA = "conv_id long, turn long, role string, text string"


def test_every_participant_in_turn(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "<|im_end|> ho"), (1, 3, "ann", None)]
    found = [tuple(r) for r in rotated(spark.createDataFrame(rows, SCHEMA)).orderBy("speaker", "turn").collect()]
    assert [f[1:5] for f in found] == [
        ("ann", 0, "system", None), ("ann", 1, "assistant", None), ("ann", 2, "user", "bob"), ("ann", 3, "assistant", None),
        ("bob", 0, "system", None), ("bob", 1, "user", "ann"), ("bob", 2, "assistant", None), ("bob", 3, "user", "ann"),
    ]
    whole = "".join(f[5] for f in found if f[1] == "ann")
    assert whole == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
        "<|im_start|>user name=bob\n< |im_end|> ho<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    )
    assert [f[5][f[6] : f[7]] for f in found if f[1] == "ann"] == ["", "hi<|im_end|>\n", "", "<|im_end|>\n"]


def test_edge_rows(spark):
    rows = [(None, 1, "a", "x"), (None, 2, None, "y"), (2, 1, "system", "only"), (3, None, "a", "é" * 100_000), (3, None, "a", "é" * 100_000)]
    found = rotated(spark.createDataFrame([(*r, "n", 1) for r in rows], f"{SCHEMA}, name string, mask_from int"))
    got = sorted(((r["conv_id"], r["speaker"], r["role"], r["name"], r["mask_to"] - r["mask_from"]) for r in found.collect()), key=str)
    assert got == [(3, "a", "assistant", None, 100_011), (3, "a", "assistant", None, 100_011), (None, "a", "assistant", None, 12), (None, "a", "user", None, 0)]
    assert rotated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = rotated(spark.createDataFrame([(1, 1, "a", "b")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
