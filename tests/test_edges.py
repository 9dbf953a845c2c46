"""Empty tables, nulls and repeated rows for the operators that queries show on full tables."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import blending, conversations, evaluation, exam_prompts, handlers, ordinals, preprocessing, templates
from corpusloom.sources import files


def test_orders_of_empty_tables(spark):
    none = spark.createDataFrame([], "i bigint, g string, n int")
    assert ordinals.shuffled(none, "i", 1).count() == 0
    train, held = ordinals.train_validation(none, "i", 0.5, 1)
    assert train.count() + held.count() == 0
    assert ordinals.head_of_groups(none, "g", "i", 3).count() == 0
    assert ordinals.seeded_choices(none, "i", 4).count() == 0
    assert ordinals.sample_documents(none, ["i"], F.col("n"), 8).count() == 0
    for kind in ("single", "cyclic"):
        assert ordinals.loader_order(none, "i", kind, 2, 2).count() == 0
    with pytest.raises(ValueError, match="loader"):
        ordinals.loader_order(none, "i", "other", 2, 2)
    assert evaluation.distribution(none, "n").first()["n"] == 0
    assert blending.weighted_blend(spark, [1.0, 2.0], 0).count() == 0
    assert blending.exhaustive_blend(spark, [0, 0]).count() == 0
    assert handlers.pretrain_blocks(spark.createDataFrame([], "i bigint, t string"), "i", "t", 4).count() == 0


def test_nulls_and_ties(spark):
    d = spark.createDataFrame([(1, None, 3.0), (2, "a", None), (3, "a", 3.0), (4, "a", 0.0)], "i bigint, g string, v double")
    r = evaluation.distribution(d, "v").first()
    assert (r["n"], r["zeros"], r["most"], r["p5"]) == (3, 1, 3.0, 3.0)
    assert {(x["g"], x["rank"]) for x in ordinals.head_of_groups(d, "g", "i", 1).collect()} == {(None, 1), ("a", 1)}
    c = spark.createDataFrame([(1, [1, 2, 3], None), (1, None, [5]), (2, [], [])], "b int, x array<int>, y array<int>")
    got = ordinals.collated(c, "b", "x", "y", 2, 0).collect()
    assert sorted((r["b"], r["x"], r["y"], r["attention_mask"]) for r in got) == [(1, [0, 0, 0, 0], [-100] * 4, [0] * 4), (1, [1, 2, 3, 0], [-100] * 4, [1, 1, 1, 0]), (2, [], [], [])]
    left = ordinals.collated(c.where("b = 1"), "b", "x", "y", 2, 0, left=True).where("x[3] = 3").first()
    assert left["x"] == [0, 1, 2, 3]
    q = spark.createDataFrame([(1, None, "q", "a", None), (2, "s", None, None, "B")], "i int, subject string, question string, A string, answer string")
    made = exam_prompts.prompts(q, q.withColumn("rank", F.lit(1)), "choice", "i", options=("A",)).orderBy("i").collect()
    assert all(x["prompt"] for x in made)
    assert exam_prompts.prompts(q, q.withColumn("rank", F.lit(1)).limit(0), "loss", "i", options=("A",)).count() == 2
    assert exam_prompts.display_names(q, {}).orderBy("i").first()["name"] is None


def test_layouts_of_null_and_empty_lists(spark):
    d = spark.createDataFrame([(1, None), (2, []), (3, [("system", "s"), ("human", "q"), ("gpt", "a")]), (4, [("system", "s"), ("human", None), ("gpt", "a")]), (5, [("s", "s"), ("human", "q"), ("gpt", "a")]), (6, [("human", "q"), ("gpt", "a")])], "i int, conversations array<struct<from:string,value:string>>")
    kept = conversations.aligned(d, "periodic", conversations.Mapping(extra=("i",))).orderBy("i").collect()
    # a role that is a part of the system tag passes; a message without content breaks the count
    assert [x["i"] for x in kept] == [3, 5]
    assert [t["role"] for t in kept[0]["prompt"]] == ["system", "user"]
    assert conversations.aligned(d, "chat", conversations.Mapping(messages="conversations", extra=("i",))).count() == 4 - 1


def test_blend_reruns_blocks_that_began_wrongly(spark, monkeypatch):
    # without a run-up the guesses are often wrong and every block is made again from the right counts
    monkeypatch.setattr(blending, "RUN_UP", 0)
    w = [0.37, 0.33, 0.2, 0.1]
    whole = [tuple(r) for r in blending.weighted_blend(spark, w, 300).orderBy("pos").collect()]
    assert [tuple(r) for r in blending.weighted_blend(spark, w, 300, block=17).orderBy("pos").collect()] == whole


def test_paths_entries_and_templates(spark, tmp_path):
    assert preprocessing.confined("a/b", str(tmp_path)).endswith("a/b")
    with pytest.raises(ValueError, match="leads out"):
        preprocessing.confined("../x", str(tmp_path))
    with pytest.raises(ValueError, match="neat"):
        preprocessing.Config("a", "b", handler="instruction", neat=True).check()
    with pytest.raises(FileNotFoundError):
        preprocessing.output_prefixes([str(tmp_path / "none")])
    ranked = files.Entry("r", "file_name", "x", ranking=True)
    files.check_stage(ranked, "rm")
    with pytest.raises(ValueError, match="stage"):
        files.check_stage(ranked, "sft")
    plain = templates.inferred(lambda messages, opened: "<s>" + "".join(f"[{r}]{c}[/]" for r, c in messages) + ("[assistant]" if opened else ""), "<s>")
    assert (plain.user, plain.assistant, plain.default_system) == (("[user]{{content}}[/][assistant]",), ("{{content}}[/]",), "")
