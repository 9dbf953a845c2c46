import json
import random
from bisect import bisect

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import blending, evaluation, handlers, knapsack, markup_template, ordinals, templates, tool_formats
from corpusloom.operators import conversations as C


def walk(sizes, length, extra, drop_last):
    """Sample boundaries by stepping through documents without empty ones."""
    total = sum(sizes)
    n = (total - extra) // length if drop_last else -(-(total - extra) // length)
    if total <= extra:
        return []
    out, doc, off = [(0, 0)], 0, 0
    while len(out) <= n:
        left = length + extra
        while left:
            have = sizes[doc] - off
            left -= have
            if left <= 0:
                off += left + have - extra
                left = 0
            elif doc == len(sizes) - 1:
                off = sizes[doc] - extra
                break
            else:
                doc, off = doc + 1, 0
        out.append((doc, off))
    return out


@pytest.mark.parametrize("extra", [0, 1])
@pytest.mark.parametrize("drop_last", [True, False])
def test_sample_boundaries_against_a_walk(spark, extra, drop_last):
    r = random.Random(extra * 2 + drop_last)
    for _ in range(4):
        sizes = [r.randint(1, 23) for _ in range(r.randint(1, 30))]
        d = spark.createDataFrame(list(enumerate(sizes)), "doc int, n int")
        got = ordinals.sample_boundaries(d, ["doc"], F.col("n"), 7, extra, drop_last).orderBy("sample").collect()
        assert [(x["doc"], x["offset"]) for x in got] == walk(sizes, 7, extra, drop_last), (sizes, extra, drop_last)


def test_prefix_sums_and_chunks(spark):
    r = random.Random(2)
    sizes = [r.choice([0, None, 3, 40]) for _ in range(200)]
    d = spark.createDataFrame(list(enumerate(sizes)), "doc int, n int").repartition(7)
    got = {x["doc"]: x["p"] for x in ordinals.with_prefix(d, ["doc"], F.col("n"), "p").collect()}
    at = 0
    for i, n in enumerate(sizes):
        assert got[i] == at
        at += n or 0
    parts = ordinals.chunks(d, ["doc"], F.coalesce("n", F.lit(0)), 16).collect()
    stream = [(i, k) for i, n in enumerate(sizes) for k in range(n or 0)]
    blocks = {}
    for p in parts:
        blocks.setdefault(p["chunk"], []).extend((p["doc"], p["from"] + k) for k in range(p["n"]))
    assert {k: sorted(v) for k, v in blocks.items()} == {k: stream[16 * k : 16 * k + 16] for k in range(len(stream) // 16)}
    assert ordinals.with_prefix(d.limit(0), ["doc"]).count() == 0


def test_splits_and_parts(spark):
    assert ordinals.split_weights("99,1,0") == [0.99, 0.01, 0]
    assert ordinals.split_bounds([0.5, 0.0, 0.5]) == [(0.0, 0.5), None, (0.5, 1.0)]
    assert ordinals.split_ranges([0.5, 0.5], 5) == [(0, 2), (2, 5)]
    assert ordinals.sub_ranges(7, 3) == [(0, 3), (3, 6), (6, 7)]
    with pytest.raises(ValueError, match="gap"):
        ordinals.sub_ranges(2, 0)
    got = [x[0] for x in spark.range(11).select(ordinals.even_part(F.col("id"), 11, 4)).collect()]
    assert got == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3]
    assert ordinals.epochs_needed(10, 4, 5) == 3
    assert ordinals.separate_final_epoch(130, 100)
    assert not ordinals.separate_final_epoch(195, 100)


def test_orders_are_permutations(spark):
    d = spark.range(50).withColumnRenamed("id", "i")
    got = ordinals.epoch_order(d, "i", 3, 1, separate_last=True).collect()
    assert sorted(x["pos"] for x in got) == list(range(150))
    assert all(x["pos"] >= 100 for x in got if x["epoch"] == 2)
    again = ordinals.epoch_order(d.repartition(5), "i", 3, 1, separate_last=True).collect()
    assert {tuple(x) for x in again} == {tuple(x) for x in got}
    drawn = ordinals.resampled(d, "i", 70, 4).collect()
    assert len(drawn) == 70
    assert {x["i"] for x in drawn} == set(range(50))
    assert ordinals.resampled(d, "i", 20, 4).count() == 20
    buckets = ordinals.bucket_order(d, "i", 0, 2, 4, 9).collect()
    assert {r: sorted(x["pos"] for x in buckets if x["rank"] == r) for r in range(4)} == {r: list(range(12)) for r in range(4)}


def test_support_sets_are_the_first_of_each_group(spark):
    d = spark.range(300).select((F.col("id") % 3).alias("g"), F.col("id").alias("i"))
    got = ordinals.support_set(d, "g", "i", 5, 2).collect()
    import hashlib

    for g in range(3):
        want = sorted(range(g, 300, 3), key=lambda i: (hashlib.md5(f"2-{i}".encode()).hexdigest(), i))[:5]
        assert [x["i"] for x in sorted((x for x in got if x["g"] == g), key=lambda x: x["rank"])] == want


def test_blends(spark):
    def greedy(weights, size, limits=None):
        taken, out = [0] * len(weights), []
        for i in range(size):
            best = max((k for k in range(len(weights)) if limits is None or taken[k] < limits[k]), key=lambda k: (weights[k] * max(i, 1) - taken[k], -k))
            out.append((i, best, taken[best]))
            taken[best] += 1
        return out

    assert [tuple(x) for x in blending.weighted_blend(spark, [3, 2, 1], 60).collect()] == greedy([0.5, 1 / 3, 1 / 6], 60)
    sizes = [5, 11, 0, 2]
    assert [tuple(x) for x in blending.exhaustive_blend(spark, sizes).collect()] == greedy([n / 18 for n in sizes], 18, sizes)
    first = blending.interleaved(spark, [3, 50], [0.5, 0.5], 1).collect()
    assert [x["sample_id"] for x in first if x["dataset_id"] == 0] == [0, 1, 2] or [x["sample_id"] for x in first if x["dataset_id"] == 1] == list(range(50))
    every = blending.interleaved(spark, [3, 9], [0.5, 0.5], 1, "all_exhausted").collect()
    assert {x["sample_id"] for x in every if x["dataset_id"] == 0} == {0, 1, 2}
    assert {x["sample_id"] for x in every if x["dataset_id"] == 1} == set(range(9))
    assert blending.interleaved(spark, [0, 9], [0.5, 0.5], 1).count() == 0
    assert blending.dataset_sizes([1, 1], 100) == [51, 51]
    assert blending.blend_list(["1", "a", "2", "b"]) == ([1.0, 2.0], ["a", "b"])
    assert blending.blend_list(["a", "b"]) == (None, ["a", "b"])
    assert blending.blend_list(["1", "a", "b"]) == (None, ["1", "a", "b"])


def plain_greedy(numbers, capacity):
    numbers, out = sorted(numbers), []
    while numbers:
        pack, room = [], capacity
        while i := bisect(numbers, room):
            room -= numbers[i - 1]
            pack.append(numbers.pop(i - 1))
        out.append(pack)
    return out


def test_knapsack_against_the_list(spark):
    r = random.Random(8)
    for _ in range(300):
        cap = r.randint(3, 40)
        numbers = [r.randint(1, cap) for _ in range(r.randint(0, 60))]
        histogram = {n: numbers.count(n) for n in numbers}
        assert knapsack.greedy(histogram, cap) == plain_greedy(numbers, cap)
    with pytest.raises(ValueError, match="longer"):
        knapsack.greedy({5: 1}, 4)
    with pytest.raises(ValueError, match="no tokens"):
        knapsack.greedy({0: 1}, 4)
    sizes = [r.choice([7, 7, 7, r.randint(1, 30)]) for _ in range(400)]
    d = spark.createDataFrame(list(enumerate(sizes)), "i int, n int")
    got = knapsack.slots(d, "n", "i", 30).collect()
    assert len(got) == 400
    packs = {}
    for x in got:
        packs.setdefault(x["pack"], {})[x["slot"]] = x
    want = plain_greedy(sizes, 30)
    last = {}
    for i, n in enumerate(sizes):
        last.setdefault(n, []).append(i)
    for k, pack in enumerate(want):
        for s, n in enumerate(pack):
            assert (packs[k][s]["n"], packs[k][s]["i"], packs[k][s]["at"]) == (n, last[n].pop(), sum(pack[:s]))


def test_packed_rows(spark):
    d = spark.createDataFrame([(i, list(range(i + 1)), [-100] * (i + 1)) for i in range(8)] + [(99, [], []), (100, list(range(40)), [1] * 40)], "i int, input_ids array<int>, labels array<int>")
    for extra, batch in ((0, None), (1, "b")):
        got = knapsack.packed(d.withColumn("b", F.col("i") % 2), "i", 10, 258, neat=False, extra=extra, batch=batch, with_positions=True).collect()
        assert all(len(x["input_ids"]) == len(x["labels"]) == len(x["attention_mask"]) == len(x["position_ids"]) == 10 + extra for x in got)
        assert sum(x["n_samples"] for x in got) == 8
        assert sum(x["n_tokens"] for x in got) == 36
    neat = knapsack.packed(d, "i", 10, 258, neat=True).collect()
    assert sum(x["n_samples"] for x in neat) == 9
    assert all(x["attention_mask"][-1] == 0 for x in neat)


def test_cut_turns_and_pairs(spark):
    d = spark.createDataFrame([(1, list(range(20)), [-100] * 6 + [6, 7, 8] + [-100] * 5 + list(range(14, 20))), (2, [1, 2], [-100, 2])], "i int, input_ids array<int>, labels array<int>")
    got = {x["i"]: x for x in knapsack.cut_turns(d, 12).collect()}
    assert len(got[1]["input_ids"]) == len(got[1]["labels"]) <= 12
    assert got[2]["input_ids"] == [1, 2]
    p = spark.createDataFrame([(1, [1, 2, 3, 7, 8], [-100, -100, -100, 7, 8], [1, 2, 3, 9], [-100, -100, -100, 9])], "i int, chosen_input_ids array<int>, chosen_labels array<int>, rejected_input_ids array<int>, rejected_labels array<int>")
    x = knapsack.cut_pairwise(p, 4).first()
    assert x["chosen_input_ids"][-1] in (7, 8)
    assert len(x["chosen_input_ids"]) <= 4
    assert knapsack.pairwise_rows(p, "i").count() == 2


def chat(*turns):
    return [{"from": a, "value": b} for a, b in turns]


SCHEMA = "i int, conversations array<struct<from:string,value:string>>, system string, chosen struct<from:string,value:string>, rejected struct<from:string,value:string>"


def test_sharegpt(spark):
    rows = [
        (1, chat(("human", "q"), ("gpt", "a")), "s", None, None),
        (2, chat(("system", "x"), ("human", "q"), ("gpt", "a")), "s", None, None),
        (3, chat(("human", "q")), None, None, None),
        (4, chat(("gpt", "a"), ("human", "q")), None, None, None),
        (5, chat(("human", "q"), ("odd", "a")), None, None, None),
        (6, [], None, None, None),
        (7, None, None, None, None),
        (8, chat(("human", "q"), ("function_call", "f"), ("observation", "o"), ("gpt", "a")), None, None, None),
        (9, chat(("human", None), ("gpt", "a")), None, None, None),
    ]
    m = C.Mapping(system="system", extra=("i",))
    d = spark.createDataFrame(rows, SCHEMA)
    got = {x["i"]: x for x in C.from_sharegpt(d, m).collect()}
    assert len(got) == 9
    assert {i for i, x in got.items() if x["prompt"] and x["response"]} == {1, 2, 8}
    assert (got[1]["system"], got[2]["system"]) == ("s", "x")
    assert [t["role"] for t in got[8]["prompt"]] == ["user", "function", "observation"]
    assert {x["i"] for x in C.aligned(d, "sharegpt", m).collect()} == {1, 2, 8}
    pair = spark.createDataFrame([(1, chat(("human", "q")), None, chat(("gpt", "y"))[0], chat(("gpt", "n"))[0]), (2, chat(("human", "q"), ("gpt", "a")), None, chat(("gpt", "y"))[0], chat(("gpt", "n"))[0])], SCHEMA)
    ranked = C.aligned(pair, "sharegpt", m.renamed(ranking=True)).collect()
    assert [(x["i"], [t["content"] for t in x["response"]]) for x in ranked] == [(1, ["y", "n"])]


def test_alpaca_and_openai(spark):
    d = spark.createDataFrame([("do", "it", "ok", [["a", "b"]]), ("do", "", None, None), (None, None, "x", [])], "instruction string, input string, output string, history array<array<string>>")
    got = C.from_alpaca(d, C.Mapping(history="history")).collect()
    assert [t["content"] for t in got[0]["prompt"]] == ["a", "b", "do\nit"]
    assert got[1]["response"] == []
    assert C.aligned(d, "alpaca", C.Mapping(history="history")).count() == 2
    o = spark.createDataFrame(
        [([("system", "s", None), ("user", "q", None), ("assistant", None, "c1"), ("tool", "r", None), ("tool", "r2", None), ("assistant", "a", None)],), ([("user", "q", None)],), ([("assistant", "a", None)],), ([("user", "q", None), ("who", "?", None), ("assistant", "a", None)],), ([],)],
        "messages array<struct<role:string,content:string,tool_call_id:string>>",
    )
    good = C.aligned(o, "openai").collect()
    assert len(good) == 1
    assert good[0]["system"] == "s"
    assert [(t["role"], t["content"], t["tool_call_id"]) for t in good[0]["prompt"]][1] == ("assistant", "", "c1")
    merged = C.aligned(o, "openai").select(C.merged_tool_results(F.transform(F.concat("prompt", "response"), lambda x: C.turn(x["role"], x["content"]))).alias("m")).first()["m"]
    assert [t["content"] for t in merged][:3] == ["q", "", "r" + C.RESULTS_BETWEEN + "r2"]


def test_mappings_and_registries(spark):
    with pytest.raises(KeyError, match="unknown"):
        C.Mapping().renamed(nothing="x")
    with pytest.raises(KeyError, match="missing"):
        C.from_alpaca(spark.range(1))
    with pytest.raises(KeyError, match="layout"):
        C.aligned(spark.range(1), "none")
    with pytest.raises(ValueError, match="exists"):
        C.register_converter("alpaca", C.from_alpaca)
    with pytest.raises(ValueError, match="exists"):
        templates.register("qwen", templates.Template())


def test_flatten_recent_and_marked(spark):
    d = spark.createDataFrame([([("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")], "Human: x Assistant: y Human: z")], "m array<struct<role:string,content:string>>, t string")
    x = d.select(C.flattened_text(F.col("m")).alias("f"), C.recent_turns(F.col("m")).alias("r"), C.split_marked(F.col("t")).alias("s")).first()
    assert x["f"] == "abcd"
    assert [t["content"] for t in x["r"]] == ["c", "d"]
    assert [(t["role"], t["content"]) for t in x["s"]] == [("user", "x"), ("assistant", "y"), ("assistant", "z")]
    with pytest.raises(Exception, match="no content"):
        spark.createDataFrame([([("user", None)],)], "m array<struct<role:string,content:string>>").select(C.flattened_text(F.col("m"))).collect()


def turns(*said):
    return [{"role": "user" if i % 2 == 0 else "assistant", "content": s} for i, s in enumerate(said)]


def test_handlers():
    o = handlers.Options(cutoff=1000)
    row = {"prompt": turns("q", "a", "r"), "response": [{"role": "assistant", "content": "b"}], "system": "s", "tools": ""}
    out = handlers.instruction(row, o)[0]
    assert out["input_ids"] == [256, 262, 115, 260, 113, 261, 97, 257, 260, 114, 261, 98, 257]
    assert [x for x in out["labels"] if x != -100] == [97, 257, 98, 257]
    assert handlers.instruction({"prompt": [], "response": []}, o)[0]["input_ids"] == [256, 260, 261, 257]
    assert handlers.processed_sft({"prompt": [], "response": []}, o) == []
    masked = handlers.processed_sft(row, handlers.Options(cutoff=8, mask_history=True))[0]
    assert len(masked["input_ids"]) <= 8
    assert [x for x in masked["labels"] if x != -100] == [98, 257]
    both = handlers.pairwise({"prompt": turns("q"), "response": [{"role": "assistant", "content": c} for c in "yn"]}, o)[0]
    assert both["chosen_labels"][-2:] == [121, 257]
    assert both["rejected_labels"][-2:] == [110, 257]
    assert handlers.prompt_only(row, o)[0]["input_ids"] == [256, 262, 115, 260, 113, 261, 260, 114, 261]
    assert handlers.all_but_last_answer(row, handlers.Options(labels_from_answer=True))[0]["labels"] == [98]
    assert handlers.general_pretrain({"text": "abc"}, handlers.Options(append_eod=True, pad_to_multiple=4))[0]["input_ids"] == [97, 98, 99, 259]
    assert handlers.general_pretrain({"text": None}, o) == []
    prompted = handlers.general_instruction({"instruction": "i", "input": "", "output": "o"}, o)[0]
    assert bytes(x for x in prompted["labels"] if x != -100) == b"o\n"
    moss = {"chat": [{"Human": "<|Human|>: hi<eoh>", "MOSS": "<|MOSS|>: yo<eom>"}, None]}
    assert handlers.role_id_turns(moss, o)[0]["input_ids"] == [195, 104, 105, 196, 121, 111, 257]
    assert len(handlers.every_prefix({"chat": moss["chat"][:1] * 3}, o)) == 3
    assert b"None" in bytes(handlers.alpaca_pretrain({"instruction": "i", "output": "o"}, o)[0]["input_ids"])
    assert handlers.sharegpt_pretrain({"messages": [{"value": "a"}, {"content": "b"}]}, o)[0]["input_ids"] == [97, 98]
    marked = handlers.instruction(row, handlers.Options(template="deepseek4"))[0]
    assert bytes(x for x in marked["labels"] if x != -100).decode() == "a<｜end▁of▁sentence｜></think>b<｜end▁of▁sentence｜>"
    assert handlers.handler("no such name") is handlers.general_pretrain
    assert bytes(handlers.code_instruction({"code_with_problem": "sum ```py", "code_only": "c", "explanation_only": "e"}, o)[0]["input_ids"]).endswith(b"c\ne\n")
    assert b"x" in bytes(handlers.marked_turns({"instruction": "Human: x Assistant: ", "output": "y"}, o)[0]["input_ids"])


def test_tokenized_keeps_every_row(spark):
    d = spark.createDataFrame([(1, "ab"), (2, None), (3, "")], "i int, text string")
    assert [(x["i"], x["input_ids"]) for x in handlers.tokenized(d, "general_pretrain", "i").collect()] == [(1, [97, 98])]


def test_templates():
    said = [("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "b")]
    assert templates.rendered(templates.template("llama2"), said[:2], "S") == "<s>[INST] <<SYS>>\nS\n<</SYS>>\n\nq [/INST]a</s>"
    assert templates.rendered(templates.template("alpaca"), said[:2]).startswith("Below is an instruction")
    t = handlers.ByteTokenizer()
    for name in templates.REGISTRY:
        pairs = templates.encoded_pairs(templates.template(name), said, "s", None, t, 40)
        assert sum(len(a) + len(b) for a, b in pairs) <= 41
    thinking = templates.encoded_pairs(templates.template("qwen3"), said, None, None, t)
    assert bytes(x for x in thinking[0][1] if x < 256).startswith(b"<think>")
    call = json.dumps({"name": "f", "arguments": {"x": 1}})
    assert "Action: f" in templates.rendered(templates.template("default"), [("user", "q"), ("function", call)])
    assert tool_formats.extracted(f"<tool_call>\n{call}\n</tool_call>") == [("f", '{"x": 1}')]
    assert tool_formats.extracted('Action: g\nAction Input: {"y": 2}') == [("g", '{"y": 2}')]
    assert tool_formats.extracted("<tool_call>{</tool_call>") == "<tool_call>{</tool_call>"
    assert tool_formats.described("no json") == ""
    tools = json.dumps([{"name": "f", "description": "d", "parameters": {"properties": {"x": {"type": "int", "enum": [1, 2]}}, "required": ["x"]}}])
    assert "  - x (int, required): , should be one of [1, 2]\n" in tool_formats.described(tools)
    assert '{"type": "function", "function": {"name": "f"' in tool_formats.described(tools, "tagged")
    assert tool_formats.extracted(tool_formats.written(f"<think>t</think>[{call}, {call}]")[len("<think>t</think>") :]) == [("f", '{"x": 1}')] * 2
    assert "<tool_call>" in templates.rendered(templates.template("qwen3"), [("user", "q"), ("function", call)])
    with pytest.raises(KeyError):
        templates.template("none")


def test_markup_template():
    call = lambda i, n: {"id": i, "type": "function", "function": {"name": n, "arguments": '{"x": "a", "y": 2}'}}
    said = [{"role": "user", "content": "q"}, {"role": "assistant", "content": "<think> t </think> a"}, {"role": "user", "content": "r"}, {"role": "assistant", "content": "b", "reasoning_content": "u"}]
    turns = markup_template.turns_of(said, "S", None)
    assert markup_template.rendered(turns) == ["S", "<｜User｜>q<｜Assistant｜></think>", "a<｜end▁of▁sentence｜>", "<｜User｜>r<｜Assistant｜><think>", "u</think>b<｜end▁of▁sentence｜>"]
    assert markup_template.rendered(turns, drop=False)[2] == "t</think>a<｜end▁of▁sentence｜>"
    assert markup_template.rendered(turns, thinking=False)[3] == "<｜User｜>r<｜Assistant｜></think>"
    assert markup_template.rendered(turns, effort="max")[0].startswith("Reasoning Effort")
    tools = json.dumps([{"type": "function", "function": {"name": "f"}}])
    used = [{"role": "user", "content": "q"}, {"role": "assistant", "content": None, "tool_calls": [call("1", "f"), call("2", "g")]}, {"role": "tool", "tool_call_id": "2", "content": "second"}, {"role": "tool", "tool_call_id": "1", "content": "first"}, {"role": "assistant", "content": "done"}]
    texts = markup_template.rendered(markup_template.turns_of(used, None, tools))
    assert "### Available Tool Schemas" in texts[0]
    assert '<｜DSML｜parameter name="y" string="false">2</｜DSML｜parameter>' in texts[2]
    assert texts[3].startswith("<｜User｜><tool_result>first</tool_result>\n\n<tool_result>second</tool_result>")
    pairs = markup_template.encoded_pairs(said, "S", None, handlers.ByteTokenizer())
    assert bytes(pairs[0][0]).decode().startswith("<｜begin▁of▁sentence｜>S<｜User｜>q")
    assert len(pairs) == 2
    with pytest.raises(ValueError, match="function tool"):
        markup_template.turns_of(said, None, '[{"name": "f"}]')
    with pytest.raises(ValueError, match="role"):
        markup_template.turns_of([{"role": "who", "content": ""}], None, None)
    assert markup_template.rendered(markup_template.turns_of([{"role": "user", "content": "q", "task": "title"}], None, None)) == ["<｜User｜>q<｜title｜>"]


def test_scores(spark):
    d = spark.createDataFrame([("a", True), ("a", False), ("b", None)], "g string, ok boolean")
    assert {x["g"]: (x["question_n"], x["acc"]) for x in evaluation.accuracy(d, "g", F.col("ok")).collect()} == {"a": (2, 0.5), "b": (1, 0.0), "total": (3, pytest.approx(1 / 3))}
    assert evaluation.accuracy(d.limit(0), "g", F.col("ok")).count() == 0
    p = spark.createDataFrame([("t", True), ("t", False), ("t", False), ("u", False), ("u", False), ("u", True)], "t string, ok boolean")
    got = {x["k"]: x["pass_at_k"] for x in evaluation.pass_at_k(p, "t", "ok", [1, 2, 5]).collect()}
    assert got == {1: pytest.approx(1 / 3), 2: pytest.approx(2 / 3)}
    loss = spark.createDataFrame([(1, "A", 2.0), (1, "B", 1.0), (1, "C", 1.0)], "q int, o string, l double")
    assert evaluation.least_loss(loss, "q", "o", "l").first()["o"] == "B"
    grid = evaluation.needle_grid(spark.createDataFrame([("f",)], "file string"), [10, 20], [0, 50], 3)
    assert grid.count() == 12
    assert evaluation.linear_depths(3) == [0.0, 50.0, 100.0]
    assert evaluation.logistic_depths(3)[0] == 0
    m = spark.createDataFrame([(1, 1.0), (2, 2.0)], "step int, v double")
    n = spark.createDataFrame([(1, 1.04), (3, 1.0)], "step int, v double")
    assert {x["step"]: x["ok"] for x in evaluation.within_margin(m, n, "step", "v", 0.05).collect()} == {1: True, 2: False, 3: False}
    for task, said, gold, ok in (("gsm8k", "it is 7", "so #### 7", True), ("bbh", "the answer is (B).", "(B)", True), ("boolq", "Yes, it is", "True", True), ("math", "\\boxed{1/2}", "\\frac{1}{2}", True), ("ceval", "C", "D", False), ("agieval", "AC", "AC", True)):
        one = spark.createDataFrame([(said, gold)], "a string, g string")
        assert evaluation.extracted(one, task, "a", "g").first()["correct"] is ok, task


def test_samples_with_null_or_short_labels_are_packed_and_cut(spark, tmp_path):
    from corpusloom.plans import token_queries

    rows = [(1, [1, 2, 3], [1, 2, 3]), (2, [4, 5, 6], None), (3, [7, 8, 9], [7, 8])]
    spark.createDataFrame(rows, "sample_id bigint, input_ids array<int>, labels array<int>").write.parquet(f"{tmp_path}/sft_tokens.parquet")
    assert sorted(tuple(r) for r in token_queries.token_cut_turns(spark, str(tmp_path)).collect()) == [(1, 3, 3), (2, 3, 3), (3, 3, 3)]
    for query in (token_queries.pack_knapsack, token_queries.pack_knapsack_batches):
        assert [(r["n_samples"], r["n_tokens"]) for r in query(spark, str(tmp_path)).collect()] == [(3, 9)]
