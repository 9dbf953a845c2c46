import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import arrays, extraction, records, text, tokenizers


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()["y"]


def test_strip_and_doi(spark):
    values = [None, "", " \t ", "\x1c doi: 10.1/X  ", "https://doi.org/ 10.1/A", "http://dx.doi.org/doi:10.1/b", "10.5/É", "\x85a\x85"]

    def doi(v):
        if v is None:
            return None
        v = v.strip().lower()
        for p in text.DOI_PREFIXES:
            if v.startswith(p):
                v = v[len(p) :].strip()
                break
        return v or None

    for v in values:
        assert one(spark, v, text.normalize_doi) == doi(v)
        assert one(spark, v, text.strip) == (None if v is None else v.strip())


def test_normalize_text(spark):
    for v in [None, "", " \r\n", "a\r\nb\rc\x00", "é", "x\n..\n..\n..", "  ñ  "]:
        want = None if v is None else unicodedata.normalize("NFC", v).replace("\x00", "").replace("\r\n", "\n").replace("\r", "\n").replace("\n..\n..\n..", "").strip() or None
        assert one(spark, v, text.normalize_text) == want


def test_answers_as_columns(spark):
    assert one(spark, "so 3 and -4.5 Question: 7", text.last_number) == "-4.5"
    assert one(spark, "none", text.last_number) == "NULL"
    assert one(spark, "a #### 1 #### 42", text.gold_number) == "42"
    assert one(spark, "the answer is (B).", text.choice_in_brackets) == "B"
    assert one(spark, "the answer is **no way**.", text.free_answer) == "no way"
    assert one(spark, "answer is yes.\nmore", text.free_answer) == "yes"
    assert one(spark, "mmlu/abc_test.csv", text.subject_of_file) == "abc"
    assert one(spark, "a\n```py\nx = 1\n```\nb", text.fenced_code) == "x = 1\n"
    assert one(spark, None, text.fenced_code) is None
    assert one(spark, "Yes", text.answer_alias) == "A"


def test_needle_score(spark):
    d = spark.createDataFrame([("the key is here", "other", "key"), ("abcd", "abcf", "zzz"), ("", "", "k")], "p string, r string, k string")
    got = [x[0] for x in d.select(text.needle_score(F.col("p"), F.col("r"), F.col("k"))).collect()]
    assert got == [1.0, pytest.approx(0.2 * 0.75), 0.2]


def test_array_functions_against_loops(spark):
    r, end, pad = random.Random(5), 9, 8
    rows = [[r.choice([1, 2, 3, end, pad]) for _ in range(r.randint(0, 12))] for _ in range(60)]
    d = spark.createDataFrame([(x,) for x in rows], "x array<int>")
    got = d.select("x", arrays.segments(F.col("x"), end).alias("s"), arrays.positions_after_end(F.col("x"), end).alias("p"), arrays.sequence_ends(F.col("x"), end).alias("e"), arrays.pad_to_multiple(F.col("x"), 4, 0).alias("m"), arrays.span_labels(F.col("x"), 1, 2).alias("l")).collect()
    for g in got:
        x = list(g["x"])
        seg, pos, s, p = [], [], 0, 0
        for t in x:
            seg.append(s)
            pos.append(p)
            s, p = (s + 1, 0) if t == end else (s, p + 1)
        assert (g["s"], g["p"]) == (seg, pos)
        ends = [i + 1 for i, t in enumerate(x) if t == end]
        assert g["e"] == (ends if not x or x[-1] == end else [*ends, len(x)])
        assert len(g["m"]) == (len(x) // 4 + 1) * 4
        labels = [-100] * len(x)
        for a, b in zip([i for i, t in enumerate(x) if t == 1], [i for i, t in enumerate(x) if t == 2], strict=False):
            labels[a : b + 1] = x[a : b + 1]
        assert g["l"] == labels


def test_prompt_runs_and_cut_lengths(spark):
    assert [tuple(x) for x in one(spark, [-100, -100, 5, -100, 6, -100], arrays.prompt_runs, "array<int>")] == [(0, 2), (3, 4), (5, None)]
    assert one(spark, [], arrays.prompt_runs, "array<int>") == []
    from corpusloom.operators.templates import inferred_lengths

    cases = [(a, b, c) for a in (0, 1, 7, 30, 99) for b in (0, 2, 15, 80) for c in (1, 10, 64)]
    d = spark.createDataFrame(cases, "a int, b int, c int")
    s, t = arrays.inferred_lengths(F.col("a"), F.col("b"), F.col("c"))
    for (a, b, c), got in zip(cases, d.select(s, t).collect(), strict=True):
        assert tuple(got) == inferred_lengths(a, b, c)


def test_masks_and_positions(spark):
    assert one(spark, [1, 1, 2, 2, 2, 0, 0], arrays.packed_positions, "array<int>") == [0, 1, 0, 1, 2, 0, 0]
    assert one(spark, [0, 1, 0, 1, 2], arrays.ends_from_positions, "array<int>") == [2, 5]
    assert one(spark, [3, 4, 0, 1], arrays.regenerated_positions, "array<int>") == [0, 1, 0, 1]
    assert one(spark, [2, 5], lambda c: arrays.attention_load(c, 5), "array<int>") == pytest.approx(0.5 * (4 + 9) / 25)
    assert one(spark, [1, 2], lambda c: arrays.loss_mask(c, 2), "array<int>") == [1, 0]


@pytest.mark.parametrize(
    ("line", "kind"),
    [(None, "empty"), ("  ", "empty"), ("{", "malformed"), ('{"a":1} x', "malformed"), ("[1]", "other"), ("3", "other"), ("{}", "object"), ('{"a": NaN}', "object"), ('{"a":1,"a":2}', "object")],
)
def test_line_classes(line, kind):
    assert records.parse(line)[0] == kind


def test_records():
    assert records.parse('{"a": NaN}', strict=True)[0] == "malformed"
    assert records.raw_identifier({"doi": "", "externalIds": {"DOI": "10.1/x"}}) == "10.1/x"
    assert records.raw_identifier({"doi": 7}) == "7"
    assert records.raw_identifier({"externalids": "x"}) is None
    assert records.has_body({"fullText": []})
    assert not records.has_body({"fullText": " ", "content": {"text": None}})
    assert records.has_body({"content": {"text": 0}})


def test_options_and_formulas():
    assert extraction.option("B is right", "B") == "B"
    assert extraction.option("I think so. The answer is C", "A") == "C"
    assert extraction.option("", "A") == ""
    assert extraction.option(None) == ""
    assert extraction.option("答案是：D", "A") == "D"
    assert extraction.math_answer("thus \\boxed{x = \\frac{1}{2}}") == "\\frac{1}{2}"
    assert extraction.math_answer("cost is $3 = 4$") == "4"
    assert extraction.math_answer(None) is None
    assert extraction.same_formula("1/2", "\\dfrac{1}{2}")
    assert extraction.task_answer("Yes. because", judged=True) == "Yes"


def test_tokenizers():
    t = tokenizers.ByteTokenizer()
    assert t.decode(t.encode("é🙂")) == "é🙂"
    assert tokenizers.single_token(t, "a") == 97
    with pytest.raises(ValueError, match="tokens"):
        tokenizers.single_token(t, "ab")
    assert tokenizers.padded_vocabulary(129) == 256
