import random

import pytest

from corpusloom.llm import pairs

LONG = "The index is rebuilt for each epoch because the weights are not kept. That takes a while on a single node."


@pytest.mark.parametrize(
    ("prompt", "answer", "found"),
    [
        ("Why is the sky blue?", None, "empty"),
        ("Why is the sky blue?", "", "empty"),
        ("Why is the sky blue?", " ​\n", "empty"),
        ("Why is the sky blue?", "...", "empty"),
        ("Why is the sky blue?", "N/A", "empty"),
        ("Why is the sky blue?", "<p></p>", "empty"),
        ("Why is the sky blue?", "<think>\n\n</think>\n\n", "empty"),
        ("Why is the sky blue?", "None", "empty"),
        ("How many lines are left?", "None", None),
        ("How many lines are left?", "0", None),
        ("Option A is 3, option B is 4. Which is larger?", "B", None),
        ("Is it so? Yes or no.", "no", None),
        ("Why is the sky blue?", LONG, None),
        ("Why is the sky blue?", LONG[:60], "truncated"),
        ("Why is the sky blue?", LONG + " (That is", "truncated"),
        ("Why is the sky blue?", LONG + " 🙂", None),
        ("Why is the sky blue?", LONG + "\n\n-- end", None),
        ("Name three parts.", "- the index\n- the tokenizer\n- the cache", None),
        ("Name three parts.", "1. The index is rebuilt for each epoch.\n2. The tokenizer is kept as it is.\n3. The cache is dropped as", "truncated"),
        ("Write some code.", "Here it is.\n```python\nx = [1, 2]\n```", None),
        ("Write some code.", "Here it is.\n```python\nx = [1,", "truncated"),
        ("Print the checksum.", "ab12" * 30, None),
        ("Why is the sky blue?", "I'm sorry, but I can't help with that. Is there anything else I can do?", "refusal"),
        ("Why is the sky blue?", "Sorry for the confusion earlier, here is the full picture. " + LONG, None),
        ("Warum ist der Himmel blau?", "Leider kann ich diese Frage nicht beantworten.", "refusal"),
        ("Pourquoi le ciel est-il bleu ?", "Mes consignes m'interdisent de répondre ici. Puis-je vous aider autrement ?", "refusal"),
        ("¿Por qué es azul el cielo?", "Lo siento, pero no puedo ayudar con eso.", "refusal"),
        ("Compare the two models for work on soil chemistry, please.", "Compare the two models for work on soil chemistry please", "copy"),
        ("Compare the two models for work on soil chemistry, please.", "You asked: Compare the two models for work on soil chemistry, please.", "copy"),
        ("Compare the two models for work on soil chemistry, please.", "> Compare the two models for work on soil chemistry, please.\n\n" + LONG, None),
        ("Repeat this sentence word for word: The index is rebuilt for each epoch.", "The index is rebuilt for each epoch.", None),
        ("Explain why the index is rebuilt.", "Das bedeutet, dass die Daten nicht ohne Prüfung gespeichert werden sollten, weil der Index neu entsteht.", "language"),
        ("Explain why the index is rebuilt. Please answer in German.", "Das bedeutet, dass die Daten nicht ohne Prüfung gespeichert werden sollten, weil der Index neu entsteht.", None),
        ("Explain why the index is rebuilt.", "In short: 这说明重复记录在保存之前需要检查。在大多数实验中，数据加载器会减少小文件。", "language"),
        ("Traduce al francés: los modelos son lentos.", "Les modèles sont lents et ils ne sont pas à jour.", None),
        (None, LONG, None),
        (None, None, "empty"),
    ],
)
def test_defects(prompt, answer, found):
    assert pairs.defect(prompt, answer) == found


def test_automaton_covers_as_brute_force():
    r = random.Random(1)
    for _ in range(300):
        a = [r.choice("abc") for _ in range(r.randint(0, 14))]
        b = [r.choice("abc") for _ in range(r.randint(1, 14))]
        least = r.randint(1, 4)
        runs = {tuple(a[i:j]) for i in range(len(a)) for j in range(i + least, len(a) + 1)}
        covered = set()
        for i in range(len(b)):
            for j in range(i + least, len(b) + 1):
                if tuple(b[i:j]) in runs:
                    covered |= set(range(i, j))
        assert pairs.SuffixAutomaton(a).covered(b, least) == pytest.approx(len(covered) / len(b))


def test_automaton_of_a_very_long_text():
    words = [str(i % 977) for i in range(60_000)]
    assert pairs.SuffixAutomaton(words).covered(words, 3) == 1.0


def test_rows(spark):
    turn = "array<struct<role:string,content:string>>"
    rows = [
        (1, [("user", "q?")], None, "x"),
        (1, [("user", "q?")], [], "x"),
        (2, None, [("assistant", LONG)], "x"),
        (3, [], [("assistant", None)], "x"),
        (4, [("user", "old"), ("assistant", "old"), ("user", "Why?")], [("assistant", LONG)], "x"),
        (None, [("user", "q?")], [("assistant", "")], "x"),
        (5, [("user", "q?")], [("assistant", "word " * 200_000)], "x"),
    ]
    d = spark.createDataFrame(rows, f"example_id bigint, _prompt {turn}, _response {turn}, defect string")
    got = sorted(((x["example_id"], x["defect"]) for x in pairs.broken_pairs(d).collect()), key=str)
    assert got == sorted([(1, "empty"), (1, "empty"), (3, "empty"), (None, "empty"), (5, "truncated")], key=str)
    assert pairs.broken_pairs(d.limit(0)).count() == 0


def test_a_refusal_of_any_length_is_one():
    decline = "I'm sorry, but I can't help with that. Is there anything else I can do? "
    assert pairs.defect("Why is the sky blue?", decline * 40) == "refusal"
    assert pairs.defect("Why is the sky blue?", decline * 40 + LONG) is None
    plea = "I'm sorry, but I can't help with requests that ask me to set out in every detail and for each of the many people who may come to read it later on how the colours of the sky at noon and at dusk and at dawn come about."
    assert pairs.defect("Why is the sky blue?", plea) == "refusal"
    assert pairs.defect("Why is the sky blue?", "I can't say it in one word, but the light of the sun meets the many small parts of the air, and the blue part of it is sent to all sides far more than the red part of it is, which we see above us.") is None
    assert pairs.defect("What may guests do?", "Guests are not allowed to:\n" + "- open the gate.\n" * 100) is None


@pytest.mark.parametrize(
    ("answer", "found"),
    [
        ('{\n "a": 1,\n "b": 2', "truncated"),
        ('{\n "a": [1, 2]', "truncated"),
        ('{\n "a": [1, 2]\n}', None),
        ('{\n "a": "an [open bracket",\n "b": ":("\n}', None),
        ("x = make(\n    1,\n    n=2)\ny = run(\n    x", "truncated"),
        ("def f(x):\n    y = g(x)\n    return h(\n        y)", None),
        ("It is fine :(\nand stays so.", None),
        ("a) the index (old\nb) the cache, new.", None),
    ],
)
def test_brackets_of_code_are_open_over_lines(answer, found):
    assert pairs.defect("Write it down as code, please.", answer) == found
