"""Queries on evaluation tasks: prompts, extraction through each task's own rules, scores, needles and joins of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.operators import evaluation, exam_prompts, ordinals
from corpusloom.plans.digests import listed, sql_listed
from corpusloom.session import table

NAMES = {"mmlu_like": "General knowledge", "gsm_like": "Sums", "agi_like": "Passages"}


def _items(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "eval_items")


def _by(n: int, values: list[str]) -> Column:
    """One of the values by the item's number."""
    out = F.lit(values[-1])
    for k, v in list(enumerate(values))[-2::-1]:
        out = F.when(F.col("item_id") % n == k, v).otherwise(out)
    return out


# What is said, by the item's number, and what each task's rules find in it.
SAID = {
    "mmlu": [("The answer is (B).", "B"), ("答案是：D", "D"), ("The correct answer is option: C", "C"), ("none of these", ""), ("Let me think.\n\nANSWER: A", "A"), ("选D", "D"), ("所以答 C", "C")],
    "cmmlu": [("The answer is (B).", "B"), ("答案是：D", "D"), ("ANSWER: A x", "A"), ("none of these", ""), ("故选 C", "C"), ("C 是正确答案", "C"), ("Answer:\nB", "B")],
    "ceval": [("C", "C"), (" it is B", "B"), ("no", None), ("答案 D", "D"), ("", None), ("éÉ", "É"), ("x1Y", "Y")],
    "boolq": [("Yes", "A"), ("No", "B"), ("True", "A"), ("False", "B"), ("A. Yes", "A"), ("perhaps", None), ("B", "B")],
    "agieval": [("(B) is it\nC", "B is it"), ("$3$", "3"), ("A", "A"), (" AC", "AC"), ("", ""), ("x $ y", "x  y"), ("\n\nD", "D")],
    "agieval_single": [("The answer is **B**", "B"), ("答案选项为 (C)", "C"), ("The answer is D", "D"), ("", ""), ("ANSWER : A", "A"), ("故选B", "B"), ("The correct option is: $\\boxed{C}$", "C")],
    "agieval_multiple": [("AC", "AC"), ("It is BD.", "BD"), ("x", ""), ("The A", "A"), ("", ""), ("ABCD", "ABCD"), ("D, A", "D")],
    "agieval_cloze": [("so \\boxed{x = 7}", "7"), ("it is $x^2$ here", "x^2"), ("y = 12.", "12"), ("5 apples and 6 pears", "6"), ("1. The answer is therefore 42", "42"), ("none", None), ("\\boxed{\\frac{1}{2}} and \\boxed 3", None)],
    "gsm8k": [("so 3 and -4.5", "-4.5"), ("7 Question: 8", "7"), ("none", "NULL"), ("a 12", "12"), ("", "NULL"), ("1,000", "000"), ("it is 0.5.", "0.5")],
    "gsm8k_default": [("The answer is 12.", "12"), ("The answer is $1,000. Q: x", "1000"), ("none", None), ("The answer is 3", "3"), ("Q: The answer is 4", None), ("  The answer is 5.5", "5"), ("The answer is 8 or 9", "8")],
    "bbh": [("the answer is (B).", "(B)"), ("so C", "(C)"), ("the answer is (A", "(A)"), ("x", "(x)"), ("answer is D answer is E", "(D)"), ("(F) or (G)", "(F)"), ("", "()")],
    "bbh_default": [("(B) because", "B"), ("blue.", "C"), ("red\nblue", "A"), ("x (y) z", "y"), ("", ""), ("green, and", "green, and"), ("A", "A")],
    "bbh_judged": [("Yes, it is", "Yes"), ("that is false.", "false"), ("(invalid)", "invalid"), ("none", "none"), ("", ""), ("not True", "True"), ("No. Yes", "No")],
}
_QUESTION = "Which? (A) red (B) green (C) blue"


def exam_extraction(spark: SparkSession, root: str) -> DataFrame:
    """STR-11 to STR-22, STR-30, EVL-01, EVL-03 to EVL-09, EVL-12: what each task's rules find, and whether it is right."""
    out = None
    for task, cases in SAID.items():
        golds = {"bbh": "(B)", "boolq": "True", "gsm8k": "so #### 12", "gsm8k_default": "so #### 12", "bbh_judged": "Yes", "agieval_cloze": "7"}
        rows = _items(spark, root).select("item_id", F.lit(task).alias("task"), _by(len(cases), [a for a, _ in cases]).alias("said"), F.lit(golds.get(task, "B")).alias("gold"), F.lit(_QUESTION).alias("asked"), F.lit("ABCD").alias("letters"))
        found = evaluation.extracted(rows, task, "said", "gold", "asked", "letters").select("task", "item_id", "extracted", "correct")
        out = found if out is None else out.unionByName(found)
    return out


def exam_accuracy(spark: SparkSession, root: str) -> DataFrame:
    """AGG-07, AGG-08, EVL-01, EVL-09: shares of right answers by task and in all."""
    items = _items(spark, root).where("answer IS NOT NULL")
    said = _by(3, ["The answer is (B).", "答案是：D", "I choose C"])
    return evaluation.scored(items.withColumn("said", said), "hellaswag", "task", "said", "answer")


def _support(spark: SparkSession, root: str) -> DataFrame:
    return ordinals.support_set(_items(spark, root), "task", "item_id", 2, 5)


def exam_prompt_texts(spark: SparkSession, root: str) -> DataFrame:
    """STR-28, JOI-04, JOI-05, EVL-02: questions behind worked examples, in every style."""
    out = None
    for style in exam_prompts.STYLES:
        made = exam_prompts.prompts(_items(spark, root), _support(spark, root), style, "item_id", "task", "question", ("a", "b", "c", "d")).select(F.lit(style).alias("style"), "item_id", F.md5("prompt").alias("prompt"))
        out = made if out is None else out.unionByName(made)
    return out


def passage_prompt_texts(spark: SparkSession, root: str) -> DataFrame:
    """STR-29, EVL-08: passages with their questions and options."""
    options = F.filter(F.array("a", "b", "c", "d"), lambda x: x.isNotNull())
    lead = F.concat(F.lit("About "), F.col("task"))
    return _items(spark, root).select("item_id", exam_prompts.passage_prompt(lead, F.col("passage"), F.col("question"), options).alias("prompt"), exam_prompts.passage_question(F.col("passage"), F.col("question")).alias("asked"), exam_prompts.gold_of(F.col("answer"), F.col("a")).alias("gold"), exam_prompts.letters_of(options).alias("letters"))


def subjects_allowed(spark: SparkSession, root: str) -> DataFrame:
    """FIL-10, JOI-06: questions of subjects that have a template, with display names."""
    known = spark.createDataFrame([("mmlu_like",), ("gsm_like",), ("none_like",)], "task string")
    return exam_prompts.display_names(exam_prompts.allowed(_items(spark, root).select("item_id", "task"), known, "task"), NAMES, "task")


def first_questions(spark: SparkSession, root: str) -> DataFrame:
    """LIM-02: the first questions of each task."""
    return ordinals.head_of_groups(_items(spark, root).select("task", "item_id"), "task", "item_id", 7)


def first_documents(spark: SparkSession, root: str) -> DataFrame:
    """LIM-01, SRC-19: the first rows by number."""
    from corpusloom.sources import files

    return files.head(table(spark, root, "documents").select("doc_id", "lang"), 100, ["doc_id"])


def predictions_joined(spark: SparkSession, root: str) -> DataFrame:
    """JOI-07, JOI-08: completions beside their problems, by task and position."""
    items = _items(spark, root)
    said = items.select("item_id", _by(4, ["A", "B", "C", "D"]).alias("said"))
    return evaluation.joined_by_position(said, items.select("item_id", "answer"), "item_id").select("item_id", "said", "answer", F.coalesce(F.col("said") == F.col("answer"), F.lit(False)).alias("correct"))


def metrics_within(spark: SparkSession, root: str) -> DataFrame:
    """JOI-14: a metric and its expected value by step, with a relative margin."""
    e = table(spark, root, "events").select("event_id", "value")
    return evaluation.within_margin(e, e.withColumn("value", F.col("value") * F.when(F.col("event_id") % 3 == 0, 1.1).otherwise(1.01)), "event_id", "value", 0.05).select("event_id", "expected", F.round("actual", 9).alias("actual"), "ok")


def loss_means(spark: SparkSession, root: str) -> DataFrame:
    """AGG-09: mean loss over the tokens that are trained, sample by sample."""
    rows = table(spark, root, "sft_tokens").where("labels IS NOT NULL").select("sample_id", F.explode(F.arrays_zip(F.col("input_ids").alias("x"), F.col("labels").alias("y"))).alias("t")).select("sample_id", F.col("t.x").cast("double").alias("loss"), F.col("t.y").alias("label"))
    return evaluation.token_losses(rows, ["sample_id"], "loss", "label").select("sample_id", F.round("mean_loss", 6).alias("mean_loss"))


def option_of_least_loss(spark: SparkSession, root: str) -> DataFrame:
    """AGG-10, EVL-02, EVL-07: of four options, the mean of whose losses are all values of a vector, the least, the first of equal ones."""
    rows = table(spark, root, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "loss"))
    named = rows.select("vec_id", F.element_at(F.array(*map(F.lit, "ABCD")), F.col("i") % 4 + 1).alias("option"), F.col("loss").cast("decimal(20,12)").alias("loss"))
    return evaluation.least_loss(named, "vec_id", "option", "loss")


# needles


def _needles(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", "lang", "text")


def needle_grid(spark: SparkSession, root: str) -> DataFrame:
    """JOI-12: every item at every length, depth and repetition."""
    return evaluation.needle_grid(_items(spark, root).select("item_id"), [1000, 2000], evaluation.logistic_depths(5), 2)


def needle_inserted(spark: SparkSession, root: str) -> DataFrame:
    """STR-27: a needle put into tokens at a depth."""
    tokens = table(spark, root, "sft_tokens").select("sample_id", F.coalesce("input_ids", F.array().cast("array<int>")).alias("x"))
    return tokens.select("sample_id", listed(text.insert_at_depth(F.col("x"), F.array(F.lit(-7), F.lit(-8)), (F.col("sample_id") % 11) * 10)).alias("tokens"))


def needle_choices(spark: SparkSession, root: str) -> DataFrame:
    """SMP-02, FIL-11: for each counter one document of a language."""
    return ordinals.seeded_choices(_needles(spark, root).where("lang = 'de'"), "doc_id", 12)


def needle_line_orders(spark: SparkSession, root: str) -> DataFrame:
    """SMP-02, SMP-05, SHF-03: all lines shuffled by a counter."""
    return ordinals.shuffled(_needles(spark, root).select("doc_id"), "doc_id", 3)


def needle_means(spark: SparkSession, root: str) -> DataFrame:
    """STR-24 to STR-26, AGG-22, EVL-11: mean score by task, predictions cut near their reference."""
    items = _items(spark, root).where("passage IS NOT NULL")
    score = text.trimmed_needle_score(F.col("question"), F.col("passage"), F.coalesce("a", F.lit("#")))
    return items.groupBy("task").agg(F.count("*").alias("n"), F.round(F.avg(score) * 100, 6).alias("score"))


def trimmed_predictions(spark: SparkSession, root: str) -> DataFrame:
    """STR-25."""
    return _items(spark, root).where("passage IS NOT NULL").select("item_id", text.trim_prediction(F.col("passage"), F.col("question")).alias("cut"))


def depths(spark: SparkSession, root: str) -> DataFrame:
    """MTH-01: depths of two spacings."""
    rows = [("logistic", i, float(d)) for i, d in enumerate(evaluation.logistic_depths(20))] + [("linear", i, float(d)) for i, d in enumerate(evaluation.linear_depths(20))]
    return spark.createDataFrame(rows, "spacing string, i int, depth double")


QUERIES = {f.__name__: f for f in (exam_extraction, exam_accuracy, exam_prompt_texts, passage_prompt_texts, subjects_allowed, first_questions, first_documents, predictions_joined, metrics_within, loss_means, option_of_least_loss, needle_grid, needle_inserted, needle_choices, needle_line_orders, needle_means, trimmed_predictions, depths)}

_q = lambda x: "NULL" if x is None else "'" + x.replace("'", "''") + "'"


def _extraction() -> str:
    right = {"bbh": "(B)", "boolq": "A", "gsm8k": "12", "gsm8k_default": "12", "bbh_judged": "Yes", "agieval_cloze": "7"}
    parts = []
    for task, cases in SAID.items():
        found = "CASE item_id % 7 " + " ".join(f"WHEN {k} THEN {_q(v)}" for k, (_, v) in enumerate(cases)) + " END"
        parts.append(f"SELECT {_q(task)} AS task, item_id, {found} AS extracted, COALESCE({found} = {_q(right.get(task, 'B'))}, FALSE) AS correct FROM eval_items")
    return " UNION ALL ".join(parts)


def _styles() -> str:
    parts = []
    for name, s in exam_prompts.STYLES.items():
        subject = "replace(COALESCE(task, ''), '_', ' ')" if s.spaced else "COALESCE(task, '')"
        said = lambda t, subject=subject: f"replace({_q(t)}, '{{subject}}', {subject})".replace("\n", "' || chr(10) || '")
        asked = f"{said(s.lead)} || COALESCE(question, '') || array_to_string(list_filter(['\n' || 'A. ' || a, '\n' || 'B. ' || b, '\n' || 'C. ' || c, '\n' || 'D. ' || d], lambda x: x IS NOT NULL), '') || {said(s.answer)}"
        parts.append(f"""SELECT {_q(name)} AS style, i.item_id, md5({said(s.head)} || COALESCE(h.shots, '') || {asked}) AS prompt FROM eval_items i
            LEFT JOIN (SELECT task AS of_task, string_agg({asked} || {said(s.joint)} || COALESCE(answer, '') || {said(s.gap)}, '' ORDER BY k) AS shots FROM ranked WHERE k <= 2 GROUP BY task) h ON i.task IS NOT DISTINCT FROM h.of_task""")
    return "WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY md5(concat_ws('-', '5', item_id)), item_id) AS k FROM eval_items) " + " UNION ALL ".join(parts)


_A, _B = r"regexp_replace(question, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', '', 'g')", r"regexp_replace(passage, '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', '', 'g')"
_CUT = lambda p, r: f"CASE WHEN length({r}) > 0 AND instr(substr(substr({p}, 1, CAST(floor(length({r}) * 1.2) AS INT)), CAST(floor(length({r}) * 0.8) AS INT) + 1), right({r}, 1)) > 0 THEN substr({p}, 1, CAST(floor(length({r}) * 0.8) AS INT) + instr(substr(substr({p}, 1, CAST(floor(length({r}) * 1.2) AS INT)), CAST(floor(length({r}) * 0.8) AS INT) + 1), right({r}, 1))) ELSE substr({p}, 1, CAST(floor(length({r}) * 1.2) AS INT)) END"

SQL = {
    "exam_extraction": _extraction(),
    "exam_accuracy": "SELECT CASE WHEN GROUPING(task) = 1 THEN 'total' ELSE task END AS task, COUNT(*) AS question_n, AVG(CASE WHEN answer = CASE item_id % 3 WHEN 0 THEN 'B' WHEN 1 THEN 'D' ELSE 'C' END THEN 1 ELSE 0 END) AS acc FROM eval_items WHERE answer IS NOT NULL GROUP BY ROLLUP (task)",
    "exam_prompt_texts": _styles(),
    "passage_prompt_texts": """WITH e AS (SELECT *, list_filter([a, b, c, d], lambda x: x IS NOT NULL) AS o FROM eval_items)
        SELECT item_id, 'About ' || task || chr(10) || COALESCE(passage, '') || COALESCE(question, '') || CASE WHEN len(o) > 0 THEN chr(10) || trim(array_to_string(o, chr(10))) ELSE '' END || chr(10) || 'The answer is ' AS prompt,
        CASE WHEN COALESCE(passage, '') <> '' THEN passage || chr(10) || question ELSE question END AS asked, COALESCE(NULLIF(answer, ''), replace(NULLIF(a, ''), '$', '')) AS gold, CASE WHEN len(o) > 0 THEN substr('ABCD', 1, len(o)) END AS letters FROM e""",
    "subjects_allowed": "SELECT item_id, task, CASE task WHEN 'mmlu_like' THEN 'General knowledge' ELSE 'Sums' END AS name FROM eval_items WHERE task IN ('mmlu_like', 'gsm_like')",
    "first_questions": "SELECT task, item_id, CAST(rank AS INT) AS rank FROM (SELECT task, item_id, row_number() OVER (PARTITION BY task ORDER BY item_id) AS rank FROM eval_items) WHERE rank <= 7",
    "first_documents": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100",
    "predictions_joined": "SELECT item_id, said, answer, COALESCE(said = answer, FALSE) AS correct FROM (SELECT item_id, answer, substr('ABCD', CAST(item_id % 4 AS INT) + 1, 1) AS said FROM eval_items)",
    "metrics_within": "SELECT event_id, value AS expected, round(v, 9) AS actual, COALESCE(abs(v - value) <= CAST(0.05 AS DOUBLE) * abs(value), FALSE) AS ok FROM (SELECT event_id, value, value * CASE WHEN event_id % 3 = 0 THEN CAST(1.1 AS DOUBLE) ELSE CAST(1.01 AS DOUBLE) END AS v FROM events)",
    "loss_means": "SELECT sample_id, round(AVG(CAST(x AS DOUBLE)), 6) AS mean_loss FROM (SELECT sample_id, unnest(input_ids) AS x, unnest(labels) AS y FROM sft_tokens WHERE labels IS NOT NULL) WHERE y <> -100 AND x IS NOT NULL GROUP BY sample_id",
    "option_of_least_loss": "WITH r AS (SELECT vec_id, unnest(range(0, len(embedding))) % 4 AS o, CAST(CAST(unnest(embedding) AS DOUBLE) AS DECIMAL(20, 12)) AS loss FROM embeddings), m AS (SELECT vec_id, o, SUM(loss) / COUNT(*) AS m FROM r GROUP BY vec_id, o) SELECT vec_id, substr('ABCD', CAST(arg_min(o, (m, o)) AS INT) + 1, 1) AS option FROM m GROUP BY vec_id",
    "needle_grid": "SELECT item_id, CAST(l AS INT) AS length, CAST(deep AS DOUBLE) AS depth, CAST(r AS INT) AS repeat FROM (SELECT item_id FROM eval_items), (SELECT unnest([1000, 2000]) AS l), (SELECT unnest([0.0, 7.586, 50.0, 92.414, 100.0]) AS deep), (SELECT unnest([0, 1]) AS r)",
    "needle_inserted": f"WITH t AS (SELECT sample_id, COALESCE(input_ids, []) AS x, CAST(floor(len(COALESCE(input_ids, [])) * ((sample_id % 11) * 10) / 100.0) AS BIGINT) AS k FROM sft_tokens) SELECT sample_id, {sql_listed('list_concat(x[1:k], [-7, -8], x[k + 1:])')} AS tokens FROM t",
    "needle_choices": "SELECT CAST(c AS INT) AS counter, arg_min(doc_id, md5(concat_ws('-', c, doc_id))) AS doc_id FROM documents, (SELECT unnest(range(0, 12)) AS c) WHERE lang = 'de' GROUP BY c",
    "needle_line_orders": "SELECT doc_id, row_number() OVER (ORDER BY md5(concat_ws('-', '3', doc_id)), doc_id) - 1 AS pos FROM documents",
    "needle_means": f"""WITH s AS (SELECT task, question, COALESCE(a, '#') AS w, {_A} AS p, {_B} AS r FROM eval_items WHERE passage IS NOT NULL), c AS (SELECT *, {_CUT('p', 'r')} AS cut FROM s)
        SELECT task, COUNT(*) AS n, round(AVG(CASE WHEN contains(question, w) THEN 1.0 WHEN GREATEST(length(cut), length(r)) = 0 THEN 0.2 ELSE CAST(0.2 AS DOUBLE) * (1 - CAST(levenshtein(cut, r) AS DOUBLE) / GREATEST(length(cut), length(r))) END) * 100, 6) AS score FROM c GROUP BY task""",
    "trimmed_predictions": f"SELECT item_id, {_CUT('passage', 'question')} AS cut FROM eval_items WHERE passage IS NOT NULL",
    "depths": """SELECT 'linear' AS spacing, CAST(i AS INT) AS i, round(CAST(100 AS DOUBLE) * i / 19, 3) AS depth FROM (SELECT unnest(range(0, 20)) AS i)
        UNION ALL SELECT 'logistic', CAST(i AS INT), CASE WHEN i IN (0, 19) THEN CAST(100 AS DOUBLE) * i / 19 ELSE round(100 / (1 + exp(CAST(-0.1 AS DOUBLE) * (CAST(100 AS DOUBLE) * i / 19 - 50))), 3) END FROM (SELECT unnest(range(0, 20)) AS i)""",
}
