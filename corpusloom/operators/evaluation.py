"""Scores of existing predictions: accuracy by group and in all, options of least loss, pass@k, preferences, distributions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import extraction, text


def accuracy(df: DataFrame, group: str, correct: Column, total: str = "total") -> DataFrame:
    """(group, question_n, acc) and a row for all, the share of all rows. A null ``correct`` counts as wrong."""
    ok = F.coalesce(correct, F.lit(False)).cast("int")
    return (
        df.withColumn("_ok", ok).rollup(group).agg(F.count("*").alias("question_n"), F.avg("_ok").alias("acc"), F.grouping_id().alias("_gid"))
        .where((F.col("_gid") == 0) | (F.col("question_n") > 0))
        .withColumn(group, F.when(F.col("_gid") == 1, total).otherwise(F.col(group)))
        .drop("_gid")
    )


def least_loss(losses: DataFrame, question: str, option: str, loss: str) -> DataFrame:
    """(question, option): the option of least mean loss, of equal ones the first."""
    means = losses.groupBy(question, option).agg(F.avg(loss).alias("_m"))
    return means.groupBy(question).agg(F.min_by(option, F.struct("_m", option)).alias(option))


def token_losses(losses: DataFrame, keys: list[str], loss: str, label: str, ignored: int = -100) -> DataFrame:
    """Mean loss of the tokens that aren't padding."""
    return losses.where(F.col(label) != ignored).groupBy(*keys).agg(F.avg(loss).alias("mean_loss"))


def pass_at_k(results: DataFrame, task: str, passed: str, ks: list[int]) -> DataFrame:
    """(k, pass_at_k): the unbiased estimate, averaged over tasks, for each k that every task has samples for."""
    per = results.groupBy(task).agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col(passed), F.lit(False))).alias("c"))
    wrong = F.col("n") - F.col("c")
    every = per.select(F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"), "n", "c")
    # the same product with as many factors as k: those of c right answers cancel but for k of them
    missed = F.aggregate(F.sequence(F.lit(0), F.col("k") - 1), F.lit(1.0), lambda a, i: a * (wrong - i) / (F.col("n") - i))
    estimate = F.when(wrong < F.col("k"), 1.0).otherwise(F.when(F.col("c") == 0, 0.0).otherwise(1 - missed))
    scored = every.withColumn("e", estimate).groupBy("k").agg(F.avg("e").alias("pass_at_k"), F.min("n").alias("least"))
    return scored.where(F.col("least") >= F.col("k")).drop("least")


def preference(df: DataFrame, chosen: str, rejected: str) -> DataFrame:
    """Mean rewards, mean margin and the share of pairs in which the chosen one is preferred."""
    a, b = F.col(chosen), F.col(rejected)
    return df.agg(F.avg(a).alias("chosen_reward"), F.avg(b).alias("rejected_reward"), F.avg(a - b).alias("margin"), F.avg((a > b).cast("int")).alias("preferred"))


def distribution(df: DataFrame, value: str, at: tuple[float, ...] = (0.5, 0.9, 0.99, 0.999)) -> DataFrame:
    """One row: count, zeros, mean, greatest value and percentiles, which are members of the sorted values, zeros among them.

    Percentiles come from ranks: values with their counts are range-sorted and summed partition by partition, so no task sees all of
    them, whatever their number. Null values don't count; without any, all but the counts is null.
    """
    from corpusloom.operators.ordinals import with_prefix

    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    placed = with_prefix(counts, ["_v"], F.col("_c"), "_b")
    n = placed.agg(F.sum("_c")).first()[0] or 0
    v, c = F.col("_v"), F.col("_c")
    pick = lambda p: F.max(F.when((F.col("_b") < max(math.ceil(n * p), 1)) & (F.col("_b") + c >= max(math.ceil(n * p), 1)), v))
    total = [F.coalesce(F.sum(c), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(v == 0, c)), F.lit(0)).alias("zeros"), (F.sum(v * c) / F.sum(c)).alias("mean"), F.max(v).alias("most")]
    return placed.agg(*total, *[pick(p).alias(f"p{str(p)[2:]}") for p in at])


def warm_mean(df: DataFrame, step: str, value: str, warm_up: int, drop_most: bool = False) -> DataFrame:
    """Mean of a metric after the first ``warm_up`` steps, without its greatest value if ``drop_most``."""
    late = df.where(F.col(step) >= warm_up)
    total, n, most = F.sum(value), F.count(value), F.max(value)
    return late.agg((F.when((n > 1) & F.lit(drop_most), (total - most) / (n - 1)).otherwise(total / n)).alias("mean"))


def within_margin(expected: DataFrame, actual: DataFrame, step: str, value: str, margin: float) -> DataFrame:
    """(step, expected, actual, ok): both metrics by step; ok if they differ by no more than the relative margin."""
    e = expected.select(step, F.col(value).alias("expected"))
    a = actual.select(step, F.col(value).alias("actual"))
    return e.join(a, step, "full_outer").withColumn("ok", F.coalesce(F.abs(F.col("actual") - F.col("expected")) <= margin * F.abs("expected"), F.lit(False)))


def extracted(df: DataFrame, task: str, answer: str, gold: str, question: str | None = None, options: str | None = None) -> DataFrame:
    """``df`` with ``extracted`` and ``correct`` by the rules of a task.

    ``mmlu`` and ``hellaswag`` name an option anywhere, and ``cmmlu`` by its own patterns; ``ceval`` and ``boolq`` begin with a capital, which for ``boolq`` stands for an
    alias; ``agieval`` names options, one by its patterns (``agieval_single``, of the letters in ``options``), several (``agieval_multiple``) or has a formula (``agieval_cloze``), and by default its first line;
    ``gsm8k`` ends with a number, ``gsm8k_default`` has it behind ``The answer is``; ``bbh`` has its letter in brackets or its free answer behind ``answer is``,
    ``bbh_default`` and ``bbh_judged`` what the first line settles on, by the options of the ``question``. Nothing found, and a null answer or gold, is wrong.
    """
    a, g = F.col(answer), F.col(gold)
    asked = F.col(question) if question else F.lit(None).cast("string")
    ok = None
    if task in ("mmlu", "hellaswag"):
        found = extraction.option_udf(a, g)
    elif task == "cmmlu":
        found = extraction.subject_option_udf(a)
    elif task == "ceval":
        found = text.first_capital(a)
    elif task == "boolq":
        first = text.first_capital(a)
        found = F.when(first.isin(*"ABCD"), first).otherwise(text.answer_alias(first))
        ok = found == text.answer_alias(g)
    elif task == "agieval":
        found = text.first_line_without_math_marks(a)
    elif task == "agieval_single":
        found = extraction.exam_option_udf(a, F.col(options) if options else F.lit("ABCD"))
    elif task == "agieval_multiple":
        found = F.coalesce(text.first_options(a), F.lit(""))
    elif task in ("agieval_cloze", "math"):
        found = extraction.math_answer_udf(a)
        ok = (found == g) if task == "agieval_cloze" else extraction.same_formula_udf(found, g)
    elif task == "gsm8k":
        found = text.last_number(a)
        ok = found == text.gold_number(g)
    elif task == "gsm8k_default":
        found = extraction.default_number_udf(a)
        ok = found == text.gold_number(g)
    elif task == "bbh":
        lettered = g.rlike(r"^\([A-Z]\)$")
        found = F.when(lettered, F.concat(F.lit("("), text.choice_in_brackets(a), F.lit(")"))).otherwise(text.free_answer(a))
    elif task in ("bbh_default", "bbh_judged"):
        found = extraction.task_answer_udf(a, asked, F.lit(task == "bbh_judged"))
        ok = found == F.regexp_replace(g, r"^\(([A-Z])\)$", "$1")
    else:
        raise KeyError(f"unknown task {task!r}")
    out = df.withColumn("extracted", found)
    return out.withColumn("correct", F.coalesce((F.col("extracted") == g) if ok is None else ok, F.lit(False)))


def scored(df: DataFrame, task: str, group: str, answer: str, gold: str) -> DataFrame:
    """Accuracy of a task's predictions by group and in all."""
    return accuracy(extracted(df, task, answer, gold), group, F.col("correct"))


def joined_by_position(predictions: DataFrame, gold: DataFrame, position: str) -> DataFrame:
    """Predictions beside their gold rows, by an explicit position."""
    return predictions.join(gold, position)


def needle_grid(files: DataFrame, lengths: list[int], depths: list[int], repeats: int) -> DataFrame:
    """Every file at every context length, depth and repetition; the three lists are short, the files need no copy."""
    grid = [(n, d, r) for n in lengths for d in depths for r in range(repeats)]
    return files.withColumn("_g", F.array(*[F.struct(F.lit(n).alias("length"), F.lit(d).alias("depth"), F.lit(r).alias("repeat")) for n, d, r in grid])).withColumn("_g", F.explode("_g")).select("*", "_g.*").drop("_g")


def needle_scores(df: DataFrame, group: str, prediction: str, reference: str, keyword: str) -> DataFrame:
    """Mean needle score, times a hundred, by group."""
    score = text.needle_score(F.col(prediction), F.col(reference), F.col(keyword))
    return df.groupBy(group).agg(F.count("*").alias("n"), (F.avg(score) * 100).alias("score"))


def few_shot(questions: DataFrame, support: DataFrame, subject: str, prompt: str) -> DataFrame:
    """``questions`` with ``shots``, the support rows' prompts of their subject in rank order, joined by subject."""
    shots = support.groupBy(subject).agg(F.sort_array(F.collect_list(F.struct("rank", prompt))).alias("_s"))
    return questions.join(shots, subject).withColumn("shots", F.array_join(F.col(f"_s.{prompt}"), "\n\n")).drop("_s")


def in_order(df: DataFrame, by: Column, tie: str) -> DataFrame:
    """``df`` with its rank by a value, ties in the order of ``tie``; a range sort, not one task."""
    from corpusloom.operators.ordinals import with_prefix

    return with_prefix(df.withColumn("_by", by), ["_by", tie], name="rank").drop("_by")


def logistic_depths(n: int, steepness: float = 0.1) -> list[float]:
    """``n`` depths in percent that lie closer at both ends, to three digits."""
    if n == 1:
        return [0.0]
    out = []
    for i in range(n):
        x = 100 * i / (n - 1)
        out.append(x if x in (0, 100) else round(100 / (1 + math.exp(-steepness * (x - 50))), 3))
    return out


def linear_depths(n: int) -> list[float]:
    return [0.0] if n == 1 else [round(100 * i / (n - 1), 3) for i in range(n)]


def first_of_group(df: DataFrame, group: str, order: str) -> DataFrame:
    """The first row of each group in an order, without a sort of whole groups."""
    rest = [c for c in df.columns if c != group]
    return df.groupBy(group).agg(F.min_by(F.struct(*rest), F.struct(order)).alias("_r")).select(group, "_r.*")


def running(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Running sums within groups of bounded size."""
    return df.withColumn("running", F.sum(value).over(Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
