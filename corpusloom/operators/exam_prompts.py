"""Prompts of examinations: questions with their options, worked examples before them, and passages with default instructions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = ("A", "B", "C", "D")


@dataclass(frozen=True)
class Style:
    """``head`` stands once before everything, ``lead`` before each question, ``answer`` behind its options; a worked example ends
    with ``joint``, its answer and ``gap``. ``{subject}`` is the subject, with spaces for underscores if ``spaced``."""

    head: str = ""
    lead: str = ""
    answer: str = "\nAnswer: "
    joint: str = ""
    gap: str = "\n"
    spaced: bool = True


# Texts of the prompts (fixed values).
STYLES = {
    "choice": Style(lead="There is a single choice question about {subject}. Answer the question by replying A, B, C or D. \nQuestion: ", joint="\n", gap="\n\n"),
    "subject_en": Style(lead="There is a single choice question about {subject}. Answer the question by replying A, B, C or D. \nQuestion: ", answer="\n答案是: "),
    "subject_zh": Style(lead="以下是关于{subject}的单项选择题，请直接给出正确答案的选项。\n题目：", answer="\n答案是: ", spaced=False),
    "loss": Style(head="The following are multiple choice questions (with answers) about  {subject}.\n\n", gap="\n\n"),
    "exam_zh": Style(lead="以下是中国关于{subject}考试的单项选择题，请选出其中的正确答案。\n", answer="\n答案: ", joint="\n", spaced=False),
    "template_en": Style(head="The following are multiple choice questions (with answers) about {subject}.\n\n", gap=""),
    "template_zh": Style(head="以下是中国关于{subject}考试的单项选择题，请选出其中的正确答案。\n\n", answer="\n答案：", gap="", spaced=False),
}
# What stands before the answer of an exam with passages, by language (fixed values).
HINTS = {"zh": "答案是： ", "en": "The answer is "}


def _with_subject(text: str, subject: Column, spaced: bool) -> Column:
    named = F.replace(subject, F.lit("_"), F.lit(" ")) if spaced else subject
    return F.replace(F.lit(text), F.lit("{subject}"), named) if "{subject}" in text else F.lit(text)


def with_options(question: Column, options: list[Column], letters: tuple[str, ...] = LETTERS) -> Column:
    """A question with its options, one per line behind their letters; null options are left out, a null question is empty."""
    lines = [F.concat(F.lit(f"\n{a}. "), o) for a, o in zip(letters, options, strict=False)]
    return F.concat_ws("", question, *lines)


def asked(style: Style, subject: Column, question: Column, options: list[Column]) -> Column:
    """A question as a style puts it, without its answer."""
    return F.concat(_with_subject(style.lead, subject, style.spaced), with_options(question, options), F.lit(style.answer))


def prompts(questions: DataFrame, support: DataFrame, style: str, row_id: str, subject: str = "subject", question: str = "question", options: tuple[str, ...] = LETTERS, answer: str = "answer") -> DataFrame:
    """(row_id, prompt): every question behind the worked examples of its subject, which ``support`` has with their ``rank``.

    Worked examples are joined by subject from one row for each, which holds at most as many as the support set; a subject
    without any has none. A null answer of a worked example is empty, a null subject is a subject of its own.
    """
    s = STYLES[style]
    columns = lambda: (F.col(question), [F.col(o) for o in options])
    shot = F.concat(asked(s, F.coalesce(F.col(subject), F.lit("")), *columns()), F.lit(s.joint), F.coalesce(answer, F.lit("")), F.lit(s.gap))
    shots = support.select(F.col(subject).alias("_subject"), F.struct("rank", shot.alias("shot")).alias("_shot")).groupBy("_subject").agg(F.sort_array(F.collect_list("_shot")).alias("_shots"))
    own = questions.join(shots, F.col(subject).eqNullSafe(F.col("_subject")), "left")
    name = F.coalesce(F.col(subject), F.lit(""))
    head = _with_subject(s.head, name, s.spaced)
    return own.select(row_id, F.concat(head, F.coalesce(F.array_join("_shots.shot", ""), F.lit("")), asked(s, name, *columns())).alias("prompt"))


def passage_question(passage: Column, question: Column, between: str = "\n") -> Column:
    """Passage and question, the question alone without a passage."""
    return F.concat_ws(between, F.nullif(passage, F.lit("")), question)


def gold_of(label: Column, answer: Column) -> Column:
    """The label (several joined by commas), else the answer without dollar signs; null without either."""
    return F.coalesce(F.nullif(label, F.lit("")), F.replace(F.nullif(answer, F.lit("")), F.lit("$"), F.lit("")))


def passage_prompt(lead: Column, passage: Column, question: Column, options: Column, language: str = "en") -> Column:
    """A passage's question under its exam's lead, with its options (an array) if it has any, and the hint of the language."""
    listed = F.trim(F.array_join(F.coalesce(options, F.array().cast("array<string>")), "\n"))
    return F.concat_ws("\n", lead, passage_question(passage, question, ""), F.nullif(listed, F.lit("")), F.lit(HINTS[language]))


def letters_of(options: Column) -> Column:
    """The letters of as many options as there are, as one text; null without any."""
    n = F.size(options)
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.char(i + 65)), ""))


def allowed(questions: DataFrame, subjects: DataFrame, subject: str = "subject") -> DataFrame:
    """The questions of subjects that have a template; subjects are few, a row for each."""
    return questions.join(subjects.select(subject).distinct(), subject, "left_semi")


def display_names(df: DataFrame, names: dict[str, str], subject: str = "subject", name: str = "name") -> DataFrame:
    """``df`` with the display name of each subject, itself if it has none. ``names`` is one entry for each subject."""
    known = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair]) if names else None
    return df.withColumn(name, F.coalesce(known[F.col(subject)], F.col(subject)) if known is not None else F.col(subject))
