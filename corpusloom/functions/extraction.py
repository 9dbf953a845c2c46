"""Answers found in what a model said. The regular cascades run as vectorised functions; each tries its patterns in order."""

from __future__ import annotations

import re
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

# Patterns that announce an option, tried in this order; {o} stands for the options (fixed values).
ANNOUNCED = (
    r"答案是?\s*([{o}])",
    r"答案是?\s*：\s*([{o}])",
    r"答案是?\s*:\s*([{o}])",
    r"答案选项应?该?是\s*([{o}])",
    r"答案选项应?该?为\s*([{o}])",
    r"答案应该?是\s*([{o}])",
    r"答案应该?选\s*([{o}])",
    r"答案选项为?\s*：\s*([{o}])",
    r"答案选项是?\s*:\s*([{o}])",
    r"答案为\s*([{o}])",
    r"答案选\s*([{o}])",
    r"选择?\s*([{o}])",
    r"故选?\s*([{o}])",
    r"只有选?项?\s?([{o}])\s?是?对",
    r"只有选?项?\s?([{o}])\s?是?错",
    r"只有选?项?\s?([{o}])\s?不?正确",
    r"只有选?项?\s?([{o}])\s?错误",
    r"说法不?对选?项?的?是\s?([{o}])",
    r"说法不?正确选?项?的?是\s?([{o}])",
    r"说法错误选?项?的?是\s?([{o}])",
    r"([{o}])\s?是正确的",
    r"([{o}])\s?是正确答案",
    r"选项\s?([{o}])\s?正确",
    r"所以答\s?([{o}])",
    r"所以\s?([{o}][.。$]?$)",
    r"所有\s?([{o}][.。$]?$)",
    r"Answer:\s*\n\s*([A-D])",
    r"(?i)ANSWER\s*:\s*([{o}])",
    r"[\s，：:,]([{o}])[。，,\.]?$",
    r"[\s，,：:][故即]([{o}])[。\.]?$",
    r"[\s，,：:]因此([{o}])[。\.]?$",
    r"[是为。]\s?([{o}])[。\.]?$",
    r"因此\s?([{o}])[。\.]?$",
    r"显然\s?([{o}])[。\.]?$",
    r"答案是\s?(\S+)(?:。|$)",
    r"答案应该是\s?(\S+)(?:。|$)",
    r"答案为\s?(\S+)(?:。|$)",
    r"[Tt]he answer is:?\s+\(?([{o}])\)?",
    r"[Tt]he answer is option:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is option:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is:?.*?boxed\{([{o}])\}",
    r"[Tt]he correct option is:?.*?boxed\{([{o}])\}",
    r"[Tt]he correct answer option is:?.*?boxed\{([{o}])\}",
    r"[Tt]he answer to the question is:?\s+\(?([{o}])\)?",
    r"^选项\s?([{o}])",
    r"^([{o}])\s?选?项",
    r"(\s|^)[{o}][\s。，,：:\.$]",
    r"1.\s?(.*?)$",
    r"1.\s?([{o}])[.。$]?$",
)
# The patterns of the exams with passages (fixed values); {o} stands for the options.
EXAM_ANNOUNCED = (
    r"答案是?\s*([{o}])",
    r"答案是?\s*：\s*([{o}])",
    r"答案是?\s*:\s*([{o}])",
    r"答案选项应?该?是\s*([{o}])",
    r"答案选项应?该?为\s*([{o}])",
    r"答案应该?是\s*([{o}])",
    r"答案应该?选\s*([{o}])",
    r"答案选项为?\s*：\s*([{o}])",
    r"答案选项为?\s+\(?\*?\*?([{o}])\*?\*?\)?",
    r"答案选项是?\s*:\s*([{o}])",
    r"答案为\s*([{o}])",
    r"答案选\s*([{o}])",
    r"选择?\s*([{o}])",
    r"故选?\s*([{o}])",
    r"只有选?项?\s?([{o}])\s?是?对",
    r"只有选?项?\s?([{o}])\s?是?错",
    r"只有选?项?\s?([{o}])\s?不?正确",
    r"只有选?项?\s?([{o}])\s?错误",
    r"说法不?对选?项?的?是\s?([{o}])",
    r"说法不?正确选?项?的?是\s?([{o}])",
    r"说法错误选?项?的?是\s?([{o}])",
    r"([{o}])\s?是正确的",
    r"([{o}])\s?是正确答案",
    r"选项\s?([{o}])\s?正确",
    r"所以答\s?([{o}])",
    r"所以\s?([{o}][.。$]?$)",
    r"所有\s?([{o}][.。$]?$)",
    r"[\s，：:,]([{o}])[。，,\.]?$",
    r"[\s，,：:][故即]([{o}])[。\.]?$",
    r"[\s，,：:]因此([{o}])[。\.]?$",
    r"[是为。]\s?([{o}])[。\.]?$",
    r"因此\s?([{o}])[。\.]?$",
    r"显然\s?([{o}])[。\.]?$",
    r"答案是\s?(\S+)(?:。|$)",
    r"答案应该是\s?(\S+)(?:。|$)",
    r"答案为\s?(\S+)(?:。|$)",
    r"(?i)ANSWER\s*:\s*([{o}])",
    r"[Tt]he answer is:?\s+\(?([{o}])\)?",
    r"[Tt]he answer is:?\s+\(?\*?\*?([{o}])\*?\*?\)?",
    r"[Tt]he answer is option:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is option:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is:?.*?boxed\{([{o}])\}",
    r"[Tt]he correct option is:?.*?boxed\{([{o}])\}",
    r"[Tt]he correct answer option is:?.*?boxed\{([{o}])\}",
    r"[Tt]he answer to the question is:?\s+\(?([{o}])\)?",
    r"^选项\s?([{o}])",
    r"^([{o}])\s?选?项",
    r"(\s|^)[{o}][\s。，,：:\.$]",
    r"1.\s?(.*?)$",
    r"1.\s?([{o}])[.。$]?$",
)
# The patterns of the Chinese subjects (fixed values); {o} stands for the options.
SUBJECT_ANNOUNCED = (
    r"答案是?\s*([{o}])",
    r"答案是?\s*：\s*([{o}])",
    r"答案是?\s*:\s*([{o}])",
    r"答案应该?是\s*([{o}])",
    r"答案应该?选\s*([{o}])",
    r"答案为\s*([{o}])",
    r"答案选\s*([{o}])",
    r"选择?\s*([{o}])",
    r"故选?\s*([{o}])",
    r"只有选?项?\s?([{o}])\s?是?对",
    r"只有选?项?\s?([{o}])\s?是?错",
    r"只有选?项?\s?([{o}])\s?不?正确",
    r"只有选?项?\s?([{o}])\s?错误",
    r"说法不?对选?项?的?是\s?([{o}])",
    r"说法不?正确选?项?的?是\s?([{o}])",
    r"说法错误选?项?的?是\s?([{o}])",
    r"([{o}])\s?是正确的",
    r"([{o}])\s?是正确答案",
    r"选项\s?([{o}])\s?正确",
    r"所以答\s?([{o}])",
    r"所以\s?([{o}][.。$]?$)",
    r"所有\s?([{o}][.。$]?$)",
    r"[\s，：:,]([{o}])[。，,\.]?$",
    r"[\s，,：:][故即]([{o}])[。\.]?$",
    r"[\s，,：:]因此([{o}])[。\.]?$",
    r"[是为。]\s?([{o}])[。\.]?$",
    r"因此\s?([{o}])[。\.]?$",
    r"显然\s?([{o}])[。\.]?$",
    r"答案是\s?(\S+)(?:。|$)",
    r"答案应该是\s?(\S+)(?:。|$)",
    r"答案为\s?(\S+)(?:。|$)",
    r"[Tt]he answer is:?\s+\(?([{o}])\)?",
    r"[Tt]he answer is option:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is:?\s+\(?([{o}])\)?",
    r"[Tt]he correct answer is option:?\s+\(?([{o}])\)?",
    r"[Tt]he answer to the question is:?\s+\(?([{o}])\)?",
    r"^选项\s?([{o}])",
    r"^([{o}])\s?选?项",
    r"(\s|^)[{o}][\s。，,：:\.$]",
    r"(\s|^)[{o}](\s|$)",
    r"1.\s?(.*?)$",
    r"1.\s?([{o}])[.。$]?$",
)
#: Tried when nothing announces an option.
FALLBACK = (r"([{o}]):", r"([{o}])")
#: A request that prompts repeat and that names the options (fixed value).
REQUEST = "Answer the question by replying A, B, C or D."


@cache
def _compiled(options: str, patterns: tuple[str, ...]) -> list[re.Pattern]:
    return [re.compile(p.replace("{o}", options), re.S) for p in patterns]


def option(answer: str | None, gold: str | None = None, options: str = "ABCD", by_group: bool = False, patterns: tuple[str, ...] = ANNOUNCED + FALLBACK, request: str = REQUEST) -> str:
    """The option an answer names, or ''.

    If the first letter A to D of the first line is the gold one, that settles it. Otherwise patterns are tried in order; a match
    counts if its last character (its group, or all of it, if ``by_group``) holds an option.
    """
    text = (answer or "").strip()
    if not text:
        return ""
    first = re.search("[A-D]", text.splitlines()[0])
    if gold and first and first.group(0) == gold:
        return gold
    text = text.replace(request, "").strip() if request else text
    for pattern in _compiled(options, patterns):
        if m := pattern.search(text):
            where = (m.group(1) or m.group(0)) if by_group else m.group(0)[-1:]
            if named := [o for o in options if o in where]:
                return named[0]
    return ""


def _balanced(text: str, at: int) -> str | None:
    """What stands between the brace at ``at`` and its partner."""
    depth = 0
    for i in range(at, len(text)):
        depth += (text[i] == "{") - (text[i] == "}")
        if not depth:
            return text[at + 1 : i]
    return None


#: What worked examples before an answer end with; only what follows the last one counts (fixed values, tried in this order).
WORKED = ("The answer is therefore", "答案是")
_NUMBER = re.compile(r"(?:\$)?\d+(?:\.\d+)?(?![\w\d])")


def _right_side(expression: str) -> str:
    """What stands behind the last equals sign, without spaces before it."""
    return expression.rsplit("=", 1)[1].lstrip(" ") if "=" in expression else expression


def math_answer(text: str | None) -> str | None:
    """The formula an answer settles on: the last boxed one, else the widest between dollar signs of a line's, else by sign or number.

    Worked examples before the answer are cut off first. A box that isn't written with ``\\boxed`` braces, or never closes, gives nothing. Without a box,
    what lies between the first and last dollar sign of the last line that has two counts; if that is nothing, what follows the last equals sign,
    without full stops at its end; and without one the last number, with its dollar sign, that no letter or digit follows.
    """
    if text is None:
        return None
    for mark in WORKED:
        if mark in text:
            text = (text[len(mark) :] if text.startswith(mark) else text[text.rfind(mark) + len(mark) :]).strip()
    if "\\boxed" in text:
        at = text.rfind("\\boxed")
        opening = text.find("{", at)
        inner = _balanced(text, opening) if opening >= 0 else None
        return _right_side(inner) if inner is not None and opening == at + len("\\boxed") else None
    if found := re.findall(r"\$(.*)\$", text):
        if said := _right_side(found[-1]):
            return said
    if "=" in text:
        return _right_side(text).rstrip(".").split("\\n", 1)[0]
    numbers = _NUMBER.findall(text)
    return numbers[-1] if numbers else None


def normalized_math(text: str | None) -> str | None:
    """A formula without layout: no spaces, sizing, units or dollar signs, short fractions in full."""
    if text is None:
        return None
    for cut in ("\n", "\\!", "\\left", "\\right", "^{\\circ}", "^\\circ", "\\$", "$", "\\%", "%", " "):
        text = text.replace(cut, "")
    text = text.replace("\\\\", "\\").replace("tfrac", "frac").replace("dfrac", "frac")
    text = re.sub(r"\\text\{[^{}]*\}$", "", text)
    text = re.sub(r"\\frac(\d)(\d)", r"\\frac{\1}{\2}", text)
    text = re.sub(r"\\sqrt(\w)", r"\\sqrt{\1}", text)
    text = re.sub(r"(^|[^\d])\.(\d)", r"\g<1>0.\2", text)
    if re.fullmatch(r"-?\d+/\d+", text):
        a, b = text.split("/")
        text = f"\\frac{{{a}}}{{{b}}}"
    return "\\frac{1}{2}" if text == "0.5" else text


def same_formula(a: str | None, b: str | None) -> bool:
    return normalized_math(a) == normalized_math(b) if a is not None and b is not None else a is b


def lettered(question: str) -> dict[str, str]:
    """Text of each option of a question, ``(A) text``, to its letter."""
    return {text.strip(): letter for letter, text in re.findall(r"\(([A-Z])\)\s*([^\(\)]+)", question)}


def task_answer(text: str | None, options: dict[str, str] | None = None, judged: bool = False) -> str | None:
    """An answer to a reasoning task.

    Of the first line what follows the last opening bracket, up to a full stop, line feed or closing bracket. With ``options`` (text -> letter) an
    option's text stands for its letter. A task that is ``judged`` (yes or no, true or false, valid or invalid) takes the first such word if there is one.
    """
    if not text:
        return text
    first = (text.splitlines() or [""])[0]
    said = re.split(r"\.|\n\n|\n|\)", first[first.rfind("(") + 1 :])[0].strip("()")
    if options and said in options:
        said = options[said]
    if judged and (word := re.search(r"\b(yes|no|true|false|invalid|valid)\b", said, re.I)):
        return word.group()
    return said


def default_number(text: str | None) -> str | None:
    """The number behind ``The answer is`` of an answer that wasn't reasoned out; null without one. Later questions, dollar signs and commas don't count."""
    if text is None:
        return None
    plain = text.lstrip().split("Q:")[0].replace("$", "").replace(",", "") + "  "
    found = re.findall(r"The answer is (.*?) ", plain.replace(".", " "))
    return found[0] if found else None


@F.pandas_udf(StringType())
def option_udf(answer: pd.Series, gold: pd.Series) -> pd.Series:
    return pd.Series([option(a, g) for a, g in zip(answer, gold, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def subject_option_udf(answer: pd.Series) -> pd.Series:
    """The option by the patterns of the Chinese subjects, the last character of a match."""
    return answer.map(lambda a: option(a, patterns=SUBJECT_ANNOUNCED + (r"([{o}]):", r"[{o}]"), request=""))


@F.pandas_udf(StringType())
def exam_option_udf(answer: pd.Series, options: pd.Series) -> pd.Series:
    """The option by the patterns of the exams with passages, the first group of a match; ``options`` are a question's letters."""
    return pd.Series([option(a, options=o or "ABCD", by_group=True, patterns=EXAM_ANNOUNCED + FALLBACK, request="") for a, o in zip(answer, options, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def default_number_udf(answer: pd.Series) -> pd.Series:
    return answer.map(default_number)


@F.pandas_udf(StringType())
def math_answer_udf(text: pd.Series) -> pd.Series:
    return text.map(math_answer)


@F.pandas_udf(BooleanType())
def same_formula_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([same_formula(x, y) for x, y in zip(a, b, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def task_answer_udf(text: pd.Series, question: pd.Series, judged: pd.Series) -> pd.Series:
    """``task_answer`` with the options of each question."""
    return pd.Series([task_answer(t, lettered(q or ""), bool(j)) for t, q, j in zip(text, question, judged, strict=True)], dtype=object)


def listed_options(question: Column, options: list[Column], letters: str = "ABCD") -> Column:
    """A question with its options, one per line behind their letters; null options are left out."""
    lines = [F.concat(F.lit(f"\n{a}. "), o) for a, o in zip(letters, options, strict=False)]
    return F.concat(question, F.concat_ws("", *lines))
