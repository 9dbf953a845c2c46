"""Text functions as column expressions; Unicode normalisation, which Spark lacks, as a vectorised function.

All give null for null. White space is Unicode white space and the separators U+001C to U+001F, as in ``str.strip``.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_SPACE = r"\s\x1c-\x1f\x85\p{Z}"
#: Prefixes of DOIs, tried in this order; one is removed (fixed values).
DOI_PREFIXES = ("https://doi.org/", "http://doi.org/", "https://dx.doi.org/", "http://dx.doi.org/", "doi:")


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, rf"^[{_SPACE}]+|[{_SPACE}]+$", "")


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_doi(c: Column) -> Column:
    """Stripped, lower-case DOI without one resolver prefix; null if nothing is left."""
    prefix = "|".join(p.replace(".", r"\.") for p in DOI_PREFIXES)
    # one pass: white space, a prefix, white space, the identifier, white space
    found = F.regexp_extract(c.cast("string"), rf"(?is)^[{_SPACE}]*(?:{prefix})?[{_SPACE}]*(.*?)[{_SPACE}]*\z", 1)
    return none_if_empty(F.lower(found))


@F.pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Canonical composition (NFC)."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def normalize_text(c: Column) -> Column:
    """NFC, no NUL, line feeds only, no trailing dotted residue lines, stripped; null if nothing is left."""
    unix = F.replace(F.replace(F.replace(nfc(c), F.lit("\x00"), F.lit("")), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return none_if_empty(strip(F.replace(unix, F.lit("\n..\n..\n.."), F.lit(""))))


def assemble_text(abstract: Column, body: Column) -> Column:
    """Normalised abstract and body, those that aren't empty, with a blank line between."""
    return F.concat_ws("\n\n", normalize_text(abstract), normalize_text(body))


def moss_user(c: Column) -> Column:
    return strip(F.replace(F.replace(c, F.lit("<eoh>"), F.lit("")), F.lit("<|Human|>: "), F.lit("")))


def moss_assistant(c: Column) -> Column:
    return strip(F.replace(F.replace(c, F.lit("<|MOSS|>:"), F.lit("")), F.lit("<eom>"), F.lit("")))


def before_fence(c: Column) -> Column:
    """What stands before the first code fence, stripped."""
    return strip(F.substring_index(c, "```", 1))


def fenced_code(c: Column) -> Column:
    """The body of the first fenced block, or the text itself if there is none."""
    return F.when(c.rlike(r"(?s)```\w*\n(.*?)```"), F.regexp_extract(c, r"(?s)```\w*\n(.*?)```", 1)).otherwise(c)


def remove_thought(c: Column, begin: str = "<think>\n", end: str = "\n</think>\n\n") -> Column:
    """Without the thought sections, and without line feeds at the start."""
    quote = lambda s: "".join("\\" + x if not (x.isalnum() or x == "\n") else x for x in s)
    return F.regexp_replace(F.regexp_replace(c, f"(?s){quote(begin)}.*?{quote(end)}", ""), r"^\n+", "")


def add_thought(c: Column, begin: str = "<think>\n", end: str = "\n</think>\n\n") -> Column:
    """An empty thought before the text."""
    return F.concat(F.lit(begin + end), c)


def subject_of_file(c: Column) -> Column:
    """A subject from a file name: without extension and without _test, _val or _dev."""
    return F.regexp_replace(F.regexp_replace(c, r"^.*/", ""), r"(?:_test|_val|_dev)?\.[^.]+$", "")


def first_capital(c: Column) -> Column:
    return none_if_empty(F.regexp_extract(c, r"(\p{Lu})", 1))


def first_options(c: Column) -> Column:
    """The first run of letters A to D."""
    return none_if_empty(F.regexp_extract(c, r"([A-D]+)", 1))


def last_number(c: Column) -> Column:
    """The last number before the word ``Question:``, or the text NULL."""
    numbers = F.regexp_extract_all(F.substring_index(c, "Question:", 1), F.lit(r"(-?\d+(?:\.\d+)?)"), F.lit(1))
    return F.when(F.size(numbers) > 0, F.element_at(numbers, -1)).otherwise(F.when(c.isNotNull(), F.lit("NULL")))


def gold_number(c: Column) -> Column:
    """What follows the last ``#### ``."""
    return F.substring_index(c, "#### ", -1)


def _behind_answer(c: Column) -> Column:
    """What stands between the first ``answer is `` and the next one, stripped; the text itself without one."""
    return F.when(F.instr(c, "answer is ") > 0, strip(F.get(F.split(c, "answer is "), F.lit(1)))).otherwise(c)


def choice_in_brackets(c: Column) -> Column:
    """Behind ``answer is `` the first capital letter after an opening bracket, else the first one at all, else what stands there."""
    tail = _behind_answer(c)
    bracket = F.regexp_extract(tail, r"\(([A-Z])", 1)
    capital = F.regexp_extract(tail, r"([A-Z])", 1)
    return F.when(bracket != "", bracket).when(capital != "", capital).otherwise(tail)


def free_answer(c: Column, judged: bool = False) -> Column:
    """The first line behind ``answer is `` without a full stop at its end, or what is in bold there; of a ``judged`` task up to a comma."""
    line = strip(F.substring_index(_behind_answer(c), "\n", 1))
    bare = F.when(line.endswith("."), strip(F.substring(line, F.lit(1), F.length(line) - 1))).otherwise(line)
    bold = F.regexp_extract(bare, r"\*\*(.*?)\*\*", 1)
    said = F.substring_index(strip(bold), ",", 1) if judged else bold
    return F.when(bare.rlike(r"\*\*(.*?)\*\*"), said).otherwise(bare)


def first_line_without_math_marks(c: Column) -> Column:
    """The first line of what is said, without dollar signs and brackets."""
    return F.translate(F.substring_index(F.regexp_replace(c, rf"^[{_SPACE}]+", ""), "\n", 1), "$()", "")


def trim_prediction(prediction: Column, reference: Column) -> Column:
    """Cut to 1.2 times the reference; ended at the reference's last character if it comes after 0.8 times its length."""
    n = F.length(reference)
    cut = F.substring(prediction, F.lit(1), F.floor(n * 1.2).cast("int"))
    from_ = F.floor(n * 0.8).cast("int")
    tail = F.substring(cut, from_ + 1, F.length(cut))
    hit = F.instr(tail, F.substring(reference, -1, 1))
    return F.when((hit > 0) & (n > 0), F.substring(cut, F.lit(1), from_ + hit)).otherwise(cut)


def needle_score(prediction: Column, reference: Column, keyword: Column) -> Column:
    """1 if the keyword occurs, else a fifth of the edit similarity, white space left out."""
    a, b = F.regexp_replace(prediction, r"\s+", ""), F.regexp_replace(reference, r"\s+", "")
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(F.contains(prediction, keyword), F.lit(1.0)).when(longest == 0, F.lit(0.2)).otherwise(0.2 * (1 - F.levenshtein(a, b) / longest))


def trimmed_needle_score(prediction: Column, reference: Column, keyword: Column) -> Column:
    """As ``needle_score``, of the prediction cut near the length of the reference (``trim_prediction``), white space left out before."""
    a, b = F.regexp_replace(prediction, rf"[{_SPACE}]+", ""), F.regexp_replace(reference, rf"[{_SPACE}]+", "")
    cut = trim_prediction(a, b)
    longest = F.greatest(F.length(cut), F.length(b))
    return F.when(F.contains(prediction, keyword), F.lit(1.0)).when(longest == 0, F.lit(0.2)).otherwise(0.2 * (1 - F.levenshtein(cut, b) / longest))


def insert_at_depth(tokens: Column, needle: Column, depth: Column) -> Column:
    """``needle`` put into ``tokens`` at ``depth`` percent of their number."""
    k = F.floor(F.size(tokens) * depth / 100).cast("int")
    return F.concat(F.slice(tokens, F.lit(1), k), needle, F.slice(tokens, k + 1, F.size(tokens)))


def answer_alias(c: Column) -> Column:
    """True, Yes, Y and T stand for A; False, No, N and F for B; others for themselves."""
    return F.when(c.isin("True", "Yes", "Y", "T"), "A").when(c.isin("False", "No", "N", "F"), "B").otherwise(c)


def sentences(c: Column, keep_newlines: bool = False) -> Column:
    """Sentences split behind end marks; identity splitting is the array of the text itself."""
    parts = F.split(c, r"(?<=[.!?])(?=\s+)" if keep_newlines else r"(?<=[.!?])\s+")
    return F.filter(parts, lambda s: F.length(s) > 0)
