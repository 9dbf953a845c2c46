"""Defective prompt and response pairs, each with its one defect.

Per pair: a suffix automaton of the prompt's words measures how much of the answer was copied from it (and the other way
round how much of the prompt the answer took); an Aho-Corasick automaton finds phrases of refusal, sentence by sentence; a
stack of open delimiters and the last line tell whether the answer breaks off; stopwords and scripts vote for languages.
Defects are tested in the order empty, refusal, copy, language, truncated; the first that holds is the one reported.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import pair_words as W

#: Share of the answer that must be copied, share of the prompt that must be taken, for a copy.
COPIED, TAKEN = 0.85, 0.7
#: Words around a copy, such as "you asked", that don't count if there are no more.
FRAME = 3
#: Copied runs shorter than this count only if the text is as short.
RUN = 3

_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_THOUGHT = re.compile(r"<think(?:ing)?>.*?(?:</think(?:ing)?>|$)", re.S | re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_FENCE = re.compile(r"```.*?(?:```|$)", re.S)
# Accents over Latin, Greek and Cyrillic letters; scripts with marks of their own.
_MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")
_FAR = re.compile("[\u0483-\u0487\u0591-\u1aaf\u1b00-\u1cff\u2cef-\u2cf1\u2d7f\u302a-\u309a\ua66f-\uabff\ufb1e\U00010000-\U0010ffff]")
_WORD = re.compile(r"[^\W_]+")
_HEAD = re.compile(r"[:\n]|[.!]\s")
_SENTENCE = re.compile(r"(?<=[.!?…。！？])[\s\"”»)]+|\n+")
_CLAUSE = re.compile(r"[,;:()–—]+|\s-\s|\b(?:but|however|aber|jedoch|sondern|mais|pero|sino)\b", re.I)
_ITEM = re.compile(r"^\s*(?:[-*•+‣–]|\(?\d{1,3}[.):]|\(?[a-zA-Z][.)])\s+\S")
_QUOTED = re.compile(r"\"(?:\\.|[^\"\\\n])*\"|(?<!\w)'(?:\\.|[^'\\\n])*'")
_JSON = re.compile(r"\s*(?:\{\s*[\"}]|\[\s*(?:[\[{\"]|-?\d[\d.eE+-]*\s*(?:,|$)|true\b|false\b|null\b))")
_CODE_LINE = re.compile(r"[{}()\[\];=]\s*$|^\s*(?:def|class|return|if|elif|else|for|while|import|from|const|let|var|function|public|private|static|#include)\b.*[:;{}()]|^\s*[\w.\[\]]+\s*[-+*/]?=\s*\S|^\s*\"[^\"]*\"\s*:")
_SIGNATURE = re.compile(r"\n\s*(?:--+|—|\*{3,}|_{3,}|={3,}|#{2,})\s*(?:end|fin|ende)?\s*[-—]*\s*$", re.I)
_SCRIPTS = (("zh", re.compile("[一-鿿]")), ("ja", re.compile("[぀-ヿ]")), ("ko", re.compile("[가-힣]")), ("ru", re.compile("[Ѐ-ӿ]")), ("ar", re.compile("[؀-ۿ]")), ("el", re.compile("[Ͱ-Ͽ]")), ("he", re.compile("[֐-׿]")), ("hi", re.compile("[ऀ-ॿ]")), ("th", re.compile("[฀-๿]")))
_PAIRS = {")": "(", "]": "[", "}": "{", "”": "“", "»": "«", "）": "（"}
_END = ".!?…。！？؟।"
_OPEN = set(_PAIRS.values())


def words(text: str) -> list[str]:
    """The words of a text: no accents, lower case, letters and digits."""
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", _INVISIBLE.sub("", text)))
        if _FAR.search(text):
            text = "".join(c for c in text if not unicodedata.combining(c))
    return _WORD.findall(text.casefold())


class SuffixAutomaton:
    """Of a sequence of words: every run of them is a path from the start."""

    def __init__(self, seq: list[str]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for w in seq:
            cur = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            p = last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = cur
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                if self.length[q] == self.length[p] + 1:
                    self.link[cur] = q
                else:
                    twin = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    while p >= 0 and self.next[p].get(w) == q:
                        self.next[p][w] = twin
                        p = self.link[p]
                    self.link[q] = self.link[cur] = twin
            last = cur

    def covered(self, seq: list[str], least: int) -> float:
        """Share of ``seq`` that lies in runs of at least ``least`` words of the automaton's sequence."""
        state = run = done = total = 0
        for i, w in enumerate(seq):
            while state and w not in self.next[state]:
                state = self.link[state]
                run = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                run += 1
            else:
                run = 0
            if run >= least:
                begin = max(done, i + 1 - run)
                total += i + 1 - begin
                done = i + 1
        return total / len(seq) if seq else 0.0


@cache
def _phrases():
    import ahocorasick

    a = ahocorasick.Automaton()
    kinds: dict[str, set[str]] = {}
    for kind, phrases in (("filler", W.FILLERS), ("refusal", W.REFUSALS), ("half", W.HALF_REFUSALS)):
        for p in phrases:
            kinds.setdefault(p, set()).add(kind)
    for p, held in kinds.items():
        a.add_word(f" {p} ", frozenset(held))
    a.make_automaton()
    return a


@cache
def _stopwords() -> dict[str, tuple[tuple[str, float], ...]]:
    by: dict[str, list[str]] = {}
    for lang, text in W.STOPWORDS.items():
        for w in set(text.split()):
            by.setdefault(w, []).append(lang)
    return {w: tuple((lang, 1 / len(langs)) for lang in langs) for w, langs in by.items()}


def votes(text: str, seq: list[str]) -> dict[str, float]:
    """Votes for each language: of stopwords, shared among the languages that have them, and of other scripts' letters."""
    stop, out = _stopwords(), {}
    for w in seq:
        for lang, v in stop.get(w, ()):
            out[lang] = out.get(lang, 0) + v
    if not text.isascii():
        for lang, pattern in _SCRIPTS:
            if n := len(pattern.findall(text)):
                out[lang] = out.get(lang, 0) + n / 3
        for lang, letters in W.LETTERS.items():
            if n := sum(map(text.count, letters)):
                out[lang] = out.get(lang, 0) + n / 4
    return out


def is_empty(prompt: list[str], answer: str) -> bool:
    """Nothing in the answer says anything."""
    seq = words(_TAG.sub(" ", _THOUGHT.sub(" ", answer)))
    text = " ".join(seq)
    if text in W.NONE_WORDS:
        asked = f" {' '.join(prompt)} "
        return not any(f" {c} " in asked for c in W.COUNTING)
    return not seq or text in W.PLACEHOLDERS


def _says_nothing(seq: list[str], filler: bool) -> bool:
    """Whether a sentence beside a refusal is courtesy or another excuse, and no matter."""
    have = set(seq)
    if len(seq) <= 14 and (filler or have & W.COURTESY):
        return True
    return len(seq) <= 24 and bool(have & W.FIRST_PERSON and have & W.NEGATION) and not any(w.isdigit() for w in seq)


def _statements(answer: str) -> Iterator[list[str]]:
    """The words of each sentence; of a long one those of each clause, as there may be more in it than a refusal."""
    for sentence in _SENTENCE.split(answer):
        seq = words(sentence)
        if len(seq) <= 34:
            yield seq
        else:
            yield from map(words, _CLAUSE.split(sentence))


def declines(seq: list[str], kinds: set[str]) -> bool:
    """Whether a sentence with phrases of these kinds declines to answer.

    Some phrases do by themselves. Others do if the speaker says so of speaking, or if it is said of what was asked; and so does a
    speaker who denies to be able, allowed or willing to speak, or turns it down. That somebody else may not do something, or that a
    letter stays without an answer, is matter like any other.
    """
    if "refusal" in kinds:
        return True
    have = set(seq)
    asked = bool(have & W.ASKED)
    if not have & W.SPEAKER:
        return "half" in kinds and asked
    own = asked or bool(have & W.SPEAKING)
    pointed = own or bool(have & W.POINTING)
    if "half" in kinds and pointed or pointed and have & W.TURNED_DOWN:
        return True
    return bool(own and have & W.DENYING and have & (W.SUBJECT | W.ABLE))


def is_refusal(answer: str) -> bool:
    """Every sentence declines, apologises or offers other help, and one at least declines; other bits are fewer words than that."""
    refused = bits = 0
    for seq in _statements(answer):
        if not seq:
            continue
        kinds = {k for _, held in _phrases().iter(f" {' '.join(seq)} ") for k in held}
        if declines(seq, kinds):
            refused += len(seq)
        elif not _says_nothing(seq, "filler" in kinds):
            if len(seq) > 4:
                return False
            bits += len(seq)
    return refused > bits


def is_copy(prompt: list[str], answer: list[str], head: list[str] | None = None) -> bool:
    """The answer is the prompt, whole or nearly so, once or more, and nothing else.

    ``head`` is the prompt's instruction: if it asks for a repetition or a correction, an answer that leaves the
    instruction out is what was asked for.
    """
    if not prompt or not answer:
        return False
    if prompt == answer:
        return True
    if head and set(W.REPEAT) & set(head) and not set(head) <= set(answer[: 2 * len(head)]) and len(set(head) - set(answer)) > len(set(head)) / 2:
        return False
    # words that both sides have bound what runs can cover, so most pairs need no automaton
    if sum(map(set(prompt).__contains__, answer)) < (COPIED - 0.15) * len(answer) or sum(map(set(answer).__contains__, prompt)) < TAKEN * len(prompt):
        return False
    least = min(RUN - (min(len(prompt), len(answer)) < 12), len(prompt), len(answer))
    own = SuffixAutomaton(prompt).covered(answer, least)
    return (own >= COPIED or own >= COPIED - 0.15 and (1 - own) * len(answer) < FRAME + 0.5) and SuffixAutomaton(answer).covered(prompt, least) >= TAKEN


def is_other_language(prompt_text: str, prompt: list[str], answer: str) -> bool:
    """Most of the answer is in a language that is neither the prompt's nor one it asks for."""
    prose = _FENCE.sub(" ", answer)
    seq = words(prose)
    got = votes(prose, seq)
    if not got:
        return False
    lang = max(got, key=lambda k: got[k])
    asked = {k for k, names in W.LANGUAGE_NAMES.items() if set(names.split()) & set(prompt)}
    if lang in asked or (not asked and set(W.TRANSLATE) & set(prompt)):
        return False
    own = votes(prompt_text, prompt)
    home = max(own, key=lambda k: own[k]) if own else None
    if lang == home or got[lang] < 2:
        return False
    if lang not in W.STOPWORDS and (home is None or home in W.STOPWORDS):
        # another script than the prompt's: few letters of it are names or signs
        return bool(prompt) and got[lang] >= 1.6 * got.get(home, 0) + 0.5
    if home is None or own[home] < own.get(lang, 0) + 0.4:
        return False
    return got[lang] >= 1.6 * got.get(home, 0) + 0.5


def _left_open(text: str) -> bool:
    """Whether JSON or code outside fences has an opening bracket in any line that is never closed."""
    text = _FENCE.sub(" ", text)
    lines = [x for x in text.split("\n") if x.strip()]
    if not _JSON.match(text) and 2 * sum(bool(_CODE_LINE.search(x)) for x in lines) <= len(lines):
        return False
    stack: list[str] = []
    for c in _QUOTED.sub("", text):
        if c in "([{":
            stack.append(c)
        elif c in ")]}" and stack and stack[-1] == _PAIRS[c]:
            stack.pop()
    return bool(stack)


def asks_fact(prompt: list[str]) -> bool:
    """Whether a question begins as those do that a few words answer."""
    head = " ".join(prompt[:5]) + " "
    return any(head.startswith(f"{f} ") for f in W.FACTS)


def is_truncated(answer: str, prompt: list[str] | None = None) -> bool:
    """An open code fence, code or JSON with a bracket left open, or prose whose last line stops without an end mark.

    A single phrase without a mark is whole if the prompt asks for a fact and the phrase doesn't end with a word after which a sentence goes on.
    """
    if answer.count("```") % 2:
        return True
    text = _SIGNATURE.sub("", _INVISIBLE.sub("", answer).rstrip()).rstrip()
    while text and text[-1] != "`" and (unicodedata.category(text[-1]) in ("So", "Sk", "Mn", "Cf", "Cs") or text[-1] in "*_~ \t\n\r"):
        text = text[:-1]
    if not text or text.endswith("```"):
        return False
    if _left_open(text):
        return True
    line = text.rsplit("\n", 1)[-1]
    stack: list[str] = []
    for c in line:
        if c in _OPEN:
            stack.append(c)
        elif c in _PAIRS and stack and stack[-1] == _PAIRS[c]:
            stack.pop()
    ended = text.rstrip(")]}\"'”»’“」』*_ ")
    if ended and ended[-1] in _END and not (stack and stack[-1] in "([{" and ended == text):
        return False
    if text[-1] in ")]}”»" and not stack:
        return False
    n = len(line.split())
    if not stack and _CODE_LINE.search(line) and text[-1] in ";}" and "\n" not in text:
        return False
    if prompt and "\n" not in text and n <= 12 and text[-1].isalnum() and not any(c in text for c in _END) and asks_fact(prompt):
        last = words(line)[-1:]
        return not last or last[0] in W.LINKS
    if _ITEM.match(line):
        others = [x.rstrip() for x in text.split("\n")[:-1] if _ITEM.match(x)]
        return bool(stack) or n > 8 or 2 * sum(x[-1] in _END for x in others) > len(others)
    if text[-1] in ",;:(" or text[-1] in "-–—" and n > 1 or stack and n > 1:
        return True
    return n >= 4 and sum(c.isalpha() for c in line) > len(line) / 2


def defect(prompt: str | None, answer: str | None) -> str | None:
    """The defect of a pair, or nothing. No answer is empty; no prompt can't be copied or be in another language."""
    prompt, answer = prompt or "", answer or ""
    asked = words(prompt)
    if is_empty(asked, answer):
        return "empty"
    answer = _THOUGHT.sub(" ", answer).strip()
    if is_refusal(answer):
        return "refusal"
    if is_copy(asked, words(answer), words(_HEAD.split(prompt, maxsplit=1)[0])):
        return "copy"
    if is_other_language(prompt, asked, answer):
        return "language"
    if is_truncated(answer, asked):
        return "truncated"
    return None


def broken_pairs(df: DataFrame, example_id: str = "example_id", prompt: str = "_prompt", response: str = "_response") -> DataFrame:
    """(example_id, defect) of every example whose last prompt turn and response are defective.

    A null or empty response has the defect ``empty``; several response turns count as one text; null contents as empty.
    A null or empty prompt leaves the tests that need none. Repeated examples come out each. Texts of any length are read
    whole, in time proportional to it. Other columns play no part.
    """
    asked = F.when(F.size(prompt) > 0, F.element_at(F.col(prompt), -1)["content"])
    said = F.array_join(F.transform(F.col(response), lambda t: t["content"]), "\n")
    schema = pa.schema([("example_id", pa.int64()), ("defect", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [defect(p, a) for p, a in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            out = pa.array(found, pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), out], schema=schema).filter(out.is_valid())

    rows = df.select(F.col(example_id).cast("bigint").alias("example_id"), asked.alias("asked"), said.alias("said"))
    return rows.mapInArrow(run, "example_id bigint, defect string")
