"""Statistics of whole texts, computed for an Arrow batch of documents at a time.

Characters are counted on the UTF-8 buffer through lookup tables, words and lines with Arrow's kernels, so no Python
object is made for a word or a line.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Frequent words of English, German, French and Spanish (fixed values).
COMMON = (
    "the of and to in that is for with was on are as by it this be from at which or an have has not what how why does should we you your were when if than more but most will would can could they there their its our been before after since because although however while given all one so no into only did "
    "der die das und ist nicht ein eine einen zu den von mit sich auf für im dem des wird werden wurde wurden dass wir auch nach bei aus sind oder wie warum wenn weil aber zur zum zwischen ohne kann hat als an noch nur seit durch über was dann alle sie er "
    "le la les et est pas un une du que qui dans pour par sur au aux ce cette il elle nous vous sont ont été plus ne se avec mais ou où alors entre après parce sans selon tant on depuis doit encore si en "
    "el los las y es una por con para no del al lo su como más pero o cuando sobre porque esta este entonces según desde debe son fue muy también hay ya nos cada sus deben"
).split()

NAMES = (
    "n_words", "n_lines", "mean_word", "words_per_line", "long_line_share", "short_line_share", "line_spread",
    "common_share", "prose_share", "end_share", "sentence_end_share", "sentences_per_word", "mark_share", "key_share", "leader_share",
    "number_end_share", "symbol_ratio", "digit_ratio", "upper_ratio", "space_ratio", "tab_ratio", "bar_ratio", "comma_ratio", "semicolon_ratio",
    "equal_ratio", "colon_ratio", "angle_ratio", "brace_ratio", "dash_ratio", "slash_ratio", "vowel_ratio", "other_ratio",
    "unique_words", "unique_lines", "repeat_share", "number_words", "single_words", "long_words", "mixed_words", "broken_ratio",
    "cell_share", "cell_evenness", "lower_start_share", "log_words", "option_share", "markup_cells", "menu_words", "rich_words", "paragraph_share", "script_marks",
)

#: Statistics that say how long a text is rather than what it is like; the trees don't see them.
SIZES = ("n_words", "n_lines", "log_words", "unique_words")


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[list(chars)] = 1
    return t


_LOWER, _UPPER, _DIGIT = _table(b"abcdefghijklmnopqrstuvwxyz"), _table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table(b"0123456789")
_SPACE = _table(b" \t\n\r")
_CHAR = np.ones(256, np.uint8)
_CHAR[128:192] = 0
# lead bytes of letters beyond ASCII, and of signs: Latin-1 signs begin with C2, general punctuation with E2
_WIDE, _SIGN = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
_WIDE[0xC3:0xE2] = 1
_WIDE[0xE3:0xF0] = 1
_SIGN[[0xC2, 0xE2, *range(0xF0, 256)]] = 1
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_VOWEL = _table(b"aeiouyAEIOUY")
_SETS = {"tab": b"\t", "bar": b"|&\\", "comma": b",", "semicolon": b";", "equal": b"=", "colon": b":", "angle": b"<>", "brace": b"{}[]", "dash": b"-_", "slash": b"/+"}
_TABLES = np.stack([_CHAR, _SYMBOL + _SIGN, _DIGIT, _UPPER, _SPACE, _VOWEL, _LOWER + _UPPER, _SIGN, *(_table(v) for v in _SETS.values())])
_LINE_BREAKS = "\\r\\n?|[\\x0b\\x0c\\x{85}\\x{2028}\\x{2029}]"
_OPTION = r"^--?[A-Za-z][\w-]*(?:[ =]|$)"
# Words of page navigation (fixed values).
_MENU = pa.array("home menu login logout help cookies share export cite pdf top next back previous prev search register contact about privacy terms sitemap download print subscribe close accept more news account settings skip toggle navigation".split())
_MARK = r"^(?:\[[ xX]?\]\s|[-*•+–·▪◦‣○■]\s|\(?[0-9]{1,3}(?:\.[0-9]{1,3})*[.)\]]?\s|\(?[A-Za-z][.)]\s|\[[0-9]{1,4}\]|--?[a-z])"
# What markup, style sheets, scripts and page description files leave behind (fixed values).
_SCRIPT = r"<(?:div|span|script|style|link|meta|iframe)\b|\{[\w-]+:[^{}\n]*\}|\bvar _|\bfunction\s*\(|[0-9] obj\b|endobj|endstream"
_KEY = r"^[\pL\pN_ .\-]{1,28}(?:[:=]\s*|\t\s*)\S"
_ENDS = r"""[.!?…:;,]["”»'’)\]*_]*$"""
_SENTENCE_END = r"""[.!?…]["”»'’)\]*_]*$"""
_COMMON = pa.array(sorted(set(COMMON)))


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, values, n)[:n] if len(owner) else np.zeros(n)


def features(texts: pa.Array) -> np.ndarray:
    """One row of statistics, in the order of NAMES, for each text; a null or blank one has only zeros."""
    n = len(texts)
    out = np.zeros((n, len(NAMES)))
    if not n:
        return out
    clean = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), _LINE_BREAKS, "\n")
    # characters
    data = np.frombuffer(clean.buffers()[2] or b"", np.uint8)
    offsets = np.frombuffer(clean.buffers()[1], np.int64)[clean.offset : clean.offset + n + 1]
    counts = np.zeros((len(_TABLES), n))
    for k, t in enumerate(_TABLES):
        c = np.zeros(len(data) + 1, np.int64)
        np.cumsum(t[data], out=c[1:])
        counts[k] = c[offsets[1:]] - c[offsets[:-1]]
    chars, symbols, digits, upper, spaces, vowels, letters, signs, *sets = counts
    one = np.maximum(chars, 1)
    ink = np.maximum(chars - spaces, 1)
    # lines
    split = pc.split_pattern(clean, "\n")
    owner = pc.list_parent_indices(split).to_numpy().astype(np.int64)
    lines = pc.utf8_trim_whitespace(split.flatten())
    size = pc.utf8_length(lines).to_numpy().astype(np.int64)
    full = size > 0
    lines, owner, size = lines.filter(pa.array(full)), owner[full], size[full]
    m = len(lines)
    n_lines = np.bincount(owner, minlength=n).astype(float)
    per = np.maximum(n_lines, 1)

    def share(pattern: str) -> tuple[np.ndarray, np.ndarray]:
        hit = pc.match_substring_regex(lines, pattern).to_numpy(zero_copy_only=False)
        return hit, _sums(hit, owner, n) / per

    _, ends = share(_ENDS)
    _, sentence_ends = share(_SENTENCE_END)
    _, marks = share(_MARK)
    _, keys = share(_KEY)
    _, leaders = share(r"\.{4,}|(?:\. ){4,}")
    _, numbers = share(r"[0-9][0-9.,%f\-–)]*$")
    _, options = share(_OPTION)
    _, lower_start = share(r"^\p{Ll}")
    bare_lines = pc.utf8_ltrim(lines, ">|#* ")
    cells_in = pc.count_substring_regex(bare_lines, r"[|\t]| & |,\S|;\S|=[^=;(){}<>]{0,40};\s|</t[dh]>|\S\s{2,}\S")
    cells = cells_in.to_numpy().astype(np.float64)
    codes = pc.replace_substring_regex(lines, "[0-9]+", "").dictionary_encode().indices.to_numpy().astype(np.int64)
    unique_lines = np.bincount(np.unique(owner * (m + 1) + codes) // (m + 1), minlength=n)[:n] if m else np.zeros(n)
    # words
    tokens = pc.utf8_split_whitespace(lines)
    line_of = pc.list_parent_indices(tokens).to_numpy().astype(np.int64)
    raw = tokens.flatten()
    bare = pc.utf8_lower(pc.utf8_trim(raw, "\"'.,;:!?()[]{}<>*_`“”„«»‘’…|#¿¡—–-=/\\&%$+~^@"))
    width = pc.utf8_length(bare).to_numpy().astype(np.int64)
    word = width > 0
    bare, line_of, width = bare.filter(pa.array(word)), line_of[word], width[word]
    doc_of = owner[line_of] if m else line_of
    w = len(bare)
    n_words = np.bincount(doc_of, minlength=n).astype(float)
    words = np.maximum(n_words, 1)
    common = pc.is_in(bare, value_set=_COMMON.cast(bare.type)).to_numpy(zero_copy_only=False)
    number = pc.match_substring_regex(bare, r"^[0-9][0-9.,:eE/\-]*$").to_numpy(zero_copy_only=False)
    menu = pc.is_in(bare, value_set=_MENU.cast(bare.type)).to_numpy(zero_copy_only=False)
    mixed = pc.match_substring_regex(bare, r"[0-9][a-z_\pL]|[a-z\pL][0-9]|[a-z][{}<>=/+_][a-z0-9]").to_numpy(zero_copy_only=False)
    word_code = bare.dictionary_encode().indices.to_numpy().astype(np.int64)
    unique_words = np.bincount(np.unique(doc_of * (w + 1) + word_code) // (w + 1), minlength=n)[:n] if w else np.zeros(n)
    same = np.zeros(w)
    if w > 1:
        same[1:] = (word_code[1:] == word_code[:-1]) & (doc_of[1:] == doc_of[:-1])
    line_words = np.bincount(line_of, minlength=m).astype(float)
    line_common = np.bincount(line_of, common, m)
    # a line of prose: words enough, of which some are common, few separators
    prose = (line_words >= 4) & (line_common >= 0.16 * line_words) & (cells <= 0.34 * line_words)
    mean_words = n_words / per
    spread = np.sqrt(np.maximum(_sums(line_words**2, owner, n) / per - mean_words**2, 0))
    celled = cells >= 1
    mean_cells = _sums(cells, owner, n) / per
    cell_spread = np.sqrt(np.maximum(_sums(cells**2, owner, n) / per - mean_cells**2, 0))
    broken = sum(pc.count_substring(clean, x).to_numpy().astype(np.float64) for x in ("Ã", "Â", "â€", "�", "Ð", "Ñ"))
    stops = pc.count_substring_regex(clean, r"[.!?…]+[\"”»)]*\s").to_numpy().astype(np.float64)
    columns = {
        "n_words": n_words,
        "n_lines": n_lines,
        "mean_word": _sums(width, doc_of, n) / words,
        "words_per_line": mean_words,
        "long_line_share": _sums(np.where(line_words >= 7, line_words, 0), owner, n) / words,
        "short_line_share": _sums(line_words <= 4, owner, n) / per,
        "line_spread": spread / np.maximum(mean_words, 1),
        "common_share": _sums(common, doc_of, n) / words,
        "prose_share": _sums(np.where(prose, line_words, 0), owner, n) / words,
        "end_share": ends,
        "sentence_end_share": sentence_ends,
        "sentences_per_word": stops / words,
        "mark_share": marks,
        "key_share": keys,
        "leader_share": leaders,
        "number_end_share": numbers,
        "symbol_ratio": symbols / ink,
        "digit_ratio": digits / ink,
        "upper_ratio": upper / np.maximum(letters, 1),
        "space_ratio": spaces / one,
        **{f"{k}_ratio": v / one for k, v in zip(_SETS, sets, strict=True)},
        "vowel_ratio": vowels / np.maximum(letters, 1),
        "other_ratio": signs / ink,
        "unique_words": unique_words / words,
        "unique_lines": unique_lines / per,
        "repeat_share": _sums(same, doc_of, n) / words,
        "number_words": _sums(number, doc_of, n) / words,
        "single_words": _sums(width == 1, doc_of, n) / words,
        "long_words": _sums(width > 22, doc_of, n) / words,
        "mixed_words": _sums(mixed, doc_of, n) / words,
        "broken_ratio": broken / one,
        "cell_share": _sums(celled, owner, n) / per,
        "cell_evenness": np.where(mean_cells > 0, mean_cells / (mean_cells + cell_spread + 1e-9), 0),
        "lower_start_share": lower_start,
        "log_words": np.log1p(n_words),
        "option_share": options,
        "markup_cells": pc.count_substring_regex(clean, "</t[dh]>").to_numpy().astype(np.float64) / words,
        "menu_words": _sums(menu, doc_of, n) / words,
        "paragraph_share": _sums(np.where(prose & (line_words >= 14), line_words, 0), owner, n) / words,
        "script_marks": pc.count_substring_regex(clean, _SCRIPT).to_numpy().astype(np.float64) / words,
        "rich_words": unique_words / np.sqrt(words),
    }
    for k, name in enumerate(NAMES):
        out[:, k] = columns[name]
    return out
