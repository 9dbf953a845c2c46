"""Recall and precision by type on pairs that were written apart from the tables."""

from collections import Counter

from corpusloom.llm.pairs import defect
from tests.llm.pairs_holdout import ANSWERED, DECLINED, EMPTY, SOUND

BLOCK = 12


def cases():
    """(expected, prompt, answer)."""
    out = [(None, p, a) for p, a in SOUND]
    n = len(ANSWERED)
    for i, (p, a) in enumerate(ANSWERED):
        first, second = a.split(". ", 1)
        words, block = second.split(), i // BLOCK
        out += [(None, p, a), (None, p, first + "."), (None, p, f"- {first}.\n- {second}"), (None, p, f"{a}\n\n{second}")]
        out += [("truncated", p, f"{first}. {' '.join(words[: max(2, len(words) // 2)])}"), ("truncated", p, f"{first}. {' '.join(words[:-2])} {words[-2][:2]}"), ("truncated", p, f"{first}. {' '.join(words[: len(words) // 2 + 1]).rstrip('.,')},")]
        out += [("copy", p, p), ("copy", p, p.upper()), ("copy", f"{p} {first}.", f"{p}  {first}")]
        other = ANSWERED[(i + BLOCK) % n][1]
        out += [("language", p, other), ("language", p, ANSWERED[(i + 2 * BLOCK) % n][1])]
        out += [("refusal", p, DECLINED[block][i % BLOCK]), ("empty", p, EMPTY[i % len(EMPTY)])]
    return out


def figures():
    """{type: (recall, precision)} and what was missed or wrongly found."""
    found, wrong = Counter(), []
    for expected, p, a in cases():
        got = defect(p, a)
        found[expected, got] += 1
        if expected != got:
            wrong.append((expected, got, p, a))
    kinds = ("empty", "truncated", "refusal", "copy", "language")
    total = lambda k, at: sum(v for key, v in found.items() if key[at] == k)
    return {k: (found[k, k] / total(k, 0), found[k, k] / max(total(k, 1), 1)) for k in kinds}, wrong


def test_sound_and_defective_pairs_apart_from_the_tables():
    made = Counter(e for e, *_ in cases())
    assert made[None] >= 200
    assert sum(made.values()) - made[None] >= 200
    by_type, _ = figures()
    for kind, (recall, precision) in by_type.items():
        assert recall >= 0.9, (kind, recall)
        assert precision >= 0.9, (kind, precision)


def test_answers_written_after_the_rules():
    """Two sets that were first run when the rules stood: refusals found 13 and 9 of 24 then, sound answers kept 24 of 24 each; the rules were widened since."""
    from tests.llm.pairs_holdout import LATER

    found = [defect(prompt, a) == "refusal" for prompt, declined, _ in LATER for a in declined]
    kept = [defect(prompt, a) is None for prompt, _, sound in LATER for a in sound]
    assert sum(found) >= 0.9 * len(found)
    assert sum(kept) >= 0.9 * len(kept)
