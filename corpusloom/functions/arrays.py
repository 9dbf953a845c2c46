"""Functions of token arrays as higher-order column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORE = -100


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, not anew in each call of an inner lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _positions(c: Column) -> Column:
    """0 .. n-1 for an array of n elements, also if n is 0."""
    return F.filter(F.sequence(F.lit(0), F.size(c)), lambda i: i < F.size(c))


def positions_where(c: Column, value: int | Column) -> Column:
    """The positions, from 0, at which the array has ``value``."""
    return let(c, lambda v: F.filter(_positions(v), lambda i: F.get(v, i) == value))


def pad_to_multiple(c: Column, multiple: int, filler: int, room_for_end: bool = False) -> Column:
    """Filled up to the next multiple, by a whole block where it is one already; by one less where an end token follows."""
    n = (F.floor(F.size(c) / multiple) + 1) * multiple - F.size(c) - (1 if room_for_end else 0)
    return F.concat(c, F.array_repeat(F.lit(filler), n.cast("int")))


def append_end(c: Column, end: int) -> Column:
    return F.concat(c, F.array(F.lit(end)))


def masked(source: Column, target: Column) -> Column:
    """Labels of a prompt and its answer: -100 over the prompt."""
    return F.concat(F.transform(source, lambda _: F.lit(IGNORE)), target)


def span_labels(c: Column, begin: int, end: int) -> Column:
    """Labels that copy the tokens from the k-th begin marker to the k-th end marker and are -100 elsewhere.

    Both markers' positions rise, so each end closes a stretch that begins behind the one before: one pass, however many spans.
    """
    zipped = F.arrays_zip(positions_where(c, begin).alias("b"), positions_where(c, end).alias("e"))
    spans = F.filter(zipped, lambda s: s["b"].isNotNull() & s["e"].isNotNull())

    def stretch(all_: Column, s: Column, k: Column) -> Column:
        low, high = F.when(k == 0, F.lit(0)).otherwise(F.get(all_, k - 1)["e"] + 1), s["e"] + 1
        from_ = F.least(F.greatest(s["b"], low), high)
        return F.concat(F.array_repeat(F.lit(IGNORE), from_ - low), F.slice(c, from_ + 1, high - from_))

    done = lambda all_: F.when(F.size(all_) > 0, F.get(all_, F.size(all_) - 1)["e"] + 1).otherwise(F.lit(0))
    rest = lambda all_: F.array(F.array_repeat(F.lit(IGNORE), F.size(c) - done(all_)))
    return let(spans, lambda all_: F.flatten(F.concat(F.transform(all_, lambda s, k: stretch(all_, s, k)), rest(all_))))


def shifted(c: Column) -> tuple[Column, Column]:
    """Inputs and next-token labels: all but the last, all but the first."""
    n = F.greatest(F.size(c) - 1, F.lit(0))
    return F.slice(c, F.lit(1), n), F.slice(c, F.lit(2), n)


def loss_mask(labels: Column, end: int | None = None, pad: int | None = None) -> Column:
    """1 where a label counts: not at ``end`` (if given) nor at ``pad``."""
    out = lambda x: (F.lit(False) if end is None else x == end) | (F.lit(False) if pad is None else x == pad)
    return F.transform(labels, lambda x: F.when(out(x), 0).otherwise(1))


def zero_padding(c: Column, pad: int) -> Column:
    return F.transform(c, lambda x: F.when(x == pad, 0).otherwise(x))


def filled_to(c: Column, n: int, filler: int) -> Column:
    """Filled at the tail to ``n`` elements."""
    return F.concat(c, F.array_repeat(F.lit(filler), F.greatest(F.lit(n) - F.size(c), F.lit(0))))


def _lengths(c: Column, end: int) -> Column:
    """Lengths of the stretches that end with an end token, and of what is behind the last one (maybe 0)."""
    bounds = F.concat(F.array(F.lit(0)), F.transform(positions_where(c, end), lambda i: i + 1), F.array(F.size(c)))
    return let(bounds, lambda b: F.transform(F.slice(b, F.lit(2), F.size(b) - 1), lambda e, k: e - F.get(b, k)))


def _counted(n: Column) -> Column:
    """0 .. n-1, also if n is 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def segments(c: Column, end: int) -> Column:
    """For each token the number of end tokens before it."""
    return F.flatten(F.transform(_lengths(c, end), lambda n, k: F.array_repeat(k, n)))


def positions_after_end(c: Column, end: int) -> Column:
    """Position ids that begin anew behind each end token."""
    return F.flatten(F.transform(_lengths(c, end), lambda n: _counted(n)))


def sequence_ends(c: Column, end: int) -> Column:
    """One past each end token, and the length unless the last token is one."""
    ends = F.transform(positions_where(c, end), lambda i: i + 1)
    return F.when((F.size(c) > 0) & (F.get(c, F.size(c) - 1) != end), F.concat(ends, F.array(F.size(c)))).otherwise(ends)


def ends_from_positions(c: Column) -> Column:
    """From position ids: where they are 0 but for the first, and the length."""
    return let(c, lambda v: let(positions_where(v, 0), lambda z: F.concat(F.slice(z, F.lit(2), F.greatest(F.size(z) - 1, F.lit(0))), F.array(F.size(v)))))


def shifted_ends(ends: Column, by: int, length: Column | int) -> Column:
    """Segment ends for a later prediction: less by ``by`` but at multiples of the length."""
    return F.transform(ends, lambda e: F.when(e % length == 0, e).otherwise(e - by))


def packed_positions(mask: Column) -> Column:
    """Position ids of packed segments numbered from 1, 0 for the padding at the tail."""
    size = lambda b, k: F.get(b, k + 1) - F.get(b, k)
    bounds = lambda m: F.concat(F.filter(_positions(m), lambda i: (i == 0) | (F.get(m, i) != F.get(m, i - 1))), F.array(F.size(m)))
    made = lambda m, b: F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda i, k: F.when(F.get(m, i) == 0, F.array_repeat(F.lit(0), size(b, k))).otherwise(_counted(size(b, k))))
    return let(mask, lambda m: let(bounds(m), lambda b: F.flatten(made(m, b))))


def prompt_runs(labels: Column) -> Column:
    """(begin, end) of every maximal run of -100; the end of a run at the tail is null."""

    def runs(y: Column) -> Column:
        is_ = lambda i: F.get(y, i) == IGNORE
        begins = F.filter(_positions(y), lambda i: is_(i) & ((i == 0) | (F.get(y, i - 1) != IGNORE)))
        ends = F.filter(_positions(y), lambda i: (i > 0) & ~is_(i) & (F.get(y, i - 1) == IGNORE))
        return F.arrays_zip(begins.alias("begin"), ends.alias("end"))

    return let(labels, runs)


def inferred_lengths(source: Column, target: Column, cutoff: Column | int) -> tuple[Column, Column]:
    """Lengths of a prompt and an answer cut to ``cutoff`` together: the longer is cut first, both in proportion."""
    cut = F.lit(cutoff) if isinstance(cutoff, int) else cutoff
    most = F.when(target * 2 < cut, cut).when(source * 2 < cut, cut - source).otherwise(F.floor(cut * (target / F.greatest(source + target, F.lit(1)))).cast("int"))
    new_target = F.least(most, target)
    return F.least(F.greatest(cut - new_target, F.lit(0)), source), new_target


def attention_load(ends: Column, length: int) -> Column:
    """Half the sum of squared segment lengths relative to the squared length."""
    lengths = let(ends, lambda v: F.transform(v, lambda e, i: e - F.when(i == 0, 0).otherwise(F.get(v, i - 1))))
    return 0.5 * F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x * x) / (length * length)


def may_attend(mask: Column, query: Column, key: Column) -> Column:
    """Whether a position sees another under a block-diagonal causal mask: same non-zero segment, not later."""
    return (key <= query) & (F.get(mask, query) == F.get(mask, key)) & (F.get(mask, query) != 0)


def context_chunk(c: Column, rank: int, ranks: int) -> Column:
    """A rank's contiguous share of a sequence."""
    n = F.floor(F.size(c) / ranks).cast("int")
    return F.slice(c, n * rank + 1, n)


def regenerated_positions(c: Column, offset: Column | int = 0) -> Column:
    """Positions before the first zero become 0 .. k-1; a row without zero is less by ``offset``."""
    first = F.array_position(c, 0).cast("int")
    return let(first, lambda f: F.transform(c, lambda x, i: F.when((f > 1) & (i < f - 1), i).when(f == 0, x - offset).otherwise(x)))


def trimmed_tail(ends: Column, batch: int) -> Column:
    """Segment ends up to the ``batch``-th one that is a single step from the next, and the last end; whole if there are fewer such steps."""

    def cut(v: Column) -> Column:
        singles = F.filter(_positions(v), lambda i: F.get(v, i + 1) - F.get(v, i) == 1)
        short = lambda z: F.concat(F.slice(v, F.lit(1), F.get(z, F.lit(batch - 1)) + 1), F.slice(v, F.lit(-1), F.lit(1)))
        return let(singles, lambda z: F.when(F.size(z) >= batch, short(z)).otherwise(v))

    return let(ends, cut)
