import random

from corpusloom.operators import blocks, ordinals


def spans(sizes, target, fewest, left):
    out, first, length = [], 0, 0
    if len(sizes) < fewest or any(n > 512 for n in sizes):
        return out
    for i, n in enumerate(sizes):
        length += n
        remain = len(sizes) - i - 1
        if (length >= target and remain >= left and i + 1 - first >= fewest) or not remain:
            out.append((first, i + 1))
            first, length = i + 1, 0
    return out


def test_blocks_against_a_walk(spark):
    r = random.Random(3)
    rows = [(d, [r.choice([5, 20, 80, 80, 500, 600 if d % 9 == 0 else 3]) for _ in range(r.randint(0, 20))], r.randint(0, 30)) for d in range(80)] + [(100, None, 0)]
    df = spark.createDataFrame(rows, "doc int, sizes array<int>, title int")
    got = {}
    for x in blocks.sentence_blocks(df, "doc", "sizes", 200).orderBy("doc", "block").collect():
        got.setdefault(x["doc"], []).append((x["first"], x["last"]))
    assert got == {d: spans(s, 200, 2, 2) for d, s, _ in rows if s and spans(s, 200, 2, 2)}
    short = blocks.sentence_blocks(df, "doc", "sizes", 200, short=0.5).collect()
    assert {x["target"] == 200 for x in short} == {True, False}
    for single in (False, True):
        k = 1 if single else 2
        titled = blocks.titled_blocks(df, "doc", "sizes", "title", 150, single).orderBy("block_id").collect()
        want = [(d, *b) for d, s, t in rows if s for b in spans(s, 150 - t, k, k)]
        assert [(x["doc"], x["first"], x["last"]) for x in titled] == want
        assert [x["block_id"] for x in titled] == list(range(len(want)))


def test_repeated_orders(spark):
    d = spark.range(10).withColumnRenamed("id", "i")
    plain = ordinals.repeated_order(d, "i", 25, 1, shuffle=False, pad_to=4).orderBy("pos").collect()
    assert [x["i"] for x in plain] == (list(range(10)) + [0, 1]) * 3 or sorted(x["i"] for x in plain[:12]) == sorted([*range(10), 0, 1])
    assert [x["pos"] for x in plain] == list(range(36))
    mixed = ordinals.repeated_order(d, "i", 20, 1).orderBy("pos").collect()
    assert sorted(x["i"] for x in mixed[:10]) == list(range(10)) == sorted(x["i"] for x in mixed[10:])
    whole = ordinals.repeated_order(d, "i", 20, 1, reshuffle=True).orderBy("pos").collect()
    assert sorted(x["i"] for x in whole) == sorted([*range(10)] * 2)
    assert ordinals.repeated_order(d.limit(0), "i", 5, 1).count() == 0
