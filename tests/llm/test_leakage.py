import random

from corpusloom.llm import leakage as L


def brute(documents, items, least):
    """Pairs by the definition: a maximal common run of at least ``least`` words that no other item has."""
    texts = [(i, L.words(t)) for i, *ts in items for t in ts]
    out = set()
    for d, text in documents:
        w = L.words(text)
        spans = []
        for i, t in texts:
            for a in range(len(w)):
                for b in range(len(t)):
                    if w[a] == t[b] and (a == 0 or b == 0 or w[a - 1] != t[b - 1]):
                        n = 0
                        while a + n < len(w) and b + n < len(t) and w[a + n] == t[b + n]:
                            n += 1
                        if n >= least:
                            spans.append((a, a + n, i))
        for a, b, i in spans:
            if not any(x <= a and b <= y and j != i for x, y, j in spans):
                out.add((d, i))
    return out


def test_against_brute_force(spark):
    r = random.Random(3)
    vocabulary = [f"w{k}" for k in range(40)]
    shared = [r.choice(vocabulary) for _ in range(14)]
    items = []
    for i in range(12):
        own = [r.choice(vocabulary) for _ in range(r.randint(3, 30))]
        items.append((i, " ".join(own), " ".join(shared if i % 3 == 0 else own[:6])))
    items += [(50, None, None), (51, "", "too short")]
    documents = []
    for d in range(60):
        parts = [r.choice(vocabulary) for _ in range(r.randint(0, 20))]
        source = r.choice(items[:12])
        words = r.choice([source[1], source[2]]).split()
        k = r.randint(0, max(0, len(words) - 5))
        parts[len(parts) // 2 : len(parts) // 2] = words[k : k + r.randint(4, 30)]
        documents.append((d, " ".join(parts)))
    documents += [(97, None), (98, ""), (99, items[1][1]), (99, items[1][1])]
    docs = spark.createDataFrame([(*x, "clash") for x in documents], "doc_id bigint, text string, item_id string")
    held = spark.createDataFrame([(*x, "clash") for x in items], "item_id bigint, passage string, question string, doc_id string")
    for least in (6, 12):
        got = L.leaked_items(docs, held, least=least).collect()
        assert {(x["doc_id"], x["item_id"]) for x in got} == brute(documents, items, least)
        assert all(x["longest"] >= least and 0 < x["share"] <= 1 for x in got)
    assert L.leaked_items(docs.limit(0), held).count() == 0
    assert L.leaked_items(docs, held.limit(0)).count() == 0


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    texts = [" ".join(f"a{i}b{k}" for k in range(15)) for i in range(20)]
    items = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "item_id bigint, passage string, question string")
    docs = spark.createDataFrame([(i, f"x {t} y") for i, t in enumerate(texts)], "doc_id bigint, text string")
    whole = {(x["doc_id"], x["item_id"]) for x in L.leaked_items(docs, items).collect()}
    monkeypatch.setattr(L, "ITEM_LIMIT", 600)
    assert {(x["doc_id"], x["item_id"]) for x in L.leaked_items(docs, items).collect()} == whole == {(i, i) for i in range(20)}


def test_words_whatever_the_typography():
    plain = L.words("The efficient naive reader keeps 42 state of the art kilograms")
    for text in ("THE  eﬃcient naïve reader, keeps 42 state-of-the-art kilograms!", "> the effi-\n> cient naïve\r\n| reader\xa0keeps “42” state of the art kilo­grams", "the efficient naive reader keeps 42 state of the art kilo‐\n  * grams"):
        assert L.words(text) == plain
    assert L.words(None) == []


def test_tiles_take_the_longest_first():
    import numpy as np

    text = np.arange(1, 31, dtype=np.uint64)
    document = np.concatenate([text[20:30], text[0:20]])
    seeds = [(d, t) for d in range(26) for t in range(26) if (document[d : d + 5] == text[t : t + 5]).all()]
    assert L.tiles(document, text, seeds, 5) == [(0, 20, 10), (10, 0, 20)]


def test_run_hashes_tell_runs_apart():
    import numpy as np

    codes = L.mixed(np.array([random.Random(1).randrange(50) for _ in range(3000)], np.uint64))
    for n in (1, 2, 3, 7, 12):
        h = L.run_hashes(codes, n)
        assert len(h) == 3000 - n + 1
        by = {}
        for i, x in enumerate(h.tolist()):
            by.setdefault(x, set()).add(tuple(codes[i : i + n].tolist()))
        assert all(len(v) == 1 for v in by.values())
    assert len(L.run_hashes(codes[:3], 12)) == 0


def test_very_long_documents(spark):
    item = " ".join(f"k{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "filler words " * 200_000 + item)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, item, None)], "item_id bigint, passage string, question string")
    assert L.leaked_items(docs, items).first()["longest"] == 40


def test_a_run_shared_by_items_of_different_blocks_is_no_leak(spark, monkeypatch):
    closing = " ".join(f"closing{k}" for k in range(14))
    texts = [" ".join(f"a{i}b{k}" for k in range(15)) for i in range(20)]
    items = spark.createDataFrame([(i, f"{t} {closing}", None) for i, t in enumerate(texts)] + [(90, None, closing)], "item_id bigint, passage string, question string")
    docs = spark.createDataFrame([(i, f"x {t} y") for i, t in enumerate(texts)] + [(50, f"x {closing} y {closing} z"), (51, f"{texts[3]} {closing}"), (51, f"{texts[3]} {closing}"), (None, f"{texts[4]} and no more")], "doc_id bigint, text string")
    whole = sorted((tuple(x) for x in L.leaked_items(docs, items).collect()), key=str)
    assert {x[0] for x in whole} == {*range(20), 51, None}
    monkeypatch.setattr(L, "ITEM_LIMIT", 600)
    assert sorted((tuple(x) for x in L.leaked_items(docs, items).collect()), key=str) == whole


def test_the_filter_of_runs_misses_none(monkeypatch):
    import random

    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(draw.choice(vocabulary) for _ in range(40)) for _ in range(50)]
    for power in (29, 10):
        monkeypatch.setattr(L, "FILTER_POWER", power)
        flt, codes = L.RunFilter(iter([*texts, None, "short"]), 50 * 40, 12), L.WordCodes()
        assert all(flt.any(f"before it {' '.join(t.split()[5:20])} and behind", codes) for t in texts)
        others = [" ".join(draw.choice(vocabulary) for _ in range(60)) for _ in range(100)]
        assert power == 10 or sum(flt.any(t, codes) for t in others) < 10
        assert not flt.any(None, codes)
