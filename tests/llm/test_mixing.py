import itertools
import random

import pytest

from corpusloom.llm import mixing as M
from corpusloom.llm.flow import Network
from corpusloom.llm.token_counts import encoding, VOCABULARY


def brute_cost(n, arcs, source, sink):
    """Greatest flow and its least cost by trying all flows of tiny networks."""
    best = {}
    for flows in itertools.product(*[range(r + 1) for *_, r, _ in arcs]):
        net = [0] * n
        for (a, b, _, _), f in zip(arcs, flows, strict=True):
            net[a] -= f
            net[b] += f
        if all(x == 0 for i, x in enumerate(net) if i not in (source, sink)) and net[sink] >= 0:
            cost = sum(f * c for (*_, c), f in zip(arcs, flows, strict=True))
            best[net[sink]] = min(cost, best.get(net[sink], cost))
    top = max(best)
    return top, best[top]


def test_flow_against_brute_force():
    r = random.Random(7)
    for _ in range(60):
        arcs = [(a, b, r.randint(0, 2), r.randint(0, 4)) for a in range(4) for b in range(4) if a != b and b != 0 and a != 1 and r.random() < 0.6][:8]
        net = Network(4)
        ids = [net.arc(*x) for x in arcs]
        total = net.run(0, 1)
        cost = sum(net.flow(i) * x[3] for i, x in zip(ids, arcs, strict=True))
        assert (total, cost) == brute_cost(4, arcs, 0, 1)


def test_plan_prefers_fresh_texts_and_respects_caps():
    t = {"a": M.Target(0.5, 1), "b": M.Target(0.5, 3)}
    p = M.plan({("a",): 100, ("b",): 20, ("a", "b"): 30}, t, 150)
    assert p.got["a"] <= 130
    assert p.got["b"] <= 3 * 50
    assert sum(p.got.values()) == pytest.approx(150, abs=3)
    repeats = max(-(-b // {("a",): 100, ("b",): 20, ("a", "b"): 30}[k]) for k, v in p.routes.items() for _, _, b in v)
    assert repeats <= 3
    short = M.plan({("a",): 10}, {"a": M.Target(0.5, 2), "gone": M.Target(0.5, None)}, 100)
    assert short.got == {"a": 20, "gone": 0}


def data(spark):
    r = random.Random(2)
    rows, k = [], 0
    for i in range(600):
        text = " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) + str(i) for _ in range(r.randint(1, 30)))
        for s in r.choice([["big"], ["big"], ["small"], ["big", "small"], [None], ["other"], ["big", "big"]]):
            k += 1
            rows.append((k, text, s, 9))
    rows += [(9001, None, "big", 0), (9002, "", "big", 0)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_tokens int")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 4), ("gone", 0.1, 2), (None, 0.1, 1), ("zero", 0.0, 1)], "source string, target_share double, max_repeat int")
    return rows, documents, targets


def test_selection(spark):
    rows, documents, targets = data(spark)
    chosen, report = M.mixed(documents, targets)
    got, about = chosen.collect(), {x["source"]: x for x in report.collect()}
    texts = {i: (t, s) for i, t, s, _ in rows}
    most = {"big": 1, "small": 4}
    assert len({(x["doc_id"], x["source"]) for x in got}) == len(got)
    used = {}
    for x in got:
        text, source = texts[x["doc_id"]]
        assert source == x["source"]
        assert 1 <= x["repeats"] <= most[source]
        used[text, source] = used.get((text, source), 0) + x["repeats"]
    assert all(n <= most[s] for (_, s), n in used.items())
    tokens = encoding(VOCABULARY)
    total = sum(len(tokens.encode_ordinary(t or "")) for _, t, _, _ in rows)
    assert set(about) == {"big", "small", "gone"}
    assert about["gone"]["tokens"] == 0
    for s in ("big", "small"):
        want = sum(x["repeats"] * len(tokens.encode_ordinary(texts[x["doc_id"]][0])) for x in got if x["source"] == s)
        assert about[s]["tokens"] == want
        assert about[s]["tokens"] == pytest.approx(about[s]["routed"], abs=150)
    assert all(x["wanted_total"] == total for x in about.values())
    assert sum(x["actual_share"] for x in about.values()) == pytest.approx(1)
    again = {tuple(x) for x in M.mixed(documents.repartition(5), targets)[0].collect()}
    assert again == {tuple(x) for x in got}
    other = {tuple(x) for x in M.mixed(documents, targets, seed=2)[0].collect()}
    assert other != again


def test_rare_patterns_are_folded(spark, monkeypatch):
    _, documents, targets = data(spark)
    monkeypatch.setattr(M, "PATTERNS", 1)
    chosen, _ = M.mixed(documents, targets)
    assert chosen.count() > 0


def test_empty(spark):
    _, documents, targets = data(spark)
    assert M.mixed(documents.limit(0), targets)[0].count() == 0
    chosen, report = M.mixed(documents, targets.limit(0))
    assert chosen.count() == 0
    assert report.count() == 0


def test_sources_that_share_all_texts_each_give_their_caps():
    t = {"a": M.Target(0.5, 1), "b": M.Target(0.5, 1)}
    assert M.plan({("a", "b"): 100}, t, 200).got == {"a": 100, "b": 100}


def test_every_document_of_a_repeated_text_has_the_cap(spark, tmp_path):
    from corpusloom.llm import queries

    rows = [(1, "the first text", "a"), (2, "the first text", "a"), (3, "another text of it", "a"), (4, "the first text", "b"), (5, "far from all of these", "c"), (6, "far from all of these", "c"), (7, "far from all of these", "c")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("a", 0.8, 1), ("b", 0.1, 1), ("c", 0.1, 2)], "source string, target_share double, max_repeat int").write.parquet(f"{tmp_path}/mix_targets.parquet")
    got = {r["doc_id"]: r["repeats"] for r in queries.p7_selected(spark, str(tmp_path)).collect()}
    assert {k: got.get(k) for k in (1, 2, 3, 4)} == {1: 1, 2: 1, 3: 1, 4: 1}
    assert all(got.get(k, 0) <= 2 for k in (5, 6, 7))
    assert sum(got.get(k, 0) for k in (5, 6, 7)) >= 1
    shares = {r["source"]: r for r in queries.p7_shares(spark, str(tmp_path)).collect()}
    assert shares["a"]["tokens"] == shares["a"]["available"]


def test_texts_of_rare_patterns_supply_all_their_sources(spark, monkeypatch):
    rows = [(k, f"word number {k} alone " * 5, "c") for k in range(60)]
    for i in range(20):
        rows += [(100 + 10 * i + j, f"text {i} of both", s) for j, s in enumerate("aab")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.4, 1), ("c", 0.2, 1)], "source string, target_share double, max_repeat int")
    monkeypatch.setattr(M, "PATTERNS", 1)
    chosen, report = M.mixed(documents, targets, copies=True)
    got = {r["doc_id"]: r["repeats"] for r in chosen.collect()}
    assert {r["source"]: r["tokens"] == r["available"] for r in report.collect()} == {"a": True, "b": True, "c": True}
    assert got == {r[0]: 1 for r in rows}
