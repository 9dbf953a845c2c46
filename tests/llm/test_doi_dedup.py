import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import doi_dedup as D


def canon(s):
    if s is None:
        return None

    s = s.replace("%2F", "/")

    def word(v):
        return "".join(c for c in v.lower() if c.isalnum())

    def value(v):
        m = re.search(r"10\d{4}.*", word(v))
        return m.group(0) if m else word(v)

    if "{" in s:
        pairs = re.findall(r"""["']?(\w+)["']?\s*[:=]\s*["']?(.*?)["']?\s*(?=[,;]\s*["']?\w+["']?\s*[:=]|\}\s*$)""", s, re.S)
        made = sorted((word(a), value(b)) for a, b in pairs)
        return ("o", tuple(made)) if any(re.match(r"10\d{4}", v) for _, v in made) else None
    m = re.search(r"10\d{4}.*", word(s))
    return ("d", m.group(0)) if m else None


SPELLINGS = [
    "10.1234/abc.5", "https://doi.example/10.1234/ABC-5", " doi: 10.1234 / abc 5\n", "info:doi/10.12​34/abc.5", "(10.1234/abc_5)", "https://library.example/open?doi=10.1234%2Fabc.5",
    '{"doi": "10.1234/abc.5", "mag": "7"}', "{'MAG': '7', 'DOI': '10.1234/ABC:5'}", "{ mag = 7; doi = 10.1234/abc-5 }", "{ doi: 10.1234/abc.5 }",
    "10.1234/abc.5.s001", "10.1234/abc.6", "n/a", "-", "", " ", None, "{}", "{ mag: 7 }", "x" * 100_000 + "10.9999/z",
]


def test_keys_of_spellings(spark):
    d = spark.createDataFrame([(i, s) for i, s in enumerate(SPELLINGS)], "row_id bigint, doi string")
    keys = [x[0] for x in d.orderBy("row_id").select(D.doi_key(F.col("doi"))).collect()]
    groups = {}
    for s, k in zip(SPELLINGS, keys, strict=True):
        assert (k is None) == (canon(s) is None), s
        groups.setdefault(k, set()).add(canon(s))
    assert all(len(v) == 1 for k, v in groups.items() if k)
    assert len(set(keys[:6])) == 1
    assert len(set(keys[6:9])) == 1
    assert keys[9] not in keys[6:9]


@pytest.mark.parametrize("hot", [0.0, 0.6])
def test_repeats_against_brute_force(spark, hot):
    r = random.Random(1)
    rows = [(i, SPELLINGS[0] if r.random() < hot else f"10.{r.randint(1000, 1040)}/x{r.randint(0, 3)}", "clash", i) for i in r.sample(range(10_000), 3000)]
    d = spark.createDataFrame(rows, "row_id bigint, doi string, key string, first_id int").repartition(6)
    by = {}
    for i, s, *_ in rows:
        by.setdefault(canon(s), []).append(i)
    got = D.repeats(d, D.doi_key(F.col("doi")), "row_id").collect()
    assert len(got) == len(set(got))
    assert {tuple(x) for x in got} == {(min(v), i) for v in by.values() for i in v if i != min(v)}
    assert {(x["first_id"], x["n_rows"]) for x in D.records(d, D.doi_key(F.col("doi")), "row_id").collect()} == {(min(v), len(v)) for v in by.values()}


def test_empty_and_null_only(spark):
    d = spark.createDataFrame([(1, None), (2, "-")], "row_id bigint, doi string")
    assert D.repeats(d, D.doi_key(F.col("doi")), "row_id").count() == 0
    assert D.records(d.limit(0), D.doi_key(F.col("doi")), "row_id").count() == 0


def test_other_keys(spark):
    d = spark.createDataFrame([(1, "A b.", "x"), (2, "a  B", "X!"), (3, "ab c", None), (4, "", None)], "row_id bigint, t string, u string")
    assert {tuple(x) for x in D.repeats(d, D.text_key(F.col("t")), "row_id").collect()} == {(1, 2)}
    assert D.records(d, D.fields_key("t", "u"), "row_id").count() == 3


def test_carry_over_partitions():
    ends = [{"part": 0, "first_key": "a", "last_key": "b", "head_id": 5}, {"part": 2, "first_key": "b", "last_key": "b", "head_id": 9}, {"part": 3, "first_key": "b", "last_key": "c", "head_id": 20}, {"part": 4, "first_key": "d", "last_key": "d", "head_id": 30}]
    assert D.carried(ends) == {2: 5, 3: 5}


def test_objects_are_read_as_json_python_or_maps():
    import pyarrow as pa

    from corpusloom.llm.doi_dedup import doi_keys

    same = ['{"DOI": "10.1234/AB-c", "CorpusId": 7, "PMID": null}', "{'PMID': None, 'doi': 'https://doi.org/10.1234/ab.C', 'corpusid': 7}", "{doi=10.1234/abc, corpusId=7, pmid=null}", 'ids: {"corpusId": "7", "pmid": null, "doi": "10.1234/abc"}']
    assert len(set(doi_keys(pa.array(same)).to_pylist())) == 1
    nested = ['{"ids": {"doi": "10.1234/abc", "n": 1}, "x": [1, 2]}', "{'x': [1, 2], 'ids': {'n': 1, 'doi': '10.1234/ABC'}}"]
    assert len(set(doi_keys(pa.array(nested)).to_pylist())) == 1
    others = ['{"ids": {"doi": "10.1234/abc"}}', '{"doi": "10.1234/abc"}', '{"doi": "10.1234/abc", "title": "a, name: b"}', '{"doi": "10.1234/abc", "title": "a", "name": "b"}', '{"ids": "none"}', "10.1234/abc"]
    keys = doi_keys(pa.array(others)).to_pylist()
    assert keys[4] is None
    assert len(set(keys)) == 6
