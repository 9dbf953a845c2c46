import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import boosting, quality
from corpusloom.llm.quality_features import NAMES, features
from corpusloom.llm.quality_holdout import HOLDOUT
from corpusloom.llm.quality_labels import KINDS, weak_labels


def test_statistics_of_known_texts():
    f = features(pa.array(["The cat sat on the mat.\nIt was the end, and so on", None, "", " \n ", "- a\n- b\n- c", "x" * 1_000_000]))
    c = {n: f[:, i] for i, n in enumerate(NAMES)}
    assert c["n_words"].tolist()[:5] == [13, 0, 0, 0, 3]
    assert c["n_lines"].tolist()[:5] == [2, 0, 0, 0, 3]
    assert c["sentence_end_share"][0] == 0.5
    assert c["mark_share"][4] == 1
    assert c["mean_word"][0] == pytest.approx(sum(map(len, "The cat sat on the mat It was the end and so on".split())) / 13)
    assert c["common_share"][0] == pytest.approx(9 / 13)
    assert np.isfinite(f).all()
    assert features(pa.array([], pa.string())).shape == (0, len(NAMES))


def test_statistics_do_not_depend_on_the_batch():
    texts = [t for _, t in HOLDOUT]
    whole = features(pa.array(texts))
    assert np.allclose(whole, np.concatenate([features(pa.array([t])) for t in texts]))
    assert np.allclose(whole[5:9], features(pa.array(texts).slice(5, 4)))


def test_line_ends_do_not_matter():
    a, b = features(pa.array(["one two\nthree\n\nfour"])), features(pa.array(["one two\r\nthree\r\rfour"]))
    assert np.allclose(a, b)


def test_trees_learn_and_calibrate():
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 5))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5)
    trees = boosting.calibrate(boosting.fit(x[:400], y[:400], 3), x[400:], y[400:])
    assert (trees.probabilities(x[400:]).argmax(1) == y[400:]).mean() > 0.93
    assert np.allclose(trees.probabilities(x).sum(1), 1)
    one = boosting.fit(x[:50], np.zeros(50, int), 3)
    assert (one.probabilities(x).argmax(1) == 0).all()


def test_weak_labels_agree_with_the_hand_labels():
    f = features(pa.array([t for _, t in HOLDOUT]))
    y, truth = weak_labels(f), np.array([KINDS.index(k) for k, _ in HOLDOUT])
    assert (y[y >= 0] == truth[y >= 0]).all()
    assert (y >= 0).mean() > 0.8


def test_documents(spark):
    rows = [(i, t * 3 if k == "prose" else t, "clash") for i, (k, t) in enumerate(HOLDOUT)]
    rows += [(1000, None, ""), (1001, "", ""), (1002, "  \n", ""), (5, rows[5][1], ""), (None, rows[0][1], "")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    model = quality.train(d)
    got = quality.document_quality(d, model).collect()
    assert len(got) == len(rows)
    blank = [x for x in got if x["doc_id"] in (1000, 1001, 1002)]
    assert all(x["kind"] is None and x["p_prose"] is None for x in blank)
    good = [(x["kind"], HOLDOUT[x["doc_id"]][0]) for x in got if x["doc_id"] is not None and x["doc_id"] < 1000]
    assert np.mean([a == b for a, b in good]) > 0.9
    assert quality.document_quality(d.limit(0), model).count() == 0


def test_training_reads_a_bounded_sample(spark):
    d = spark.range(3000).selectExpr("id AS doc_id", "'We found that the text of the page is kept as it was, because the copy is the same.' AS text")
    model = quality.train(d, rows=500)
    assert quality.document_quality(d, model).where("kind <> 'prose'").count() == 0


def test_texts_that_neither_rules_nor_trees_have_seen(spark):
    import os

    import numpy as np
    import pyarrow as pa

    from corpusloom.llm import quality
    from corpusloom.llm.quality_features import features
    from corpusloom.llm.quality_labels import KINDS
    from tests.llm.quality_unseen import UNSEEN

    root = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(root):
        pytest.skip("no test tables")
    assert len(UNSEEN) >= 200
    truth = np.array([KINDS.index(k) for k, _ in UNSEEN])
    p = quality.train(spark.read.parquet(root)).probabilities(features(pa.array([t for _, t in UNSEEN]))[:, quality._SEEN])
    right = p.argmax(1) == truth
    assert right.mean() >= 0.85
    assert min(right[truth == k].mean() for k in range(len(KINDS))) >= 0.6
    # what is said with confidence is right about as often as said
    sure = p.max(1) >= 0.95
    assert abs(p.max(1)[sure].mean() - right[sure].mean()) < 0.05
