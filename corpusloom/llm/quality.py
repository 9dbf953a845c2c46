"""Statistics of every document's text, and whether it is natural prose, a list, a table or junk.

A bounded sample of the corpus is labelled weakly by rules on the statistics; gradient-boosted trees learn from it on the
driver and are calibrated on texts labelled by hand. The trees (some tens of KB) go to the tasks, which compute the
statistics of whole texts batch by batch and score them. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import boosting
from corpusloom.llm.quality_features import NAMES, SIZES, features
from corpusloom.llm.quality_holdout import HOLDOUT
from corpusloom.llm.quality_labels import KINDS, weak_labels

#: Documents that are labelled weakly for training, at most.
TRAINING_ROWS = 8000
#: Documents of one kind that are trained on, at most.
PER_KIND = 4000
#: Documents whose statistics are computed at a time.
SLICE = 512


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            f = features(part.column(1))
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(f[:, j]) for j in range(f.shape[1])]], names=["doc_id", *NAMES])


_STATISTICS = "doc_id bigint, " + ", ".join(f"{n} double" for n in NAMES)


def document_statistics(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, one column for each of NAMES): statistics of each whole text. Null and blank texts have zeros."""
    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_statistics, _STATISTICS)


_SHORT, _PROSE = NAMES.index("short_line_share"), NAMES.index("prose_share")
_SEEN = np.array([n not in SIZES for n in NAMES])


def train(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = TRAINING_ROWS, seed: int = 7) -> boosting.Trees:
    """Trees fitted to a seeded sample of at most ``rows`` documents and calibrated on texts labelled by hand.

    A kind of which the sample holds too few (a tiny or uniform corpus) is learnt from every second hand-labelled text too; the
    others calibrate, so no text does both.
    """
    total = documents.count()
    # a hash threshold takes a little more than is needed, where the rows lie; the surplus is cut on the driver
    order = F.xxhash64(F.col(doc_id), F.lit(seed))
    keep = documents if total <= rows else documents.where(F.pmod(order, F.lit(1_000_000)) < int(1_050_000 * rows / total) + 1)
    if total > rows and (n := keep.count()) > 1.5 * rows:  # ids that recur hash alike
        keep = keep.where(F.rand(seed) < rows / n)
    sample = document_statistics(keep, doc_id, text).withColumn("_order", F.xxhash64("doc_id", F.lit(seed))).toPandas().sort_values(["_order", "doc_id"])[:rows]
    x = sample[list(NAMES)].to_numpy(np.float64)
    y = weak_labels(x)
    held = features(pa.array([t for _, t in HOLDOUT]))
    truth = np.array([KINDS.index(k) for k, _ in HOLDOUT])
    pick = [np.flatnonzero(y == k)[:PER_KIND] for k in range(len(KINDS))]
    calibrates = np.arange(len(truth)) % 2 == 1
    scarce = np.flatnonzero([len(pick[k]) < 20 and not c for k, c in zip(truth, calibrates, strict=True)])
    rows_of = np.concatenate(pick)
    xs, ys = np.concatenate([x[rows_of], held[scarce]]), np.concatenate([y[rows_of], truth[scarce]])
    # prose with many short lines is rare and nearest to lists, so it counts more
    mixed = (ys == 0) & ((xs[:, _SHORT] > 0.15) | (xs[:, _PROSE] < 0.9))
    weight = np.where(mixed, 4, 1) / np.sqrt(np.maximum(np.bincount(ys, minlength=len(KINDS)), 1))[ys]
    return boosting.calibrate(boosting.fit(xs[:, _SEEN], ys, len(KINDS), weight / weight.mean()), held[calibrates][:, _SEEN], truth[calibrates])


def document_quality(documents: DataFrame, model: boosting.Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, kind, p_prose, p_list, p_table, p_junk, statistics ...) for every row of ``documents``.

    ``kind`` is the likeliest, the first of KINDS among equals; null for a text without words or signs. Repeated ids and texts
    come out each; other columns play no part.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*KINDS], pa.string())
        for b in _statistics(batches):
            f = np.stack([b.column(j + 1).to_numpy() for j in range(len(NAMES))], 1)
            p = shared.value.probabilities(f[:, _SEEN])
            blank = f[:, NAMES.index("n_lines")] == 0
            kind = names.take(pa.array(p.argmax(1), mask=blank))
            yield pa.RecordBatch.from_arrays([b.column(0), kind, *[pa.array(p[:, k], mask=blank) for k in range(len(KINDS))], *b.columns[1:]], names=["doc_id", "kind", *[f"p_{k}" for k in KINDS], *NAMES])

    schema = "doc_id bigint, kind string, " + ", ".join(f"p_{k} double" for k in KINDS) + ", " + ", ".join(f"{n} double" for n in NAMES)
    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
