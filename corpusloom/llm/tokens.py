"""Token arrays: length and contents without the padding at the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAD = 258
IGNORE = -100


def length_without_padding(ids: str, pad: int = PAD) -> Column:
    """Number of tokens before the padding at the end; 0 for null, empty and all-padding arrays."""
    c = F.col(ids)
    size = F.size(c)
    tail = F.array_position(F.transform(F.reverse(c), lambda x: F.coalesce(x != pad, F.lit(True))), True)
    return (
        F.when(c.isNull() | (size == 0), F.lit(0))
        .when(F.coalesce(F.element_at(c, -1) != pad, F.lit(True)), size)
        .otherwise(F.when(tail == 0, F.lit(0)).otherwise(size - tail.cast("int") + 1))
    )


def aligned_labels(labels: str, n: Column) -> Column:
    """``labels`` cut or filled with -100 to ``n`` places; null stays null."""
    c = F.col(labels)
    return F.when(c.isNull(), F.lit(None).cast("array<int>")).otherwise(F.slice(F.concat(c, F.array_repeat(F.lit(IGNORE), F.greatest(n - F.size(c), F.lit(0)))), F.lit(1), n))


def token_rows(df: DataFrame, sample_id: str = "sample_id", ids: str = "input_ids", labels: str = "labels", pad: int = PAD) -> DataFrame:
    """(sample_id, n, input_ids, labels) with the padding cut off and labels as long as the tokens or null."""
    sized = df.select(F.col(sample_id).alias("sample_id"), F.col(ids).alias("input_ids"), F.col(labels).alias("labels")).withColumn("n", length_without_padding("input_ids", pad))
    return sized.select("sample_id", "n", F.when(F.size("input_ids") == F.col("n"), F.col("input_ids")).otherwise(F.slice("input_ids", F.lit(1), F.col("n"))).alias("input_ids"), F.when(F.size("labels") == F.col("n"), F.col("labels")).otherwise(aligned_labels("labels", F.col("n"))).alias("labels"))
