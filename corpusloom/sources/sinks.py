"""Sinks: sharded Parquet texts under fixed names, tables, JSON lines, results kept under the digest of their description."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Rows of a shard of texts, and of a row group in it.
ROWS_PER_SHARD = 500_000
ROWS_PER_GROUP = 10_000


def write_texts(df: DataFrame, folder: str, text: str = "text", rows: int = ROWS_PER_SHARD) -> None:
    """One column of texts that aren't null: zstd, no dictionary, at most ``rows`` rows a file and ROWS_PER_GROUP a row group; a folder that exists is an error."""
    out = df.select(text).where(df[text].isNotNull()).write.mode("errorifexists").option("compression", "zstd").option("parquet.compression.codec.zstd.level", 3)
    out.option("parquet.enable.dictionary", "false").option("parquet.block.row.count.limit", ROWS_PER_GROUP).option("maxRecordsPerFile", rows).parquet(folder)


def number_shards(spark: SparkSession, folder: str, stem: str = "train") -> list[str]:
    """Renames the part files of a folder, in order, to ``stem-00000-of-00007.parquet`` and so on; the names."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-"))
    width = max(5, len(str(len(names))))
    out = [f"{stem}-{i:0{width}d}-of-{len(names):0{width}d}.parquet" for i in range(len(names))]
    for a, b in zip(names, out, strict=True):
        fs.rename(jvm.org.apache.hadoop.fs.Path(folder, a), jvm.org.apache.hadoop.fs.Path(folder, b))
    return out


def write_table(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """A table of Parquet files; one that exists is an error unless ``overwrite``."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def write_json_lines(df: DataFrame, folder: str, compressed: bool = False, append: bool = False) -> None:
    df.write.mode("append" if append else "errorifexists").option("compression", "gzip" if compressed else "none").json(folder)


def kept(spark: SparkSession, root: str, description: dict, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, stored below ``root`` under the MD5 of its description; read if it is there already."""
    text = json.dumps(description, sort_keys=True, default=str)
    path = f"{root.rstrip('/')}/{hashlib.md5(text.encode()).hexdigest()}"
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def prefix_of(output: str, key: str, level: str = "document") -> str:
    """Name of the store of a key."""
    return f"{output}_{key}_{level}"


def write_keys(df: DataFrame, output: str, keys: list[str], length: int, row_id: str) -> None:
    """One table for each key of token columns, without the sequences that are too long for any of them."""
    from corpusloom.operators.handlers import without_long

    fit = without_long(df, keys, length)
    for k in keys:
        fit.select(row_id, k).write.mode("errorifexists").parquet(prefix_of(output, k))


def is_saved(path: str) -> bool:
    return os.path.isdir(path) and bool(os.listdir(path))
