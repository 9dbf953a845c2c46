"""Files found, told apart and read: by majority format, by magic bytes, by registry, as lines, as evaluation sets."""

from __future__ import annotations

import gzip
import io
import json
import os
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import remote

#: Reader of each file extension (fixed values).
FORMATS = {"parquet": "parquet", "arrow": "arrow", "csv": "csv", "json": "json", "jsonl": "json", "txt": "text"}
GZIP_MAGIC = b"\x1f\x8b"


def extension(path: str) -> str:
    return os.path.splitext(path)[1].lstrip(".").lower()


def majority_format(paths: list[str]) -> tuple[str | None, str | None]:
    """(extension, reader) of the most frequent supported extension; of equal ones the first seen; nothing if none is."""
    counts = Counter(extension(p) for p in paths)
    for ext, _ in sorted(counts.items(), key=lambda x: -x[1]):
        if ext in FORMATS:
            return ext, FORMATS[ext]
    return None, None


def is_raw(path: str) -> bool:
    """Whether a path is a supported data file or a folder that holds one."""
    p = Path(path)
    names = [str(f) for f in p.iterdir()] if p.is_dir() else [path]
    return any(extension(n) in FORMATS for n in names)


def find_files(folder: str, suffixes: tuple[str, ...] | None = None, recursive: bool = True, skip: tuple[str, ...] = ()) -> list[str]:
    """Files below a folder, sorted, with one of ``suffixes`` in any case; an error if suffixes are asked for and none is found."""
    found = sorted(str(p) for p in (Path(folder).rglob("*") if recursive else Path(folder).glob("*")) if p.is_file() and p.name not in skip)
    if suffixes is None:
        return found
    found = [p for p in found if p.lower().endswith(suffixes)]
    if not found:
        raise FileNotFoundError(f"no file with {suffixes} below {folder}")
    return found


def read_format(spark: SparkSession, paths: list[str], fmt: str, **options) -> DataFrame:
    """Files of one reader; Arrow files are decoded in tasks."""
    if fmt == "arrow":
        return read_arrow(spark, paths)
    if fmt == "csv":
        options = {"header": "true", "multiLine": "true", "escape": '"'} | options
    reader = spark.read.options(**options)
    return reader.format(fmt).load(paths)


def read_arrow(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Arrow stream or file format; the schema is the first file's, which all must have."""
    first = _arrow(Path(paths[0]).read_bytes())
    from pyspark.sql.pandas.types import from_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                yield from _arrow(content.as_buffer()).to_batches()

    return spark.read.format("binaryFile").load(paths).select("content").mapInArrow(run, from_arrow_schema(first.schema))


def _arrow(content) -> pa.Table:
    try:
        return pa.ipc.open_file(pa.BufferReader(content)).read_all()
    except pa.ArrowInvalid:
        return pa.ipc.open_stream(pa.BufferReader(content)).read_all()


def read_path(spark: SparkSession, path: str, **options) -> DataFrame:
    """One file, or the files of the winning extension right in a folder; other extensions in it are left alone."""
    p = Path(path)
    names = sorted(str(f) for f in p.glob("*") if f.is_file()) if p.is_dir() else [path]
    ext, fmt = majority_format(names)
    if fmt is None:
        raise ValueError(f"nothing readable in {path}")
    return read_format(spark, [n for n in names if extension(n) == ext], fmt, **options)


def read_with_options(spark: SparkSession, parameters: str) -> DataFrame:
    """Whatever a JSON object of ``format``, ``path`` and reader options says; nothing else is done to it."""
    given = json.loads(parameters)
    fmt, path = given.pop("format"), given.pop("path")
    return spark.read.format(fmt).options(**{k: str(v) for k, v in given.items()}).load(path)


@dataclass(frozen=True)
class Entry:
    """A data set of a registry: where it is and how its records are laid out."""

    name: str
    kind: str
    path: str
    layout: str = "alpaca"
    columns: tuple[tuple[str, str], ...] = ()
    ranking: bool = False
    max_samples: int | None = None
    num_samples: int | None = None


#: Where a registry entry may point, in order of precedence (fixed values).
PLACES = ("file_name", "script_url", "cloud_file_name", "hf_hub_url", "ms_hub_url", "om_hub_url")


def registry(path: str) -> dict[str, dict]:
    return json.loads(Path(path).read_text("utf-8"))


def entries(names: str, info: dict[str, dict], folder: str = "") -> list[Entry]:
    """The entries of a list of names separated by commas; an unknown name, or one that points nowhere, is an error."""
    out = []
    for name in (n.strip() for n in names.split(",")):
        if not name:
            continue
        if name not in info:
            raise KeyError(f"unknown data set {name!r}")
        spec = info[name]
        place = next((k for k in PLACES if spec.get(k)), None)
        if place is None:
            raise ValueError(f"data set {name!r} points nowhere")
        where = os.path.join(folder, spec[place]) if place == "file_name" else spec[place]
        out.append(Entry(name, place, where, spec.get("formatting", "alpaca"), tuple(sorted((spec.get("columns") or {}).items())), bool(spec.get("ranking")), spec.get("max_samples"), spec.get("num_samples")))
    return out


def head(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows: in ``order``, or else in that of file names, places in a file and rows; of files that Spark reads only."""
    if order:
        return df.orderBy(*order).limit(n)
    placed = df.withColumns({"_f": F.col("_metadata.file_path"), "_b": F.col("_metadata.file_block_start"), "_r": F.monotonically_increasing_id()})
    return placed.orderBy("_f", "_b", "_r").limit(n).drop("_f", "_b", "_r")


def read_entry(spark: SparkSession, e: Entry, seed: int = 0) -> DataFrame:
    """The files of an entry, of one type; ``num_samples`` of it drawn by a seed (again, if it has fewer); at most its ``max_samples`` first rows.

    Without ``num_samples`` first is meant in the order of files and rows, with it in that of the draws.
    """
    if e.kind not in ("file_name", "cloud_file_name"):
        raise NotImplementedError(f"{e.kind} needs a registered data source")
    p = Path(e.path)
    names = sorted(str(f) for f in p.iterdir()) if p.is_dir() else [e.path]
    if len({FORMATS.get(extension(n)) for n in names}) != 1:
        raise ValueError("files of a data set must be of one type")
    df = read_format(spark, names, FORMATS[extension(names[0])])
    if e.num_samples is not None:
        from corpusloom.operators.ordinals import resampled

        placed = df.withColumn("_row", F.concat_ws(":", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()))
        drawn = resampled(placed, "_row", e.num_samples, seed)
        return (drawn if e.max_samples is None else drawn.where(F.col("draw") < e.max_samples)).drop("_row", "draw")
    return head(df, e.max_samples) if e.max_samples is not None else df


def check_stage(entry: Entry, stage: str) -> None:
    """An error if ranked records are used anywhere but for rewards (``rm``), or others there."""
    if entry.ranking != (stage == "rm"):
        raise ValueError(f"data set {entry.name!r} doesn't fit the stage {stage!r}")


def peek(df: DataFrame, n: int = 2) -> DataFrame:
    """A few rows of what is read lazily."""
    return df.limit(n)


def read_json_lines(spark: SparkSession, paths: list[str] | str, schema: str | None = None, glob: str | None = None) -> DataFrame:
    """JSON lines, plain or gzip by their suffix, blank lines skipped; of a folder only the files that ``glob`` names, such as ``*dev*``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return (reader.option("pathGlobFilter", glob) if glob else reader).json(paths)


def read_cloud_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON or JSON lines of an object store through Hadoop's file systems; blank lines are skipped.

    Buckets are tried without credentials first, then with those that are configured.
    """
    url = path.replace("gcs://", "gs://").replace("s3://", "s3a://")
    reader = lambda: spark.read.option("pathGlobFilter", "*.json*").option("multiLine", str(url.endswith(".json")))
    if not url.startswith("s3a://"):
        return reader().json(url)
    try:
        bucket = url.removeprefix("s3a://").split("/")[0]
        return reader().option(f"fs.s3a.bucket.{bucket}.aws.credentials.provider", "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider").json(url)
    except Exception:  # noqa: BLE001 - whatever the store refuses with
        return reader().json(url)


def sniffed_text(content: bytes) -> str:
    """Gzip if it begins with its magic bytes, whatever the name; bytes that aren't UTF-8 are replaced."""
    if content[:2] == GZIP_MAGIC:
        content = gzip.GzipFile(fileobj=io.BytesIO(content)).read()
    return content.decode("utf-8", "replace")


def _lines_of(path: str) -> Iterator[str]:
    """Lines of a file, plain or gzip by its first bytes, read as a stream; a line end at the very end begins no line."""
    files, name = remote.opened(path)
    with files.open_input_stream(name, compression=None) as probe:
        packed = probe.read(2) == GZIP_MAGIC
    with files.open_input_stream(name, compression=None) as raw:
        stream = gzip.GzipFile(fileobj=raw) if packed else raw
        yield from io.TextIOWrapper(io.BufferedReader(stream), "utf-8", "replace", newline="\n")


def _listed(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """(path) of the files below a folder; their contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder).select("path")


def read_sniffed_lines(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, line_no, line) of all files below a folder, plain or gzip by magic; line ends are stripped. Files are read as streams."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for path in frame["path"]:
                lines, at = _lines_of(path), 0
                while rows := [x.rstrip("\n").rstrip("\r") for x in islice(lines, 50_000)]:
                    yield pd.DataFrame({"path": path, "line_no": range(at, at + len(rows)), "line": rows})
                    at += len(rows)

    return _listed(spark, folder, glob).mapInPandas(run, "path string, line_no bigint, line string")


def read_choices(spark: SparkSession, paths: list[str], header: bool = False, skip_first: bool = False) -> DataFrame:
    """Exam questions (question, A, B, C, D, answer) of files of comma-separated values, with their file."""
    df = spark.read.schema("question string, A string, B string, C string, D string, answer string").option("header", str(header or skip_first)).option("quote", '"').option("escape", '"').option("multiLine", "true").option("enforceSchema", "true").csv(paths)
    return df.withColumn("file", F.col("_metadata.file_path"))


def read_examples(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(input, target) of JSON files ``{"examples": [...]}``; a file without them is an error."""
    df = spark.read.schema("examples array<struct<input string, target string>>").option("multiLine", "true").json(paths)
    checked = F.when(F.col("examples").isNull(), F.raise_error(F.lit("a file has no examples"))).otherwise(F.col("examples"))
    return df.select(F.explode(checked).alias("e"), F.col("_metadata.file_path").alias("file")).select("e.*", "file")


def count_lines(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, lines, error) of every file below a folder and, under ``TOTAL``, of all that could be read; a file that couldn't has an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            found = []
            for path in frame["path"]:
                try:
                    found.append((path, sum(1 for _ in _lines_of(path)), None))
                except (OSError, EOFError, zlib.error) as e:
                    found.append((path, None, type(e).__name__))
            out = pd.DataFrame(found, columns=["path", "lines", "error"])
            yield out.assign(lines=out["lines"].astype("Int64"))

    each = _listed(spark, folder, glob).mapInPandas(run, "path string, lines bigint, error string")
    counted = each.rollup("path").agg(F.sum("lines").alias("lines"), F.max("error").alias("error"), F.grouping_id().alias("_gid"))
    return counted.select(F.when(F.col("_gid") == 1, "TOTAL").otherwise(F.col("path")).alias("path"), F.coalesce("lines", F.lit(0)).alias("lines"), F.when(F.col("_gid") == 0, F.col("error")).alias("error"))


def cached(spark: SparkSession, path: str | None) -> DataFrame | None:
    """A tokenized data set that was saved, if the folder holds one."""
    return spark.read.parquet(path) if path and os.path.isdir(path) and any(os.scandir(path)) else None


def mock_documents(spark: SparkSession, n: int, seed: int, most: int = 4096, end: int = 0) -> DataFrame:
    """(doc_id, tokens): documents of seeded lengths whose tokens count up from 1 and end with ``end``."""
    drawn = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("id").cast("string"))), 1, 12), 16, 10).cast("bigint")
    size = (drawn % (most - 1) + 1).cast("int")
    return spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.when(size > 1, F.sequence(F.lit(1), size - 1)).otherwise(F.array().cast("array<int>")), F.array(F.lit(end))).alias("tokens"))


# Lines of training logs: step, step time and losses; and allocated memory in two spellings (fixed values).
_STEP = r"iteration\s+(\d+)\s*/\s*\d+"
_TIME = r"elapsed time per iteration \(ms\):\s*([\d.]+)"
_LOSS = r"(?:lm )?loss:\s*([\d.E+-]+)"
_NORM = r"grad norm:\s*([\d.]+)"
_MEMORY = (r"memory \(MB\)\s*\|\s*allocated:\s*([\d.]+)", r"memory allocated:\s*([\d.]+)")


def log_metrics(lines: DataFrame, line: str = "value") -> DataFrame:
    """(step, ms, loss, norm) of the lines that report a step."""
    value = lambda p: F.nullif(F.regexp_extract(line, p, 1), F.lit("")).try_cast("double")
    return lines.where(F.col(line).rlike(_STEP)).select(F.regexp_extract(line, _STEP, 1).cast("bigint").alias("step"), value(_TIME).alias("ms"), value(_LOSS).alias("loss"), value(_NORM).alias("norm"))


def log_memory(lines: DataFrame, line: str = "value") -> DataFrame:
    """(mb) of the lines that report allocated memory in either spelling."""
    found = F.coalesce(*[F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in _MEMORY])
    return lines.select(found.try_cast("double").alias("mb")).where("mb IS NOT NULL")
