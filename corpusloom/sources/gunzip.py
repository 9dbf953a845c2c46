"""Gzip files found below a folder and unwrapped as often as their names say, in tasks."""

from __future__ import annotations

import gzip
import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources import remote
from corpusloom.sources.files import GZIP_MAGIC, find_files

_SUFFIXES = re.compile(r"(?:\.gz)+$", re.I)


def without_suffixes(path: str) -> tuple[str, int]:
    """The path without its ``.gz`` endings, and how many it had."""
    bare = _SUFFIXES.sub("", path)
    return bare, (len(path) - len(bare)) // 3


def bare_name(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)(\.gz)+$", "")


def layers_of(c: Column) -> Column:
    return ((F.length(c) - F.length(bare_name(c))) / 3).cast("int")


@dataclass(frozen=True)
class Job:
    source: str
    destination: str
    suffix_layers: int


def discover(source: str, destination: str, recursive: bool = True) -> list[Job]:
    """A job for each file with a ``.gz`` ending, sorted by path; the destination keeps the folders."""
    out = []
    for path in find_files(source, recursive=recursive):
        bare, layers = without_suffixes(path)
        if layers:
            out.append(Job(path, os.path.join(destination, os.path.relpath(bare, source)), layers))
    return out


def collisions(jobs: DataFrame) -> DataFrame:
    """(destination, sources) of destinations that several sources claim. At most a hundred sources are named."""
    pairs = jobs.select("destination", "source").distinct()
    return pairs.groupBy("destination").agg(F.count("*").alias("n"), F.min("source").alias("first_source"), F.max("source").alias("last_source")).where("n > 1")


def unwrapped(content: bytes, layers: int) -> tuple[bytes, int]:
    """The content after at most ``layers`` layers, each taken off only if its magic bytes are there, and how many came off."""
    done = 0
    while done < layers and content[:2] == GZIP_MAGIC:
        content = gzip.GzipFile(fileobj=io.BytesIO(content)).read()
        done += 1
    return content, done


def unwrapped_stream(raw, layers: int) -> tuple[io.BufferedReader, int]:
    """A stream without at most ``layers`` layers, as in ``unwrapped``, and how many came off."""
    stream, done = io.BufferedReader(raw), 0
    while done < layers and stream.peek(2)[:2] == GZIP_MAGIC:
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
        done += 1
    return stream, done


def _run(job: Job, overwrite: bool) -> tuple[str, int | None, str | None]:
    source, name = remote.opened(job.source)
    target, to = remote.opened(job.destination)
    if target.get_file_info(to).type != fs.FileType.NotFound and not overwrite:
        return "skipped", None, None
    part, size = f"{to}.{uuid.uuid4().hex}.part", 0
    try:
        with source.open_input_stream(name, compression=None) as raw:
            stream, done = unwrapped_stream(raw, job.suffix_layers)
            if not done:
                return "failed", None, "not a gzip file"
            target.create_dir(os.path.dirname(to) or ".", recursive=True)
            with target.open_output_stream(part, compression=None) as out:
                while chunk := stream.read(4 << 20):
                    out.write(chunk)
                    size += len(chunk)
        target.move(part, to)
        return "written", size, None
    except (OSError, EOFError, zlib.error) as e:
        if target.get_file_info(part).type != fs.FileType.NotFound:
            target.delete_file(part)
        return "failed", None, str(e)


def decompress(spark: SparkSession, jobs: list[Job], overwrite: bool = False) -> DataFrame:
    """(source, destination, status, size_bytes, error): jobs done in tasks, each written under a name of its own and renamed.

    A destination that exists is skipped unless ``overwrite``. Two sources with one destination are an error before anything runs.
    """
    seen: dict[str, str] = {}
    for j in jobs:
        if seen.setdefault(j.destination, j.source) != j.source:
            raise ValueError(f"{seen[j.destination]} and {j.source} have one destination")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            done = [_run(Job(*j), overwrite) for j in frame.itertuples(index=False)]
            yield pd.DataFrame({"source": frame["source"], "destination": frame["destination"], "status": [d[0] for d in done], "size_bytes": pd.array([d[1] for d in done], "Int64"), "error": [d[2] for d in done]})

    listed = spark.createDataFrame([(j.source, j.destination, j.suffix_layers) for j in jobs], "source string, destination string, suffix_layers int")
    return listed.repartition(max(1, min(len(jobs), max(4 * spark.sparkContext.defaultParallelism, len(jobs) // 1000)))).mapInPandas(run, "source string, destination string, status string, size_bytes bigint, error string")


def status_counts(done: DataFrame) -> DataFrame:
    return done.groupBy("status").agg(F.count("*").alias("n"))
