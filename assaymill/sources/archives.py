"""ZIP archives as data sources: members, nested members, and the delimited tables inside."""

from __future__ import annotations

import csv
import io
import os
import re
import stat
import zipfile
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.inventory import member_status
from .ooxml import expand

#: Nested archives are opened to this depth, and only up to this size.
DEPTH, MEMBER_BYTES = 3, 250 * 1024 * 1024


def walk(handle: zipfile.ZipFile, label: str = "", depth: int = 0):
    """(handle, info, label, depth, note) of every member; members of nested archives as ``outer!inner``.

    ``note`` says of a nested archive whether it was ``opened``, or why not (``too_deep``, ``too_large``, ``broken``); it is empty for other members.
    """
    for info in handle.infolist():
        name = f"{label}!{info.filename}" if label else info.filename
        if info.is_dir() or not info.filename.lower().endswith(".zip"):
            yield handle, info, name, depth, ""
        elif depth + 1 >= DEPTH or info.file_size > MEMBER_BYTES:
            yield handle, info, name, depth, "too_deep" if depth + 1 >= DEPTH else "too_large"
        else:
            try:
                inner = zipfile.ZipFile(io.BytesIO(handle.read(info)))
            except (zipfile.BadZipFile, zlib.error, RuntimeError):
                yield handle, info, name, depth, "broken"
                continue
            yield handle, info, name, depth, "opened"
            with inner:
                yield from walk(inner, name, depth + 1)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        return [_File(p) for p in expand(self.options["path"], ".zip")]


class _Members(_Reader):
    def read(self, partition):
        with zipfile.ZipFile(partition.path) as book:
            for _, info, name, depth, note in walk(book):
                link = stat.S_ISLNK((info.external_attr >> 16) & 0xFFFF)
                yield os.path.basename(partition.path), name, info.filename, depth, info.file_size, info.compress_size, info.is_dir(), link, f"{info.CRC:08x}", note


class ZipMembers(DataSource):
    @classmethod
    def name(cls):
        return "zip_members"

    def schema(self):
        return "archive string, member string, path string, depth int, size long, compressed long, is_directory boolean, is_symlink boolean, crc string, note string"

    def reader(self, schema):
        return _Members(dict(self.options))


class _Tables(_Reader):
    def read(self, partition):
        with zipfile.ZipFile(partition.path) as book:
            for handle, info, name, *_ in walk(book):
                low = info.filename.lower()
                if not low.endswith((".csv", ".tsv", ".txt")) or "__MACOSX/" in info.filename or "/._" in f"/{info.filename}":
                    continue
                with handle.open(info) as raw:
                    lines = io.TextIOWrapper(raw, "utf-8-sig", errors="replace", newline="")
                    for number, row in enumerate(csv.reader(lines, delimiter="\t" if low.endswith(".tsv") else ","), 1):
                        yield os.path.basename(partition.path), name, number, row


class ZipTables(DataSource):
    @classmethod
    def name(cls):
        return "zip_tables"

    def schema(self):
        return "archive string, member string, row_no int, cells array<string>"

    def reader(self, schema):
        return _Tables(dict(self.options))


def register(spark: SparkSession) -> None:
    for source in (ZipMembers, ZipTables):
        spark.dataSource.register(source)


def inspected(members: DataFrame) -> DataFrame:
    """Members with their security status."""
    return members.withColumn("status", member_status(F.col("path"), F.col("is_symlink")))


#: Header cells, compact, that name a measured value (fixed values).
VALUE_HEADERS = ["predaffinity", "fitness"]


def header_rows(preview: DataFrame, sequence_headers: list[str], metric_words: list[str]) -> DataFrame:
    """(archive, member, row_no): per table of an archive the preview row that looks most like a header, the first of equals.

    Points: one for several cells, two for a sequence header, two for a word of a metric, one for a header of a measured value. Empty
    rows are no headers.
    """
    low = F.transform("cells", lambda c: F.lower(c))
    compact = F.transform(low, lambda c: F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))
    signs = [
        (1, F.size("cells") >= 2), (2, F.arrays_overlap(compact, F.array(*map(F.lit, sequence_headers)))), (1, F.arrays_overlap(compact, F.array(*map(F.lit, VALUE_HEADERS)))),
        (2, F.exists(low, lambda c: c.rlike("|".join(map(re.escape, metric_words))))),
    ]
    score = sum(F.coalesce(held.cast("int"), F.lit(0)) * points for points, held in signs)
    scored = preview.filter(F.size("cells") > 0).withColumn("score", score)
    return scored.groupBy("archive", "member").agg(F.max_by("row_no", F.struct("score", -F.col("row_no"))).alias("row_no"))


def private_texts(spark: SparkSession, path: str, patterns: dict[str, str]) -> DataFrame:
    """(archive, member, finding): members of archives, nested ones included, whose bytes match a pattern; read as any file system gives them.

    Members are searched whole, as Latin text, so no encoding hides a match of ASCII patterns; a broken archive has the finding ``broken``.
    """
    wanted = dict(patterns)

    def run(batches):
        compiled = {name: re.compile(pattern) for name, pattern in wanted.items()}
        for batch in batches:
            found = []
            for file, content in zip(batch["path"], batch["content"]):
                archive = file.rsplit("/", 1)[-1]
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as book:
                        for handle, info, name, _, note in walk(book):
                            if note == "broken":
                                found.append((archive, name, "broken"))
                            if not info.is_dir() and note != "opened":
                                text = handle.read(info).decode("latin-1")
                                found += [(archive, name, label) for label, pattern in compiled.items() if pattern.search(text)]
                except zipfile.BadZipFile:
                    found.append((archive, "", "broken"))
            yield pd.DataFrame(found, columns=["archive", "member", "finding"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "archive string, member string, finding string")


def member_counts(members: DataFrame) -> DataFrame:
    """(archive, n_members, n_files, n_directories, n_nested, n_unsafe) of a listing with statuses."""
    def times(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    return members.groupBy("archive").agg(
        F.count(F.lit(1)).alias("n_members"), times(~F.col("is_directory")).alias("n_files"), times(F.col("is_directory")).alias("n_directories"),
        times(F.col("depth") > 0).alias("n_nested"), times(F.col("status") != "safe").alias("n_unsafe"),
    )
