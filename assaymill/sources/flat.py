"""Delimited text, JSON, SQLite catalogues, scripts and file inventories."""

from __future__ import annotations

import csv
import os
import sqlite3

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.inventory import extension_of, is_binary, kind_flags, media_type, path_category
from .ooxml import expand

SNIFF_BYTES = 128 * 1024


def sniff(sample: bytes, suffix: str = "") -> tuple[str, str]:
    """(encoding, delimiter) of the start of a file."""
    if sample.startswith((b"\xff\xfe", b"\xfe\xff")):
        encoding = "UTF-16"
        sample = sample[: len(sample) // 2 * 2]
    else:
        try:
            sample.decode("utf-8")
            encoding = "UTF-8"
        except UnicodeDecodeError as error:
            # a character cut at the end of the sample is no evidence against UTF-8
            encoding = "UTF-8" if error.start >= len(sample) - 4 and len(sample) >= SNIFF_BYTES else "ISO-8859-1"
    text = sample.decode(encoding, errors="replace")
    if suffix.lower() == ".tsv":
        return encoding, "\t"
    try:
        return encoding, csv.Sniffer().sniff(text, delimiters=",\t;|").delimiter
    except csv.Error:
        first = text.split("\n", 1)[0]
        return encoding, "\t" if first.count("\t") > first.count(",") else ","


def head_of(spark: SparkSession, path: str, size: int = SNIFF_BYTES) -> bytes | None:
    """The first bytes of a file of any file system Spark reads; None where it does not exist."""
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(file):
        return None
    stream = system.open(file)
    try:
        wanted = min(size, system.getFileStatus(file).getLen())
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, wanted))
    finally:
        stream.close()


def read_delimited(spark: SparkSession, path: str, delimiter: str | None = None, encoding: str | None = None, header: bool = True) -> DataFrame:
    """A delimited file as text columns; a missing file is an empty table."""
    head = head_of(spark, path)
    if head is None:
        return spark.createDataFrame([], "value string")
    found = sniff(head, os.path.splitext(path)[1])
    encoding, delimiter = encoding or found[0], delimiter or found[1]
    return spark.read.csv(
        path, sep=delimiter, encoding=encoding, header=header, quote='"', escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        emptyValue="",
    ).na.fill("")


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, shape, _mapping_key, record): one row per record of JSON documents, the record as text.

    Each file's own shape counts: ``list``, ``dict_of_lists``, ``dict_of_dicts``, ``object`` or ``scalar`` (the whole is the record), or
    ``broken`` (one row, the text as its record). Empty lists and mappings have no records.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    files = files.withColumn("whole", F.try_parse_json("text")).withColumn("kind", F.regexp_extract(F.schema_of_variant("whole"), "^[A-Z]+", 0))
    entries = F.from_json("text", "map<string,variant>")
    files = files.withColumn("entries", F.when(F.col("kind") == "OBJECT", entries)).withColumn("values", F.map_values("entries"))

    def all_are(kind: str) -> Column:
        return (F.size("values") > 0) & F.forall("values", lambda v: F.startswith(F.schema_of_variant(v), F.lit(kind)))

    shape = (
        F.when(F.col("whole").isNull(), "broken").when(F.col("kind") == "ARRAY", "list").when(F.col("kind") != "OBJECT", "scalar")
        .when(all_are("ARRAY"), "dict_of_lists").when(all_are("OBJECT"), "dict_of_dicts").otherwise("object")
    )
    files = files.withColumn("shape", shape)

    def record(key: Column, value: Column) -> Column:
        return F.struct(key.cast("string").alias("_mapping_key"), value.alias("record"))

    none, text = F.lit(None), F.col("text")

    def items(of: Column, key: Column) -> Column:
        return F.transform(F.from_json(of, "array<variant>"), lambda v: record(key, F.to_json(v)))

    records = (
        F.when(F.col("shape") == "list", items(text, none)).when(F.col("shape") == "dict_of_dicts", F.transform(F.map_entries("entries"), lambda e: record(e["key"], F.to_json(e["value"]))))
        .when(F.col("shape") == "dict_of_lists", F.flatten(F.transform(F.map_entries("entries"), lambda e: items(F.to_json(e["value"]), e["key"]))))
        .otherwise(F.array(record(none, text)))
    )
    return files.select("file", "shape", F.explode(records).alias("r")).select("file", "shape", "r.*")


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _SqliteReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        return [_File(p) for p in expand(self.options["path"], ".sqlite")]

    def read(self, partition):
        base = sqlite3.connect(f"file:{partition.path}?mode=ro", uri=True)
        try:
            for (name,) in base.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' ORDER BY name").fetchall():
                quoted = '"' + name.replace('"', '""') + '"'
                columns = [c[1] for c in base.execute(f"PRAGMA table_info({quoted})").fetchall()]
                yield os.path.basename(partition.path), name, base.execute(f"SELECT count(*) FROM {quoted}").fetchone()[0], columns
        finally:
            base.close()


class SqliteTables(DataSource):
    @classmethod
    def name(cls):
        return "sqlite_tables"

    def schema(self):
        return "file string, table_name string, row_count long, columns array<string>"

    def reader(self, schema):
        return _SqliteReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteTables)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder with size, time, hash, media type, kinds and category; contents are hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    files = files.withColumn("filename", name).withColumn("extension", extension_of(name)).withColumn("head", F.expr("substring(content, 1, 8192)"))
    extension = F.col("extension")
    return files.select(
        "path", "filename", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"), "extension",
        media_type(extension).alias("media_type"), path_category(F.col("path")).alias("category"), F.startswith("filename", F.lit(".")).alias("is_hidden"),
        is_binary(extension, F.col("head")).alias("is_binary"), F.contains("head", F.lit(bytearray(1))).alias("has_zero_byte"), *(flag.alias(n) for n, flag in kind_flags(extension).items()),
    )


def scripts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole script files."""
    return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, text) of one text file."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "text"))
