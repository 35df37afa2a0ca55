"""An audit run over a folder of heterogeneous files: inventory, profiles and integrity, written as deterministic tables.

    python -m assaymill.plans.audit FOLDER OUT [inventory|tables|full]

A file that cannot be read becomes an error row and ends nothing. Inputs are hashed before and after; a run that changed them is flagged.
"""

from __future__ import annotations

import json
import sys
from datetime import datetime, timezone
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import integrity, profiling
from ..operators.inventory import duplicate_groups, extension_summary, largest
from ..sinks.release import manifest
from ..sinks.text import write_json, write_tsv
from ..sources import flat, ooxml, register_all

MODES = ("inventory", "tables", "full")


def load(spark: SparkSession, path: str) -> list[tuple[str, DataFrame]]:
    """The tables of a file, each with a name."""
    suffix = Path(path).suffix.lower()
    if suffix in (".csv", ".tsv", ".txt"):
        return [(Path(path).name, flat.read_delimited(spark, path))]
    if suffix == ".parquet":
        return [(Path(path).name, spark.read.parquet(path))]
    if suffix == ".json":
        return [(Path(path).name, flat.read_json_records(spark, path))]
    if suffix == ".xlsx":
        cells = spark.read.format("xlsx_cells").option("header", "first_nonempty").load(path)
        out = []
        for sheet in ooxml.sheet_names(path):
            part = cells.filter(F.col("sheet") == sheet)
            headers = part.select("column_index", "header").distinct().orderBy("column_index").collect()  # one row per column
            names = profiling.header_names([r["header"] for r in headers])
            out.append((f"{Path(path).name}!{sheet}", ooxml.records(part, names).drop("file", "sheet", "excel_row") if names else part.limit(0)))
        return out
    return []


def run(spark: SparkSession, folder: str, out: str, mode: str = "full") -> dict:
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    register_all(spark)
    target = Path(out)
    target.mkdir(parents=True, exist_ok=True)
    marker = target / "active_run.json"
    write_json({"started": datetime.now(timezone.utc).isoformat(timespec="seconds"), "mode": mode}, str(marker))
    before = {r["file_path"]: r["sha256"] for r in manifest(spark, folder).collect()}
    files = flat.file_inventory(spark, folder).cache()
    write_tsv(files, str(target / "file_inventory.tsv"), ["path"])
    write_tsv(extension_summary(files, "filename", "size"), str(target / "extension_summary.tsv"), ["extension"])
    write_tsv(largest(files.select("path", "size"), "size", "path"), str(target / "largest_files.tsv"), ["path"])
    write_tsv(duplicate_groups(files, "path", F.col("sha256"), F.col("filename")), str(target / "duplicate_files.tsv"), ["group_kind", "group_key"])
    errors, tables = [], []
    if mode != "inventory":
        for path in sorted(r["path"] for r in files.select("path").collect()):
            try:
                tables += load(spark, path.removeprefix("file:").replace("///", "/", 1))
            except Exception as error:
                errors.append((path, type(error).__name__, str(error).split("\n")[0][:300]))
        tables = [(n, t) for n, t in tables if t.columns]
        if tables:
            order = F.monotonically_increasing_id()
            profiles = [profiling.column_profile(t, order, t.columns).withColumn("table_name", F.lit(n)) for n, t in tables]
            write_tsv(reduce(DataFrame.unionByName, profiles), str(target / "column_profiles.tsv"), ["table_name", "column_name"])
            write_tsv(reduce(DataFrame.unionByName, [profiling.table_profile(t, n, t.columns) for n, t in tables]), str(target / "table_profiles.tsv"), ["table_name"])
    keyed = [(n, t, c) for n, t in tables for c in t.columns if profiling.column_token(c).endswith("_id") or profiling.column_token(c) == "id"]
    if mode == "full" and keyed:
        audits = [integrity.key_audit(t, n, [c]) for n, t, c in keyed]
        write_tsv(reduce(DataFrame.unionByName, audits), str(target / "key_audit.tsv"), ["table_name", "key_columns"])
        pairs = [(a, b) for a in keyed for b in keyed if a[0] != b[0] and profiling.column_token(a[2]) == profiling.column_token(b[2])]
        if pairs:
            links = [integrity.foreign_key_audit(a[1], a[2], b[1], b[2], f"{a[0]}.{a[2]}->{b[0]}.{b[2]}") for a, b in pairs]
            write_tsv(reduce(DataFrame.unionByName, links), str(target / "foreign_keys.tsv"), ["relationship"])
    schema = "path string, error string, message string"
    write_tsv(spark.createDataFrame(errors, schema), str(target / "errors.tsv"), ["path"])
    after = {r["file_path"]: r["sha256"] for r in manifest(spark, folder).collect()}
    files.unpersist()
    result = {"mode": mode, "files": len(before), "tables": len(tables), "errors": len(errors), "inputs_changed": before != after}
    write_json(result, str(target / "run_metadata.json"))
    marker.unlink()
    return result


if __name__ == "__main__":
    from ..session import local_session

    found = run(local_session(), *sys.argv[1:4])
    print(json.dumps(found))
    sys.exit(2 if found["errors"] else 0)
