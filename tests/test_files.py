import json
import os
import sqlite3
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from assaymill.operators.profiling import header_names
from assaymill.sinks import release, text
from assaymill.sources import archives, flat, ooxml, register_all
from tests.conftest import rows


def workbook(path, sheets):
    """A minimal workbook: {sheet: {row: [values]}}; a value is text, number, bool, ('f', formula, cached) or None."""
    def cell(column, row, value):
        at = f'r="{chr(64 + column)}{row}"'
        if value is None:
            return f'<c {at} s="0"/>'
        if isinstance(value, tuple):
            return f"<c {at}><f>{value[1]}</f>{'' if value[2] is None else f'<v>{value[2]}</v>'}</c>"
        if isinstance(value, bool):
            return f'<c {at} t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f"<c {at}><v>{value}</v></c>"
        return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{value}</t></is></c>'

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for i, content in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">{"".join(cell(c, r, v) for c, v in enumerate(values, 1))}</row>' for r, values in content.items())
            book.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')


def test_workbook_cells(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    workbook(path, {
        "metadata": {1: ["antibody_id", "name", "", "name"], 2: [None, None, " ", None], 3: ["DOTAD-001", "example", "blank-header-value", "alias"]},
        "sum（3）": {1: ["id", "value"], 2: ["A", 2], 3: ["B", ("f", "1+1", None)], 4: [True, 2.5]},
    })
    register_all(spark)
    cells = spark.read.format("xlsx_cells").load(path)
    meta = cells.filter("sheet = 'metadata'")
    assert rows(meta, "excel_row", "header", "value") == [(3, "", "blank-header-value"), (3, "antibody_id", "DOTAD-001"), (3, "name", "alias"), (3, "name", "example")]
    wide = ooxml.records(meta, header_names(["antibody_id", "name", "", "name"])).first()
    assert wide["name__source_column_4"] == "alias" and wide["source_column_3"] == "blank-header-value"
    payload = ooxml.payload_rows(meta).first()["payload"]
    assert [c["value"] for c in payload] == ["DOTAD-001", "example", "blank-header-value", "alias"]
    profile = {r["sheet"]: r for r in ooxml.workbook_profile(cells).collect()}["sum（3）"]
    assert (profile["data_rows"], profile["last_row"], profile["formula_cells"], profile["cached_values"]) == (3, 4, 1, 0)
    assert rows(cells.filter("sheet <> 'metadata' and excel_row = 4"), "value", "value_type") == [("2.5", "number"), ("true", "boolean")]
    assert ooxml.sheet_names(path) == ["metadata", "sum（3）"]


def test_docx(spark, tmp_path):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as book:
        book.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body><w:p><w:r><w:t>One</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>')
    register_all(spark)
    assert rows(spark.read.format("docx_paragraphs").load(str(tmp_path)), "paragraph_index", "kind", "text") == [(0, "paragraph", "One"), (1, "table_row", "a | b")]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "in.zip", "w") as inner:
        inner.writestr("t.tsv", "x\ty\n1\t2\n")
    with zipfile.ZipFile(tmp_path / "out.zip", "w") as outer:
        outer.write(tmp_path / "in.zip", "n/in.zip")
        outer.writestr("../bad.csv", "a,b\n")
        outer.writestr("__MACOSX/x.csv", "no\n")
    register_all(spark)
    path = str(tmp_path / "out.zip")
    members = archives.inspected(spark.read.format("zip_members").load(path))
    assert rows(members, "member", "status") == [("../bad.csv", "path_traversal"), ("__MACOSX/x.csv", "safe"), ("n/in.zip", "safe"), ("n/in.zip!t.tsv", "safe")]
    tables = spark.read.format("zip_tables").load(path)
    assert [(r["member"], r["row_no"], list(r["cells"])) for r in tables.orderBy("member", "row_no").collect()] == [("../bad.csv", 1, ["a", "b"]), ("n/in.zip!t.tsv", 1, ["x", "y"]), ("n/in.zip!t.tsv", 2, ["1", "2"])]
    with pytest.raises(ValueError):
        release.assert_sound(path)
    log = dict(release.safe_extract(path, str(tmp_path / "x")))
    assert log["../bad.csv"] == "blocked:path_traversal" and log["n/in.zip"] == "extracted"
    assert dict(release.safe_extract(path, str(tmp_path / "x")))["n/in.zip"] == "reused"
    preview = [("a", "t", 1, ["note"]), ("a", "t", 2, ["vh", "fitness"]), ("a", "t", 3, ["V H", "kd"]), ("a", "t", 4, ["v.h", "KD (nM)"]), ("a", "u", 1, []), ("a", "u", 2, ["x"])]
    preview = spark.createDataFrame(preview, "archive string, member string, row_no int, cells array<string>")
    assert rows(archives.header_rows(preview, ["vh"], ["kd"])) == [("a", "t", 3), ("a", "u", 2)]
    file = tmp_path / "x" / "n" / "in.zip"
    file.chmod(0o644)
    file.write_bytes(b"0" * file.stat().st_size)  # same size, other content
    assert dict(release.safe_extract(path, str(tmp_path / "x"), str(tmp_path / "log.tsv")))["n/in.zip"] == "extracted"
    assert "../bad.csv\tblocked:path_traversal" in (tmp_path / "log.tsv").read_text()
    (tmp_path / "y").mkdir()
    (tmp_path / "y" / "n").symlink_to(tmp_path / "x")
    assert dict(release.safe_extract(path, str(tmp_path / "y")))["n/in.zip"] == "blocked:outside_folder"


def test_unopened_archives_have_a_row(spark, tmp_path, monkeypatch):
    with zipfile.ZipFile(tmp_path / "deep.zip", "w") as outer:
        outer.writestr("bad.zip", b"no archive")
        outer.writestr("a.csv", "x\n1\n")
    register_all(spark)
    assert rows(spark.read.format("zip_members").load(str(tmp_path / "deep.zip")), "member", "note") == [("a.csv", ""), ("bad.zip", "broken")]
    monkeypatch.setattr(archives, "DEPTH", 1)
    with zipfile.ZipFile(tmp_path / "deep.zip") as book:
        assert [(name, note) for *_, name, _, note in archives.walk(book)] == [("bad.zip", "too_deep"), ("a.csv", "")]


def test_flat_files(spark, tmp_path):
    assert flat.sniff("a\tb\n1\t2\n漢\t字\n".encode()) == ("UTF-8", "\t") and flat.sniff("é;b\n1;2\n".encode("latin-1"))[0] == "ISO-8859-1"
    (tmp_path / "a.csv").write_text('id,text\n1," lead ""q"""\n2,\n', encoding="utf-8")
    assert rows(flat.read_delimited(spark, str(tmp_path / "a.csv"))) == [("1", ' lead "q"'), ("2", "")]
    assert flat.read_delimited(spark, str(tmp_path / "none.csv")).count() == 0
    for name, value, want in (("l", [{"a": 1}, {"a": 2}], 2), ("m", {"k": {"a": 1}}, 1), ("d", {"k": [{"a": 1}, {"a": 2}]}, 2), ("o", {"a": 1, "b": 2}, 1)):
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
        assert flat.read_json_records(spark, str(tmp_path / f"{name}.json")).count() == want
    (tmp_path / "x.json").write_text('{"a": 1')
    (tmp_path / "y.json").write_text('{"a": "[1"}')
    (tmp_path / "z.json").write_text("[]")
    shapes = dict(rows(flat.read_json_records(spark, str(tmp_path / "*.json")), "file", "shape"))
    assert shapes == {"l.json": "list", "m.json": "dict_of_dicts", "d.json": "dict_of_lists", "o.json": "object", "x.json": "broken", "y.json": "object"}
    assert rows(flat.read_json_records(spark, str(tmp_path / "d.json")), "_mapping_key", "record") == [("k", '{"a":1}'), ("k", '{"a":2}')]
    base = sqlite3.connect(tmp_path / "b.sqlite")
    base.execute("CREATE TABLE t (x, y)")
    base.execute("INSERT INTO t VALUES (1, 2)")
    base.commit()
    base.close()
    register_all(spark)
    assert [(r["table_name"], r["row_count"], list(r["columns"])) for r in spark.read.format("sqlite_tables").load(str(tmp_path / "b.sqlite")).collect()] == [("t", 1, ["x", "y"])]
    files = {r["filename"]: r for r in flat.file_inventory(spark, str(tmp_path)).collect()}
    assert files["a.csv"]["extension"] == ".csv" and files["a.csv"]["sha256"] == release.sha256_file(tmp_path / "a.csv") and files["b.sqlite"]["has_zero_byte"] and not files["a.csv"]["has_zero_byte"]
    assert flat.numbered_lines(spark, str(tmp_path / "a.csv")).count() == 4
    assert flat.scripts(spark, str(tmp_path)).filter("path like '%a.csv'").count() == 1


def test_deterministic_text(spark, tmp_path):
    df = spark.createDataFrame([(2, "\tlead", 1.5, None, True), (1, '#a "q"', 12.0, datetime(2025, 1, 2, 3, 4, 5, 6), None)], "i int, t string, x double, at timestamp, b boolean")
    paths = [str(tmp_path / n) for n in ("a.tsv", "b.tsv")]
    for p, n in zip(paths, (1, 5)):
        assert text.write_tsv(df.repartition(n), p, ["i"]) == 2
    first, second = (open(p, "rb").read() for p in paths)
    assert first == second == b'i\tt\tx\tat\tb\n1\t"#a ""q"""\t12\t2025-01-02T03:04:05\t\n2\t"\tlead"\t1.5\t\ttrue\n'
    with pytest.raises(ValueError):
        text.write_tsv(df, paths[0], ["i"], ["nope"])
    text.write_tsv(df, paths[0], ["i"], ["i"], "\r\n")
    assert open(paths[0], "rb").read() == b"i\r\n1\r\n2\r\n"
    assert text.payload_json([{"b": float("nan"), "a": date(2025, 1, 1)}]) == '[{"b":null,"a":"2025-01-01"}]'
    text.write_parts(df, str(tmp_path / "parts"))
    assert spark.read.text(str(tmp_path / "parts/rows")).count() == 2
    text.write_json({"b": 1, "a": None}, paths[1])
    assert open(paths[1]).read() == '{\n  "a": null,\n  "b": 1\n}\n'


def test_release(spark, tmp_path):
    folder = tmp_path / "r"
    (folder / "d").mkdir(parents=True)
    (folder / "README.md").write_text("{{DOI}} {{DATE}} {{OTHER}}")
    (folder / "d/x.tsv").write_text("1\n")
    assert rows(release.manifest(spark, str(folder)), "file_path", "size") == [("README.md", 26), ("d/x.tsv", 2)]
    out = release.publish(str(folder), str(tmp_path / "p"), {"DOI": "10.5281/zenodo.1", "DATE": "2026-01-31"})
    assert (out / "README.md").read_text() == "10.5281/zenodo.1 2026-01-31 {{OTHER}}" and release.verify_checksums(str(out)) == []
    (out / "d/x.tsv").write_text("2\n")
    (out / "new").write_text("")
    assert release.verify_checksums(str(out)) == ["unlisted: new", "changed: d/x.tsv"]
    with pytest.raises(FileExistsError):
        release.publish(str(folder), str(out), {})
    for bad in ({"DOI": "x"}, {"DATE": "2026-1-31"}):
        with pytest.raises(ValueError):
            release.publish(str(folder), str(tmp_path / "q"), bad)
    for name in ("1.zip", "2.zip"):
        release.deterministic_zip(str(folder), str(tmp_path / name))
        os.utime(folder / "README.md", (1, 1))
    assert release.sha256_file(tmp_path / "1.zip") == release.sha256_file(tmp_path / "2.zip")


def test_streams(spark, tmp_path):
    from assaymill.streaming import events

    data = [(i % 6, datetime(2025, 1, 1, i % 3), "ab"[i % 2], float(i)) for i in range(12)]
    spark.createDataFrame(data, "id int, at timestamp, kind string, value double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, at timestamp, kind string, value double").parquet(str(tmp_path / "in"))
    for name, df, mode in (
        ("distinct", events.distinct_events(stream, ["id"], "at"), "append"), ("windows", events.window_profile(stream, "at", "kind", "value"), "complete"),
    ):
        query = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
        query.awaitTermination(120)
    assert spark.table("distinct").count() == 6
    assert spark.table("windows").agg(F.sum("n_rows")).first()[0] == 12
