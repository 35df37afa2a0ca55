"""Small example files of every format the engine reads, built with the standard library: fixtures of queries and tests."""

from __future__ import annotations

import json
import sqlite3
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
_WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def _cell(column: int, row: int, value) -> str:
    at = f'r="{chr(64 + column)}{row}"'
    if value is None:
        return f"<c {at}/>"
    if isinstance(value, tuple):  # (formula, cached value or None)
        return f"<c {at}><f>{escape(value[0])}</f>{'' if value[1] is None else f'<v>{value[1]}</v>'}</c>"
    if isinstance(value, bool):
        return f'<c {at} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c {at}><v>{value}</v></c>"
    return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'


def write_workbook(path: str, sheets: dict[str, dict[int, list]]) -> None:
    """A workbook of ``{sheet: {physical row: values}}``."""
    with zipfile.ZipFile(path, "w") as book:
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}">{links}</Relationships>')
        for i, content in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{r}">{"".join(_cell(c, r, v) for c, v in enumerate(values, 1))}</row>' for r, values in content.items())
            book.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>')


def write_document(path: str, blocks: list) -> None:
    """A word-processor document of paragraphs (texts) and tables (lists of rows)."""

    def paragraph(text: str) -> str:
        return f"<w:p><w:r><w:t>{escape(text)}</w:t></w:r></w:p>"

    def table(rows: list[list[str]]) -> str:
        return "<w:tbl>" + "".join(f"<w:tr>{''.join(f'<w:tc>{paragraph(c)}</w:tc>' for c in row)}</w:tr>" for row in rows) + "</w:tbl>"

    body = "".join(paragraph(b) if isinstance(b, str) else table(b) for b in blocks)
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("word/document.xml", f'<w:document xmlns:w="{_WORD}"><w:body>{body}</w:body></w:document>')


def write_archive(path: str, members: dict[str, str | bytes | dict]) -> None:
    """An archive of texts, bytes and (as mappings) nested archives."""
    with zipfile.ZipFile(path, "w") as book:
        for name, content in members.items():
            if isinstance(content, dict):
                inner = Path(f"{path}.inner")
                write_archive(str(inner), content)
                content = inner.read_bytes()
                inner.unlink()
            book.writestr(name, content)


def write_database(path: str, tables: dict[str, tuple[list[str], list[tuple]]]) -> None:
    """A database of ``{table: (columns, rows)}``."""
    Path(path).unlink(missing_ok=True)
    base = sqlite3.connect(path)
    for name, (columns, rows) in tables.items():
        base.execute(f'CREATE TABLE "{name}" ({", ".join(columns)})')
        base.executemany(f'INSERT INTO "{name}" VALUES ({", ".join("?" * len(columns))})', rows)
    base.commit()
    base.close()


def build(folder: str) -> Path:
    """One file of each format in a folder."""
    root = Path(folder)
    root.mkdir(parents=True, exist_ok=True)
    write_workbook(str(root / "book.xlsx"), {
        "metadata": {1: ["antibody_id", "name", "", "name"], 2: [None, None, " ", None], 3: ["DOTAD-001", "example", "extra", "alias"]},
        "values": {3: ["id", "hic_rt_mean", "hic_rt_stddev", "hic_rt_replicates"], 4: ["A", 2.5, 0.5, 2], 6: ["B", ("1+1", 2), None, True], 7: ["C", ("2+2", None), 1, 3]},
    })
    write_document(str(root / "paper.docx"), ["Title text", "Methods", "We hold 324,000 records [12] in 2024.", [["a", "b"], ["c", "d"]], "References", "PMID 1"])
    write_archive(str(root / "data.zip"), {
        "t.csv": "x,y\n1,2\n", "nested/in.zip": {"u.tsv": "vh\tkd\nEVQL\t1.5\n", "note.txt": "see /home/someone/x"}, "../bad.csv": "a,b\n", "__MACOSX/x.csv": "no\n", "broken.zip": b"none",
    })
    write_database(str(root / "base.sqlite"), {"t": (["x", "y"], [(1, 2), (3, 4)]), "empty": (["z"], [])})
    (root / "plain.csv").write_text('id,text\n1," lead ""q"""\n2,\n', encoding="utf-8")
    (root / "marked.csv").write_text("id,text\n1,é\n", encoding="utf-8-sig")
    (root / "latin.csv").write_bytes("id;text\n1;é\n2;ü\n".encode("latin-1"))
    (root / "tabs.tsv").write_text("id\ttext\n1\ta,b\n", encoding="utf-8")
    for name, value in (("list", [{"a": 1}, {"a": 2}]), ("lists", {"k": [{"a": 1}], "l": [{"a": 2}]}), ("dicts", {"k": {"a": 1}}), ("object", {"a": 1, "b": [2]}), ("scalar", 7)):
        (root / f"{name}.json").write_text(json.dumps(value), encoding="utf-8")
    (root / "README.md").write_text("# Data\n\n| File | Rows |\n|---|:-:|\n| t.csv | 1 |\n| u.tsv | 1 |\n\nLicence: [CC BY 4.0](https://doi.org/10.5281/zenodo.1).\n", encoding="utf-8")
    (root / "run.py").write_text('import os\nfrom a.b import c\ndf = read_csv("in/data.csv")\ndf.to_csv("res.tsv")\nout_file = path.join(FIGURES_DIR, "fig.pdf")\n', encoding="utf-8")
    (root / "plot.R").write_text('library(ggplot2)\nrequire("dplyr")\nggsave("out/plot.png")\n', encoding="utf-8")
    return root
