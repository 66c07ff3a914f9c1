"""Extractors of tables and workbooks, and of the metadata and text of office packages."""

from __future__ import annotations

import csv
import datetime
import hashlib
import io
import json
import os
import re
import sqlite3
import struct
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree

from loamline.model import make_id
from loamline.sources.base import ENCRYPTED, Failed, File, Result, clean, decode
from loamline.sources.documents import local, parse_xml, timestamp

SNIFFED = 40_960
# What a sheet inherits of its workbook.
SHEET_PROPS = ("authoredAt", "modifiedAt", "author", "summary", "generator", "language", "processingAgent")
ODS_SHEET_PROPS = ("authoredAt", "author", "summary", "generator", "date", "processingAgent")


def table_into(out: Result, table: str, rows: Iterable[list[object]], names: list[str] | None = None) -> dict[str, list[str]]:
    """Emits a fragment for each row's texts; returns csvHash, rowCount and columns.

    Without names the first row's width decides: later rows are cut or filled up to it.  Rows without text are left out.
    """
    digest, count, written = hashlib.sha1(), 0, 0
    buffer = io.StringIO()
    writer = csv.writer(buffer, dialect="unix")
    for row in rows:
        if names is None:
            names = [f"Column {k}" for k in range(1, len(row) + 1)]
        cells = [clean(c) if c is not None else "" for c in row[: len(names)]]
        cells += [""] * (len(names) - len(cells))
        if not any(cells):
            continue
        count += 1
        writer.writerow(cells)
        digest.update(buffer.getvalue().encode())
        written += 1
        buffer.seek(0)
        buffer.truncate()
        out.index(table, "Table", count, cells)
    props = {"rowCount": [str(count + 1)], "columns": [json.dumps(names or [])]}
    return props | ({"csvHash": [digest.hexdigest()]} if written else {})


def csv_file(file: File) -> Result:
    text, encoding = decode(file.content)
    out = Result("Table")
    out.add("encoding", encoding)
    try:
        dialect = csv.Sniffer().sniff(text[:SNIFFED])
    except csv.Error:
        dialect = csv.excel_tab if (file.name or "").lower().endswith(".tsv") else csv.excel
    csv.field_size_limit(1 << 30)
    try:
        props = table_into(out, file.entity_id, csv.reader(io.StringIO(text.replace("\0", "")), dialect))
    except csv.Error as error:
        raise Failed(f"Invalid CSV: {error}") from error
    for prop, values in props.items():
        out.add(prop, *values)
    return out


def sheet_into(out: Result, file: File, title: str, rows: Iterable[list[object]], names: list[str] | None = None, inherited: tuple[str, ...] = (), always: bool = False) -> None:
    """A Table entity below the workbook.  Its first fragment names it, so that nothing is left alone if the rows fail."""
    table = make_id(file.entity_id, title)
    own = {p: out.props[p] for p in inherited if p in out.props}
    out.emit(table, "initial", "Table", title=title, parent=file.entity_id, ancestors=[*file.ancestors, file.entity_id], **own)
    props = table_into(out, table, rows, names)
    if always or "csvHash" in props:
        out.emit(table, "", "Table", title=title, **props)


def sqlite(file: File) -> Result:
    if not file.content.startswith(b"SQLite format 3\0"):
        raise Failed("Not an SQLite database.")
    out = Result("Workbook")
    with tempfile.TemporaryDirectory() as folder:  # of this one call
        path = os.path.join(folder, "db")
        with open(path, "wb") as f:
            f.write(file.content)
        base = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
        base.text_factory = lambda raw: raw.decode("utf-8", "replace")
        try:
            for (title,) in base.execute("select name from sqlite_master where type = 'table' order by rootpage").fetchall():
                if not re.match(r"[\w-]{2,4096}", title):
                    continue
                quoted = '"' + title.replace('"', '""') + '"'
                found = base.execute(f"select * from {quoted}")
                names = [c[0] for c in found.description]
                sheet_into(out, file, title, map(list, found), names, always=True)
        except sqlite3.Error as error:
            raise Failed(f"Cannot read SQLite database: {error}") from error
        finally:
            base.close()
    return out


def dbf_rows(raw: bytes) -> tuple[list[str], Iterator[list[object]]]:
    """Field names and rows of a dBase file; deleted rows are left out."""
    if len(raw) < 33:
        raise Failed("Not a DBF file.")
    count, start, width = struct.unpack("<IHH", raw[4:12])
    fields, at = [], 32
    while at + 32 <= start and raw[at] != 0x0D:
        name, kind, length = raw[at : at + 11].split(b"\0")[0].decode("ascii", "replace"), chr(raw[at + 11]), raw[at + 16]
        fields.append((name, kind, length))
        at += 32
    if not fields or sum(f[2] for f in fields) + 1 != width:
        raise Failed("Not a DBF file.")

    def rows() -> Iterator[list[object]]:
        for k in range(count):
            record = raw[start + k * width : start + (k + 1) * width]
            if len(record) < width or record[:1] == b"*":
                continue
            place, row = 1, []
            for _, kind, length in fields:
                text = decode(record[place : place + length])[0].strip().strip("\0")
                if kind == "D" and len(text) == 8 and text.isdigit():
                    text = f"{text[:4]}-{text[4:6]}-{text[6:]}"
                row.append(text or None)
                place += length
            yield row

    return [f[0] for f in fields], rows()


def dbf(file: File) -> Result:
    out = Result("Table")
    names, rows = dbf_rows(file.content)
    for prop, values in table_into(out, file.entity_id, rows, names).items():
        out.add(prop, *values)
    return out


def opened(file: File, failure: str = "Cannot open document.") -> zipfile.ZipFile:
    try:
        archive = zipfile.ZipFile(io.BytesIO(file.content))
    except zipfile.BadZipFile as error:
        raise Failed(ENCRYPTED if failure == ENCRYPTED else failure) from error
    if any(i.flag_bits & 1 for i in archive.infolist()):
        raise Failed(ENCRYPTED)
    return archive


def member(archive: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    try:
        return parse_xml(archive.read(name))
    except KeyError:
        return None


def elements(archive: zipfile.ZipFile, name: str, kinds: frozenset[str], opened: frozenset[str] = frozenset()) -> Iterator[ElementTree.Element]:
    """Elements named ``kinds`` of a member as they end, and those named ``opened`` as they begin; each is emptied when the next is asked for.

    So memory holds one of ``kinds``, not the tree, if what lies between them is small.
    """
    with archive.open(name) as head:
        if re.search(rb"<!ENTITY", head.read(65536), re.I):
            raise Failed("XML with entity definitions is not read.")
    path: list[ElementTree.Element] = []
    try:
        with archive.open(name) as raw:
            for event, el in ElementTree.iterparse(raw, ("start", "end")):
                if event == "start":
                    path.append(el)
                    if local(el.tag) in opened and not any(local(up.tag) in kinds for up in path):
                        yield el
                    continue
                path.pop()
                if local(el.tag) in kinds and not any(local(up.tag) in kinds for up in path):
                    yield el
                    el.clear()
                    if path:
                        path[-1].remove(el)
    except ElementTree.ParseError as error:
        raise Failed(f"Cannot parse XML: {error}") from error


def core_props_into(out: Result, archive: zipfile.ZipFile) -> None:
    """Metadata of an Office Open XML package."""
    root = member(archive, "docProps/core.xml")
    if root is None:
        return
    found = {local(el.tag): el.text for el in root.iter() if el.text}
    out.add("title", found.get("title"))
    out.add("summary", found.get("description"))
    out.add("author", found.get("creator"), found.get("lastModifiedBy"))
    out.add("authoredAt", timestamp(found.get("created")))
    out.add("modifiedAt", timestamp(found.get("modified")))


# What the metadata of an OpenDocument becomes.
ODF_PROPS = {"title": "title", "description": "summary", "creator": "author", "date": "date", "creation-date": "authoredAt", "generator": "generator"}


def odf_meta_into(out: Result, archive: zipfile.ZipFile) -> None:
    root = member(archive, "meta.xml")
    for el in root.iter() if root is not None else ():
        prop = ODF_PROPS.get(local(el.tag))
        if prop and el.text:
            out.add(prop, timestamp(el.text) if prop in ("date", "authoredAt") else el.text)


def column_of(ref: str) -> int:
    """0-based column of a cell reference such as AB12."""
    n = 0
    for c in re.match(r"[A-Z]*", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


#: Numbers of the built-in formats that show dates and times.
DATE_FORMATS = frozenset([*range(14, 23), *range(45, 48)])


def date_styles(archive: zipfile.ZipFile) -> set[int]:
    root = member(archive, "xl/styles.xml")
    if root is None:
        return set()
    own = {int(f.get("numFmtId")) for f in root.iter() if local(f.tag) == "numFmt" and re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")).lower())}
    cells = next((el for el in root if local(el.tag) == "cellXfs"), ())
    return {k for k, x in enumerate(cells) if int(x.get("numFmtId", 0)) in DATE_FORMATS | own}


def excel_date(value: str) -> str:
    """A serial day number as ISO text: a time alone below 1."""
    number = float(value)
    if number < 1:
        return (datetime.datetime(1900, 1, 1) + datetime.timedelta(seconds=round(number * 86400))).time().isoformat()
    return (datetime.datetime(1899, 12, 30) + datetime.timedelta(seconds=round(number * 86400))).isoformat()


def xlsx_rows(rows: Iterable[ElementTree.Element], shared: list[str], dates: set[int]) -> Iterator[list[object]]:
    for row in rows:
        cells: list[object] = []
        for cell in row:
            k = column_of(cell.get("r", "")) if cell.get("r") else len(cells)
            cells += [None] * (k - len(cells))
            parts = {local(el.tag): el for el in cell}
            value = parts["v"].text if "v" in parts else None
            kind = cell.get("t")
            if kind == "s" and value is not None:
                value = shared[int(value)]
            elif kind == "inlineStr" and "is" in parts:
                value = "".join(t.text or "" for t in parts["is"].iter() if local(t.tag) == "t")
            elif kind == "b" and value is not None:
                value = "True" if value == "1" else "False"
            elif value is not None and kind in (None, "n") and int(cell.get("s", 0)) in dates:
                value = excel_date(value)
            cells.append(value)
        yield cells


def xlsx(file: File) -> Result:
    archive = opened(file, ENCRYPTED)
    out = Result("Workbook")
    core_props_into(out, archive)
    book = member(archive, "xl/workbook.xml")
    if book is None:
        raise Failed("Cannot open document.")
    links = member(archive, "xl/_rels/workbook.xml.rels")
    target = {r.get("Id"): r.get("Target") for r in links} if links is not None else {}
    texts = "xl/sharedStrings.xml"
    shared = ["".join(t.text or "" for t in si.iter() if local(t.tag) == "t") for si in elements(archive, texts, frozenset({"si"}))] if texts in archive.namelist() else []
    dates = date_styles(archive)
    for sheet in (el for el in book.iter() if local(el.tag) == "sheet"):
        path = target.get(next((v for k, v in sheet.attrib.items() if local(k) == "id"), ""), "")
        if "chartsheets/" in path:
            continue
        name = path.lstrip("/") if path.startswith("/") else f"xl/{path}"
        if name in archive.namelist():
            sheet_into(out, file, sheet.get("name"), xlsx_rows(elements(archive, name, frozenset({"row"})), shared, dates), inherited=SHEET_PROPS)
    return out


def ods_cell(cell: ElementTree.Element) -> str | None:
    own = {local(k): v for k, v in cell.attrib.items()}
    if own.get("value-type") == "currency":
        return " ".join(x for x in (own.get("value"), own.get("currency")) if x) if own.get("value") is not None else None
    for name in ("date-value", "time-value", "boolean-value", "value"):
        if name in own:
            return own[name]
    return "\n".join("".join(p.itertext()) for p in cell.iter() if local(p.tag) == "p")


def ods_rows(rows: Iterable[ElementTree.Element]) -> Iterator[list[object]]:
    for row in (el for outer in rows for el in outer.iter() if local(el.tag) == "table-row"):
        cells: list[object] = []
        for cell in (el for el in row if local(el.tag) == "table-cell"):
            times = int(next((v for k, v in cell.attrib.items() if local(k) == "number-columns-repeated"), 1))
            value = ods_cell(cell)
            cells += [value] * (times if value else min(times, 1024))  # empty cells are repeated to a sheet's edge
        while cells and not cells[-1]:
            cells.pop()
        yield cells


def named(sheet: ElementTree.Element) -> str:
    return next((v for k, v in sheet.attrib.items() if local(k) == "name"), "")


def ods(file: File) -> Result:
    archive = opened(file)
    out = Result("Workbook")
    odf_meta_into(out, archive)
    if "content.xml" not in archive.namelist():
        raise Failed("Cannot open document.")
    found = elements(archive, "content.xml", frozenset({"table-row"}), frozenset({"table"}))
    sheet = next((el for el in found if local(el.tag) == "table"), None)
    while sheet is not None:
        after: list[ElementTree.Element] = []
        inner: list[tuple[str, list[list[object]]]] = []

        def rows(after: list = after, inner: list = inner) -> Iterator[ElementTree.Element]:
            for el in found:
                if local(el.tag) == "table":
                    after.append(el)
                    return
                inner += [(named(t), list(ods_rows([t]))) for t in el.iter() if local(t.tag) == "table"]  # tables in cells are sheets of their own too
                yield el

        sheet_into(out, file, named(sheet), ods_rows(rows()), inherited=ODS_SHEET_PROPS)
        for title, own in inner:
            sheet_into(out, file, title, own, inherited=ODS_SHEET_PROPS)
        sheet = after[0] if after else None
    return out


def paragraphs(root: ElementTree.Element, names: frozenset[str], words: frozenset[str] | None) -> list[str]:
    """Text of each paragraph; of its elements named ``words`` alone, if given."""
    out = []
    for p in (el for el in root.iter() if local(el.tag) in names):
        text = "".join(t.text or "" for t in p.iter() if local(t.tag) in words) if words else "".join(p.itertext())
        if text.strip():
            out.append(text)
    return out


def page_into(out: Result, file: File, number: int, text: str) -> None:
    """A page of a document, and the page's text as a fragment of the document."""
    out.emit(make_id(file.entity_id, number), "", "Page", document=file.entity_id, index=number, bodyText=text)
    out.index(file.entity_id, "Pages", f"page-{number}", [text])


def ooxml(file: File) -> Result:
    """Metadata and text.  A presentation has a page for each slide, any other document one page, as layout is not computed."""
    archive = opened(file)
    out = Result("Pages")
    core_props_into(out, archive)
    slides = sorted((n for n in archive.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
    for number, name in enumerate(slides or [n for n in archive.namelist() if n == "word/document.xml"], 1):
        root = member(archive, name)
        page_into(out, file, number, "\n".join(paragraphs(root, frozenset("p"), frozenset("t"))))
    return out


def opendoc(file: File) -> Result:
    """Metadata and text, in one page, as layout is not computed."""
    archive = opened(file)
    out = Result("Pages")
    odf_meta_into(out, archive)
    manifest = member(archive, "META-INF/manifest.xml")
    if manifest is not None and any(local(el.tag) == "encryption-data" for el in manifest.iter()):
        raise Failed(ENCRYPTED)
    root = member(archive, "content.xml")
    if root is None:
        raise Failed("Cannot open document.")
    page_into(out, file, 1, "\n".join(paragraphs(root, frozenset({"p", "h"}), None)))
    return out
