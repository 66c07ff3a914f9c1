"""Bytes of files in each format, made of rows, to run the extractors on."""

from __future__ import annotations

import base64
import bz2
import csv
import gzip
import io
import re
import sqlite3
import struct
import tarfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from html import escape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.model import entity_id
from loamline.storage import tasks

Row = dict
#: Files, and their bytes, that make a batch.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def made(rows: DataFrame, build: Callable[[Row], bytes], suffix: str = "") -> DataFrame:
    """A file for each row, named by its ``key`` and ``suffix``, with the bytes that ``build`` makes of it.

    A table of few bytes lies in few partitions, but its files take long to make and to read, so its rows are dealt to :func:`tasks`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            columns = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names)]
            for k in range(batch.num_rows):
                row = {n: c[k].as_py() for n, c in columns}
                held.append((f"{row['key']}{suffix}", build(row)))
                size += len(held[-1][1])
                if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield filed(held)
                    held, size = [], 0
        yield filed(held)

    return as_files(rows.repartition(tasks(rows.sparkSession)).mapInArrow(run, "file_name string, content binary"))


def filed(held: list[tuple[str, bytes]]) -> pa.RecordBatch:
    names, contents = zip(*held, strict=True) if held else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], names=["file_name", "content"])


def as_files(named: DataFrame) -> DataFrame:
    """Rows (file_name, content) as files without parents."""
    return named.select(
        entity_id(F.col("file_name"), F.sha1("content")).alias("entity_id"), F.lit("Document").alias("schema"), "file_name", F.lit(None).cast("string").alias("mime"), "content",
        F.lit(None).cast("string").alias("parent"), F.array().cast("array<string>").alias("ancestors"),
    )


def csv_of(row: Row) -> bytes:
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    for r in row["rows"]:
        writer.writerow(r.values())
    writer.writerow([""] * 3)
    return out.getvalue().encode()


def zipped(members: Iterable[tuple[str, str | bytes]]) -> bytes:
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members:
            z.writestr(zipfile.ZipInfo(name), content)
    return raw.getvalue()


def tarred(members: Iterable[tuple[str, bytes]], mode: str = "w") -> bytes:
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode=mode) as t:
        for name, content in members:
            info = tarfile.TarInfo(name)
            info.size = len(content)
            t.addfile(info, io.BytesIO(content))
        link = tarfile.TarInfo("link.txt")
        link.type, link.linkname = tarfile.SYMTYPE, "/etc/passwd"
        t.addfile(link)
    return raw.getvalue()


def archive_members(row: Row) -> list[tuple[str, bytes]]:
    """Texts in folders, and two members that are to be left out."""
    own = [(f"{r['folder']}/{r['name']}.txt", r["text"].encode()) for r in row["rows"]]
    return [*own, ("../evil.txt", b"outside"), (".git/config", b"skipped")]


def zip_of(row: Row) -> bytes:
    return zipped(archive_members(row))


def tar_of(row: Row) -> bytes:
    return tarred(archive_members(row))


def tgz_of(row: Row) -> bytes:
    return tarred(archive_members(row), "w:gz")


def gzip_of(row: Row) -> bytes:
    return gzip.compress(row["text"].encode(), mtime=0)


def bzip2_of(row: Row) -> bytes:
    return bz2.compress(row["text"].encode())


def sqlite_of(row: Row) -> bytes:
    """Tables of nations and of suppliers, and one whose name is too short to be listed."""
    base = sqlite3.connect(":memory:")
    base.execute("create table nations (n_key integer, n_name text)")
    base.execute('create table "all suppliers" (s_key integer, s_name text, none text)')
    base.execute("create table x (z)")
    base.executemany("insert into nations values (?, ?)", [tuple(r.values()) for r in row["nations"]])
    base.executemany('insert into "all suppliers" values (?, ?, null)', [tuple(r.values()) for r in row["suppliers"]])
    base.commit()
    raw = base.serialize()
    base.close()
    return raw


def dbf_of(row: Row) -> bytes:
    """Number, name and day; every seventh row is marked as deleted."""
    fields = [("ID", b"N", 10), ("NAME", b"C", 30), ("DAY", b"D", 8)]
    width = 1 + sum(f[2] for f in fields)
    head = b"".join(n.encode().ljust(11, b"\0") + kind + bytes(4) + bytes([size]) + bytes(15) for n, kind, size in fields) + b"\r"
    rows = b"".join((b"*" if r["id"] % 7 == 0 else b" ") + str(r["id"]).rjust(10).encode() + r["name"].encode().ljust(30) + b"20200102" for r in row["rows"])
    return b"\x03" + bytes(3) + struct.pack("<IHH", len(row["rows"]), 32 + len(head), width) + bytes(20) + head + rows


CORE = '<p xmlns:dc="urn:dc" xmlns:cp="urn:cp" xmlns:t="urn:t"><dc:title>{title}</dc:title><dc:description>About {title}</dc:description><dc:creator>{author}</dc:creator><cp:lastModifiedBy>Editor</cp:lastModifiedBy><t:created>2020-01-02T03:04:05Z</t:created><t:modified>2021:01:02 03:04:05</t:modified></p>'


def core_of(title: str, author: str) -> tuple[str, str]:
    return "docProps/core.xml", CORE.format(title=escape(title), author=escape(author))


def xlsx_of(row: Row) -> bytes:
    """Two sheets, of shared, inline, numeric and date cells, and a chart sheet."""
    shared: list[str] = []

    def cells(k: int, r: Row) -> str:
        shared.append(r["name"])
        day = f'<c r="D{k}" s="1"><v>{43831 + r["id"] % 300}.5</v></c>'  # 43831 is 2020-01-01
        return f'<row r="{k}"><c r="A{k}"><v>{r["id"]}</v></c><c r="B{k}" t="s"><v>{len(shared) - 1}</v></c><c r="C{k}" t="inlineStr"><is><t>in-{r["id"] % 3}</t></is></c>{day}</row>'

    sheet = lambda rows: f"<worksheet><sheetData>{''.join(cells(k, r) for k, r in enumerate(rows, 1))}</sheetData></worksheet>"
    names = ("Customers", "Suppliers")
    links = "".join(f'<Relationship Id="r{k}" Target="worksheets/sheet{k}.xml"/>' for k in (0, 1)) + '<Relationship Id="r2" Target="chartsheets/sheet1.xml"/>'
    book = "".join(f'<sheet name="{n}" r:id="r{k}"/>' for k, n in enumerate((*names, "Chart")))
    sheets = [(f"xl/worksheets/sheet{k}.xml", sheet(row[n.lower()])) for k, n in enumerate(names)]
    return zipped([
        ("xl/workbook.xml", f'<workbook xmlns:r="urn:r"><sheets>{book}</sheets></workbook>'), ("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>"), *sheets,
        ("xl/sharedStrings.xml", f"<sst>{''.join(f'<si><t>{escape(s)}</t></si>' for s in shared)}</sst>"),
        ("xl/styles.xml", '<styleSheet><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>'), core_of(f"Book {row['key']}", row["author"]),
    ])


def odf_meta(title: str, author: str) -> tuple[str, str]:
    return "meta.xml", f'<m xmlns:dc="urn:dc" xmlns:meta="urn:m"><dc:title>{escape(title)}</dc:title><dc:description>About it</dc:description><dc:creator>{escape(author)}</dc:creator><dc:date>2021-01-02T03:04:05.123</dc:date><meta:creation-date>2020-01-02T03:04:05</meta:creation-date><meta:generator>Maker/1</meta:generator></m>'


def ods_of(row: Row) -> bytes:
    """A sheet for each nation: an amount of money, a name, and the same text in two columns."""

    def sheet(s: Row) -> str:
        cells = "".join(
            f'<t:table-row><t:table-cell o:value-type="currency" o:value="{r["id"]}" o:currency="EUR"><x:p>no</x:p></t:table-cell><t:table-cell><x:p>{escape(r["name"])}</x:p></t:table-cell>'
            f'<t:table-cell t:number-columns-repeated="2"><x:p>{escape(r["segment"])}</x:p></t:table-cell><t:table-cell t:number-columns-repeated="1000"/></t:table-row>' for r in s["rows"]
        )
        return f'<t:table t:name="{escape(s["title"])}">{cells}</t:table>'

    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        meta, text = odf_meta(f"Sheets of {row['key']}", row["key"])
        z.writestr(zipfile.ZipInfo(meta), text)
        with z.open(zipfile.ZipInfo("content.xml"), "w", force_zip64=True) as out:
            out.write(b'<c xmlns:t="urn:t" xmlns:o="urn:o" xmlns:x="urn:x">')
            for s in row["sheets"]:
                out.write(sheet(s).encode())
            out.write(b"</c>")
    return raw.getvalue()


def docx_of(row: Row) -> bytes:
    paragraphs = "".join(f"<w:p><w:r><w:t>{escape(x)}</w:t></w:r><w:r><w:t> !</w:t></w:r></w:p>" for x in row["texts"])
    return zipped([core_of(f"Doc {row['key']}", row["key"]), ("word/document.xml", f'<w:d xmlns:w="urn:w">{paragraphs}<w:p/></w:d>')])


def pptx_of(row: Row) -> bytes:
    slides = [(f"ppt/slides/slide{k}.xml", f'<s xmlns:a="urn:a"><a:p><a:r><a:t>{escape(x)}</a:t></a:r></a:p></s>') for k, x in enumerate(row["texts"], 1)]
    return zipped([*reversed(slides), core_of(f"Slides {row['key']}", row["key"])])


def odt_of(row: Row) -> bytes:
    content = "".join(f"<x:h>{escape(x)}</x:h><x:p>in <x:s>{escape(x)}</x:s></x:p>" for x in row["texts"])
    return zipped([odf_meta(f"Text {row['key']}", row["key"]), ("content.xml", f'<c xmlns:x="urn:x">{content}</c>')])


def message(subject: str, sender: str, number: str, text: str, more: str = "") -> bytes:
    body = base64.encodebytes(text.encode()).decode()
    return f"From: {sender}\nTo: all@example.org\nSubject: {subject}\nMessage-ID: <{number}@mail.example>\n{more}Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: base64\n\n{body}".encode()


def turn(r: Row) -> bytes:
    return message(f"{r['conv_id']}:{r['turn']}", f"{r['role']}@example.org", f"turn-{r['conv_id']}-{r['turn']}", r["text"])


def mbox_of(row: Row) -> bytes:
    return b"".join(b"From - Thu Jan  2 03:04:05 2020\n" + turn(r) + b"\n" for r in row["rows"])


def emlx_of(row: Row) -> bytes:
    raw = turn(row)
    return str(len(raw)).encode() + b"\n" + raw + b"<plist>not part of it</plist>"


def addressed_of(row: Row) -> bytes:
    """A message from a name with an address, a bare address, a name that is an address, or one without an address."""
    k, name = row["id"], row["name"]
    sender = (f"{name} <c{k}@Example.org>", f"c{k}@example.org", f'"c{k}@example.org" <other{k}@example.org>', f"{name} <no-address>")[k % 4]
    date = "not a date" if k % 5 == 0 else f"Thu, 02 Jan 2020 {k % 24:02d}:04:05 +0100"
    ids = f"References: <x> <first-{k}@mail.example>\n <last-{k}@mail.example>\nIn-Reply-To: <else-{k}@mail.example>\n" if k % 3 else f"In-Reply-To: <else-{k}@mail.example> <more-{k}@mail.example>\n"
    more = f"Cc: Team One <team@example.org>, c{k}@example.org\nDate: {date}\nX-Mailer: Pigeon {k % 2}\nKeywords: {row['segment']}\n{ids}"
    return message(f"About {name}", sender, f"own-{k}", "Body", more)


def parted_of(row: Row) -> bytes:
    """A message of parts: an alternative, a text, a message inside, and an attachment."""
    k, text = row["key"], base64.encodebytes(row["text"].encode()).decode()
    both = f"Content-Type: text/plain\n\nPlain {k}\n--y\nContent-Type: text/html\n\n<b>Rich</b> {k}"
    parts = [
        f'Content-Type: multipart/alternative; boundary="y"\n\n--y\n{both}\n--y--\n', f"Content-Type: text/plain\n\nIt's <{row['role']}>\nand & so on",
        f"Content-Type: text/html\n\n<p>Page <i>{k}</i></p>", f"Content-Type: message/rfc822\n\nFrom: c@example.org\nSubject: Inner {k}\nX-No: hidden\n\nInner body {k}",
        f'Content-Type: text/plain; name="a.txt"\nContent-Disposition: attachment; filename="a-{k}.txt"\nContent-Transfer-Encoding: base64\n\n{text}',
    ]
    mixed = "".join(f"--x\n{p}\n" for p in parts)
    return f'From: a@example.org\nSubject: Parts\nContent-Type: multipart/mixed; boundary="x"\n\n{mixed}--x--\n'.encode()


def olm_of(row: Row) -> bytes:
    def stored(r: Row) -> str:
        rich = "<OPFMessageGetHasHTML>1E0</OPFMessageGetHasHTML>" if r["turn"] % 2 else ""
        person = f'<emailAddress OPFContactEmailAddressName="{r["role"]} of the talk" OPFContactEmailAddressAddress="{r["role"]}@example.org"/>'
        return (
            f"<emails><email><OPFMessageCopySubject>{r['conv_id']}:{r['turn']}</OPFMessageCopySubject><OPFMessageCopyMessageID>turn-{r['turn']}@x</OPFMessageCopyMessageID><OPFMessageCopySentTime>2020-01-02T03:04:05</OPFMessageCopySentTime>"
            f"<OPFMessageCopyBody>{escape(r['text'])}</OPFMessageCopyBody>{rich}<OPFMessageCopyHTMLBody>&lt;p&gt;Rich&lt;/p&gt;</OPFMessageCopyHTMLBody><OPFMessageCopyFromAddresses>{person}</OPFMessageCopyFromAddresses>"
            f'<OPFMessageCopyAttachmentList><messageAttachment OPFAttachmentURL="att/{r["turn"]}" OPFAttachmentName="note-{r["conv_id"]}-{r["turn"]}.txt"/></OPFMessageCopyAttachmentList></email></emails>'
        )

    messages = [(f"Accounts/com.microsoft.__Messages/Inbox {row['key']}/message_{r['turn']}.xml", stored(r)) for r in row["rows"]]
    return zipped([*messages, *((f"att/{r['turn']}", f"note of {r['role']}") for r in row["rows"]), ("other.xml", "<x/>")])


def vcf_of(row: Row) -> bytes:
    card = lambda r: f"BEGIN:VCARD\r\nVERSION:3.0\r\nN:{r['name'][8:]};{r['name'][:8]};;;\r\nFN:{r['name']}\r\nitem1.TEL;type=WORK:+1 781 555 {r['id'] % 10000:04d}\r\nTITLE:{r['segment'][:4]}\r\n {r['segment'][4:]}\r\nEMAIL:first{r['id']}@example.org\r\nEMAIL;type=x:Last{r['id']}@Example.org\r\nEND:VCARD\r\n"
    return ("".join(map(card, row["rows"])) + "BEGIN:VCARD\r\nFN:No Mail\r\nEND:VCARD\r\n").encode()


def ics_of(row: Row) -> bytes:
    owner = row["key"].partition(".")[0]

    def one(r: Row) -> str:
        uid = f"UID:event-{r['id']}\r\n"
        return f"BEGIN:VEVENT\r\n{uid}SUMMARY:{r['kind']}\\, number {r['id']}\r\nDTSTART;VALUE=DATE:20240102\r\nDTEND:20240102T030405Z\r\nORGANIZER;CN=O:mailto:u{owner}@example.org\r\nATTENDEE:MAILTO:{r['kind']}@ex\r\n ample.org\r\nEND:VEVENT\r\n"

    return ("BEGIN:VCALENDAR\r\nPRODID:-//Maker//EN\r\n" + "".join(map(one, row["rows"])) + "END:VCALENDAR\r\n").encode()


def xml_of(row: Row) -> bytes:
    if row["id"] % 10 == 0:
        return f'<!DOCTYPE x [<!ENTITY a "b">]><x>&a; {row["id"]}</x>'.encode()
    return f"<part><name>{escape(row['name'])} &lt;</name><more><brand>{escape(row['brand'])}</brand><size>{row['size']}</size></more></part>".encode()


def page_of(row: Row) -> bytes:
    k = row["id"]
    og = f'<meta property="og:title" content="{escape(row["name"])}  {k}">' if k % 2 else ""
    description = f'<meta name="description" content="What {escape(row["name"])} is">' if k % 3 else '<meta name="og:description" content="By name">'
    return (
        f'<!DOCTYPE html><html lang="en"><head><title>Part {k}</title>{og}{description}<meta name="keywords" content="{escape(row["brand"])}, widget"><meta name="news_keywords" content="widget,{row["size"]}">'
        f'<meta name="author" content="A. Author"><meta property="article:published_time" content="2020-01-{1 + k % 28:02d}T03:04:05.123"><meta property="artcile:modified_time" content="about noon"><style>p {{}}</style></head>'
        f"<body><p>Hello <b>{escape(row['name'])}</b>&nbsp;page.</p><script>no()</script>lost tail<p>Size {row['size']}<!--noted--><br>end</p></body></html>"
    ).encode()


def json_of(row: Row) -> bytes:
    import json

    return json.dumps({"name": row["name"], "n": 10, "list": ["7", {"in": f"nation {row['nation']}"}, [row["name"].upper(), 1.5, None, True]], "last": " "}).encode()


def svg_of(row: Row) -> bytes:
    return f'<svg xmlns="http://www.w3.org/2000/svg"><title>Drawing {row["key"]}</title><text>{escape(row["name"])}</text><text>of  {row["key"]}</text></svg>'.encode()


def encoded_of(row: Row) -> bytes:
    """Text as UTF-8, UTF-16 or, if it can be, Latin-1."""
    text, k = row["text"], row["id"] % 3
    if k == 2:
        try:
            return text.encode("latin-1")
        except UnicodeEncodeError:
            pass
    return text.encode("utf-16" if k == 1 else "utf-8")


#: Bytes by which a file without a name tells its type, with that type's extractor.
SIGNS = (
    (b"%PDF-1.4\n", "pdf"), (b"PK\x03\x04rest", "zip"), (b"\x1f\x8b\x08rest", "gz"), (b"BZh9rest", "bz2"), (b"\x89PNG\r\n\x1a\nrest", "image"), (b"  <!DOCTYPE html><p>x", "html"), (b"<?xml version='1.0'?><x/>", "xml"),
    (b"BEGIN:VCARD\n", "vcard"), (b"Message-ID: <a@b>\n\nx", "msg"), (b"plain words", "plain"), (b"SQLite format 3\x00rest", "sqlite"), (b"<svg><text>x</text></svg>", "svg"), (b"II*\x00rest", "tiff"),
)


def signed_of(row: Row) -> bytes:
    sign, _ = SIGNS[row["id"] % len(SIGNS)]
    return sign + (str(row["id"]).encode() if sign.startswith((b"plain", b"%PDF", b"PK")) else b"")


#: Files that are broken in a way each: (ending, bytes, status, error).
BROKEN = (
    (".txt", b"sound", "success", None), (".zip", b"PK no zip", "failure", "Could not unpack the contents of this file."), (".xlsx", b"\xd0\xcf\x11\xe0 no zip", "failure", "The document might be protected with a password. Try removing the password protection and re-uploading the documents."),
    (".unknown", b"\x00\x01\x02", "failure", "Format not supported"), (".sqlite", b"no database", "failure", "Not an SQLite database."), (".dbf", b"no table", "failure", "Not a DBF file."), (".ics", b"no calendar", "failure", "Failed to parse iCalendar"),
    (".gz", b"no gzip", "failure", "Could not unpack the contents of this file."), (".emlx", b"no length\n", "failure", "Cannot parse email: no length"), (".dll", b"MZ", "success", None),
)


def broken_of(row: Row) -> bytes:
    return BROKEN[row["id"] % len(BROKEN)][1]


def pdf_of(row: Row) -> bytes:
    """A page for each text: in codes of a Latin font, or, every second page, in codes of a font's own with a map to Unicode."""
    import zlib

    objects: list[bytes] = [b"<</Type/Catalog/Pages 2 0 R>>", b"", b"<</Type/Font/Subtype/Type1/BaseFont/Helvetica/Encoding/WinAnsiEncoding>>", b"<</Type/Font/Subtype/Type0/BaseFont/Own/Encoding/Identity-H/ToUnicode 5 0 R>>"]
    stream = lambda head, data: b"<<%s/Filter/FlateDecode/Length %d>>\nstream\n%s\nendstream" % (head, len(z := zlib.compress(data)), z)
    objects.append(stream(b"", b"1 begincodespacerange <0000> <ffff> endcodespacerange 1 beginbfrange <0021> <00ff> <0020> endbfrange"))
    kids = []
    for k, text in enumerate(row["texts"]):
        own = b"<" + b"".join(b"%04x" % (ord(c) + 1) for c in text) + b">" if k % 2 else b"(" + re.sub(r"([()\\])", r"\\\1", text).encode("cp1252") + b")"
        font = b"/F2" if k % 2 else b"/F1"
        content = b"q 1 0 0 1 10 20 cm BT %s 12 Tf 50 600 Td [(Second) -400 (line)] TJ ET Q BT /F1 12 Tf 14 TL 60 700 Td (Page) Tj 60 0 Td %s 12 Tf %s Tj ET" % (b"/F1", font, own)
        objects.append(stream(b"", content))
        objects.append(b"<</Type/Page/Parent 2 0 R/Contents %d 0 R/Resources<</Font<</F1 3 0 R/F2 4 0 R>>>>>>" % len(objects))
        kids.append(b"%d 0 R" % len(objects))
    objects[1] = b"<</Type/Pages/Count %d/Kids[%s]>>" % (len(kids), b" ".join(kids))
    body = b"".join(b"%d 0 obj\n%s\nendobj\n" % (k, o) for k, o in enumerate(objects, 1))
    return b"%PDF-1.5\n" + body + b"trailer\n<</Root 1 0 R/Size %d>>\n%%%%EOF" % (len(objects) + 1)


def compound_of(streams: dict[str, bytes]) -> bytes:
    """A compound file of ``streams``; those of less than 4096 bytes lie in its mini stream."""
    folders: dict[str, int] = {"": 0}
    nodes: list[list] = [["Root Entry", 5, "", b""]]
    for path, content in streams.items():
        *above, name = path.split("/")
        at = ""
        for part in above:
            up, at = at, f"{at}{part}/"
            if at not in folders:
                folders[at] = len(nodes)
                nodes.append([part, 1, up, b""])
        nodes.append([name, 2, at, content])
    mini = b"".join(n[3].ljust(-(-len(n[3]) // 64) * 64, b"\0") for n in nodes if n[1] == 2 and 0 < len(n[3]) < 4096)
    end, free, fat_mark = 0xFFFFFFFE, 0xFFFFFFFF, 0xFFFFFFFD
    sectors: list[bytes] = []
    fat: list[int] = []

    def put(raw: bytes) -> int:
        if not raw:
            return end
        first, n = len(sectors), -(-len(raw) // 512)
        for k in range(n):
            sectors.append(raw[512 * k : 512 * k + 512].ljust(512, b"\0"))
            fat.append(first + k + 1 if k < n - 1 else end)
        return first

    mini_fat, place = [], 0
    starts = []
    for _, kind, _, content in nodes:
        if kind == 2 and 0 < len(content) < 4096:
            n = -(-len(content) // 64)
            starts.append(place)
            mini_fat += [place + k + 1 if k < n - 1 else end for k in range(n)]
            place += n
        else:
            starts.append(put(content) if kind == 2 else 0)
    starts[0] = put(mini)
    entries = b""
    for k, (name, kind, at, content) in enumerate(nodes):
        own = f"{at}{name}/" if kind == 1 else ""
        kids = [j for j, n in enumerate(nodes) if j and n[2] == own] if kind != 2 else []
        siblings = [j for j, n in enumerate(nodes) if j and n[2] == at] if k else []
        right = siblings[siblings.index(k) + 1] if k and siblings.index(k) + 1 < len(siblings) else free
        raw_name = name.encode("utf-16-le") + b"\0\0"
        size = len(mini) if not k else len(content)
        entries += raw_name.ljust(64, b"\0") + struct.pack("<HBBIII", len(raw_name), kind, 1, free, right, kids[0] if kids else free) + bytes(36) + struct.pack("<IQ", starts[k], size)
    entries += (bytes(68) + struct.pack("<III", free, free, free) + bytes(48)) * (-(len(entries) // 128) % 4)
    first_dir = put(entries)
    raw_mini_fat = struct.pack(f"<{len(mini_fat)}I", *mini_fat)
    first_mini = put(raw_mini_fat + b"\xff" * (-len(raw_mini_fat) % 512))
    n_fat = 1
    while n_fat * 128 < len(fat) + n_fat:
        n_fat += 1
    at = [len(sectors) + k for k in range(n_fat)]
    table = [*fat, *[fat_mark] * n_fat]
    table += [free] * (n_fat * 128 - len(table))
    head = bytes.fromhex("D0CF11E0A1B11AE1") + bytes(16) + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + bytes(6) + struct.pack("<II", 0, n_fat)
    head += struct.pack("<IIIIIII", first_dir, 0, 4096, first_mini, -(-len(raw_mini_fat) // 512), end, 0) + struct.pack("<109I", *at, *[free] * (109 - n_fat))
    return head + b"".join(sectors) + struct.pack(f"<{len(table)}I", *table)


def summary_of(title: str, author: str) -> bytes:
    """A property set: code page, title, author and a day of creation."""
    day = struct.pack("<Q", 132_224_078_450_000_000)  # 2020-01-02T03:04:05
    text = lambda s: struct.pack("<II", 30, len(s.encode()) + 1) + s.encode() + b"\0" * (4 - len(s.encode()) % 4)
    values = [(1, struct.pack("<IHH", 2, 65001, 0)), (2, text(title)), (4, text(author)), (12, struct.pack("<I", 64) + day)]
    places, body = b"", b""
    for number, raw in values:
        places += struct.pack("<II", number, 8 + 8 * len(values) + len(body))
        body += raw
    section = struct.pack("<II", 8 + len(places) + len(body), len(values)) + places + body
    return struct.pack("<HHI", 0xFFFE, 0, 2) + bytes(16) + struct.pack("<I", 1) + bytes(16) + struct.pack("<I", 48) + section


def xls_of(row: Row) -> bytes:
    """A sheet of rows: a number, a text of the string table, a short number, a day, and an empty day."""
    record = lambda kind, body: struct.pack("<HH", kind, len(body)) + body
    texts = [r["name"] for r in row["rows"]]
    table = struct.pack("<II", len(texts), len(texts)) + b"".join(struct.pack("<HB", len(t), k % 2) + t.encode("utf-16-le" if k % 2 else "latin-1") for k, t in enumerate(texts))
    parts = [table[k : k + 8000] for k in range(0, len(table), 8000)] if len(table) <= 8000 else None
    if parts is None:  # cut between texts
        parts, held = [], struct.pack("<II", len(texts), len(texts))
        for k, t in enumerate(texts):
            own = struct.pack("<HB", len(t), k % 2) + t.encode("utf-16-le" if k % 2 else "latin-1")
            if len(held) + len(own) > 8000:
                parts, held = [*parts, held], b""
            held += own
        parts.append(held)
    cells = b""
    for k, r in enumerate(row["rows"]):
        at = lambda c, style=0: struct.pack("<HHH", k, c, style)  # noqa: B023, E731
        cells += record(0x203, at(0) + struct.pack("<d", r["id"])) + record(0xFD, at(1) + struct.pack("<I", k)) + record(0x27E, at(2) + struct.pack("<I", (r["id"] % 1000) << 2 | 3))
        cells += record(0x203, at(3, 1) + struct.pack("<d", 43831.5 + r["id"] % 300)) + record(0x203, at(4, 1) + struct.pack("<d", 0.0))
    style = lambda number: record(0xE0, struct.pack("<HH", 0, number) + bytes(16))
    front = record(0x809, bytes(16)) + style(0) + style(14)
    strings = record(0xFC, parts[0]) + b"".join(record(0x3C, p) for p in parts[1:])
    named = lambda at: record(0x85, struct.pack("<IBBBB", at, 0, 0, 5, 0) + b"Sheet")
    start = len(front) + len(named(0)) + len(strings) + 4
    book = front + named(start) + strings + record(0x0A, b"") + record(0x809, bytes(16)) + cells + record(0x0A, b"")
    return compound_of({"Workbook": book, "\x05SummaryInformation": summary_of(f"Book {row['key']}", f"nation {row['key']}")})


def msg_of(row: Row) -> bytes:
    """An Outlook message with a sender, two recipients, rich text and an attachment."""
    wide = lambda s: s.encode("utf-16-le")
    field = lambda number, kind="001F": f"__substg1.0_{number}{kind}"
    number = lambda tag, value: struct.pack("<HHI", 0x40, tag, 6) + struct.pack("<Q", value)
    name = f"{row['conv_id']}:{row['turn']}"
    rich = b"{\\rtf1 " + name.encode() + b"}"
    streams = {
        "__properties_version1.0": bytes(32) + number(0x0039, 132_224_078_450_000_000), field("0037"): wide(name), field("1000"): wide(row["text"]), field("1035"): wide(f"<turn-{row['turn']}@mail.example>"),
        field("0C1A"): wide(f"{row['role']} of the talk"), field("5D01"): wide(f"{row['role']}@example.org"), field("0070"): wide(f"talk {row['conv_id']}"), field("1009", "0102"): struct.pack("<IIII", len(rich) + 12, len(rich), 0x414C454D, 0) + rich,
    }
    for k, (who, kind) in enumerate((("Team One", 1), ("Team Two", 2))):
        at = f"__recip_version1.0_#{k:08X}/"
        streams |= {at + "__properties_version1.0": bytes(8) + number(0x0C15, kind), at + field("3001"): wide(who), at + field("39FE"): wide(f"team{k}@example.org")}
    at = "__attach_version1.0_#00000000/"
    return compound_of(streams | {at + field("3707"): wide(f"note-{row['conv_id']}-{row['turn']}.txt"), at + field("3701", "0102"): f"note of {row['role']}".encode()})
