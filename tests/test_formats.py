"""Formats read in plain Python or by programs, registered formats, and the commands."""

import os
import stat
import struct
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loamline.__main__ import main
from loamline.functions import language
from loamline.functions import text as T
from loamline.model import merge
from loamline.plans import files as M
from loamline.plans import formats
from loamline.plans.catalogue import QUERIES
from loamline.plans.ingest import EXTRACT, extracting, ingest, ingest_files, register
from loamline.registry import EXTRACTORS, FAMILY_BIDS, Extractor
from loamline.sources import mail, ole, pdf, programs, tables
from loamline.sources.base import ENCRYPTED, Failed, File, Result
from loamline.streaming.control import cache_clear, cache_results


def file(content, name="f"):
    return File("id", name, content)


def tool(folder, name, body):
    """A program of that name that runs ``body``."""
    path = folder / name
    path.write_text("#!/bin/sh\n" + body + "\n")
    path.chmod(path.stat().st_mode | stat.S_IEXEC)
    return str(path)


def test_pdf_of_streams_in_streams_and_forms():
    packed = zlib.compress(b"1 0 2 35 <</Type/Catalog/Pages 2 0 R>>       <</Type/Pages/Kids[3 0 R]/Resources<</Font<</F 5 0 R>>/XObject<</X 7 0 R>>>>>>")
    content = b"BT /F 10 Tf 0 700 Td (caf\\351 \\(x\\)) Tj 0 -12 Td [(A) -20 (B) -600 (C)] TJ ET q 1 0 0 1 0 -300 cm /X Do Q BI /W 1 ID zz EI"
    form = b"BT /F 10 Tf 10 690 Td <466F726D> Tj ET"
    raw = b"%PDF-1.7\n9 0 obj <</Type/ObjStm/N 2/First 9/Filter/FlateDecode/Length " + str(len(packed)).encode() + b">> stream\n" + packed + b"\nendstream endobj\n"
    raw += b"3 0 obj <</Type/Page/Contents[4 0 R]>> endobj 4 0 obj <</Length 9999>> stream\n" + content + b"\nendstream endobj 5 0 obj <</Type/Font/Subtype/Type1/Encoding<</Differences[67/Odieresis]>>>> endobj\n"
    raw += b"7 0 obj <</Subtype/Form/Length " + str(len(form)).encode() + b">> stream\n" + form + b"\nendstream endobj trailer <</Root 1 0 R>>"
    assert list(pdf.page_texts(raw)) == ["cafe\u0301 (x)\nAB O\u0308\nForm"]


def test_pdf_failures():
    with pytest.raises(Failed, match="Not a PDF"):
        pdf.pdf(file(b"no"))
    with pytest.raises(Failed) as failed:
        pdf.pdf(file(b"%PDF-1.4 1 0 obj <</Type/Catalog>> endobj trailer <</Root 1 0 R/Encrypt 2 0 R>>"))
    assert str(failed.value) == ENCRYPTED
    with pytest.raises(Failed, match="No pages"):
        pdf.pdf(file(b"%PDF-1.4 1 0 obj <</Type/Catalog/Pages 2 0 R>> endobj 2 0 obj <</Kids[2 0 R]>> endobj"))


def test_compound_files_of_small_and_large_streams():
    streams = {"a": b"x" * 100, "in/b": bytes(range(256)) * 40, "in/deep/c": b"", "z": b"y" * 4096}
    assert ole.Container(M.compound_of(streams)).streams == streams
    with pytest.raises(Failed):
        ole.Container(b"no")


def test_rich_text_refers_back():
    # Nine literals, then a reference of 4 to the last of them, which repeats it.
    text = b"{\\rtf1 ab"
    place = len(ole.RTF_START) + len(text) - 1
    body = bytes([0]) + text[:8] + bytes([0b10]) + text[8:] + struct.pack(">H", place << 4 | 2)
    packed = struct.pack("<III", len(body) + 12, len(text) + 4, 0x75465A4C) + bytes(4) + body
    assert ole.rich_text(packed) == text + b"bbbb"


def test_nested_outlook_message():
    wide = lambda s: s.encode("utf-16-le")
    at = "__attach_version1.0_#00000000/__substg1.0_3701000D/"
    raw = M.compound_of({"__substg1.0_0037001F": wide("Outer"), "__substg1.0_1000001E": b"Body", "__substg1.0_007D001F": wide("From: Ann <ann@example.org>\nReferences: <one@x.y> <two@x.y>\n"), at + "__substg1.0_0037001F": wide("Inner"), at + "__substg1.0_1000001F": wide("Deep")})
    props = ole.outlook_message(file(raw)).props
    assert props["bodyText"] == ["Body", "Inner", "Deep"] and props["from"] == ["Ann <ann@example.org>"] and props["inReplyTo"] == ["two@x.y"]


def test_texts_of_a_workbook_go_on_in_the_next_record():
    head = struct.pack("<II", 2, 2) + struct.pack("<HB", 6, 0) + b"abc"
    assert ole.shared_strings([head, b"\x01" + "déf".encode("utf-16-le") + struct.pack("<HB", 1, 0) + b"z"]) == ["abcdéf", "z"]
    assert [ole.short_number(x) for x in (5 << 2 | 2, (2**32 - 4) | 2, 0x3FF00000, 0x3FF00001)] == [5.0, -1.0, 1.0, 0.01]


def test_programs(tmp_path, monkeypatch):
    monkeypatch.setenv("PATH", "/usr/bin:/bin")
    for extract in (programs.office, programs.rar, programs.seven_zip, programs.pst, programs.djvu, programs.tiff, programs.access, programs.media("Audio")):
        with pytest.raises(Failed, match="missing"):
            extract(file(b"x")).everything()
    (tmp_path / "made.pdf").write_bytes(M.pdf_of({"texts": ["One"]}))
    monkeypatch.setenv("SOFFICE_BIN", tool(tmp_path, "soffice", f'while [ "$1" != --outdir ]; do shift; done; cp {tmp_path}/made.pdf "$2/document.pdf"'))
    out = programs.office(file(M.compound_of({"\x05SummaryInformation": M.summary_of("T", "A")}), "a.doc"))
    assert out.props["title"] == ["T"] and out.props["author"] == ["A"] and out.fragments[0][3]["bodyText"] == ["Page One\nSecond line"]
    monkeypatch.setenv("TIFF2PDF_BIN", tool(tmp_path, "tiff2pdf", f'[ "$1" = -x ] && exit 1; cp {tmp_path}/made.pdf "$2"'))
    assert programs.tiff(file(b"II*")).fragments
    monkeypatch.setenv("UNRAR_BIN", tool(tmp_path, "unrar", 'mkdir "$5/d"; echo in > "$5/d/a.txt"; ln -s /etc/passwd "$5/link"'))
    assert [(c.name, c.content) for c in programs.rar(file(b"Rar")).everything().children] == [("a.txt", b"in\n")]
    monkeypatch.setenv("7Z_BIN", tool(tmp_path, "7z", 'echo "Wrong password" >&2; exit 2'))
    with pytest.raises(Failed) as failed:
        programs.seven_zip(file(b"7z")).everything()
    assert str(failed.value) == ENCRYPTED
    monkeypatch.setenv("MEDIAINFO_BIN", tool(tmp_path, "mediainfo", """echo '{"media": {"track": [{"Title": "Song", "Encoded_Date": "UTC 2020-01-02 03:04:05", "Duration": "1.5"}]}}'"""))
    assert programs.media("Audio")(file(b"x")).props == {"title": ["Song"], "authoredAt": ["2020-01-02T03:04:05"], "duration": ["1.5"]}
    monkeypatch.setenv("MDB_TABLES_BIN", tool(tmp_path, "mdb-tables", "echo Authors Books"))
    monkeypatch.setenv("MDB_EXPORT_BIN", tool(tmp_path, "mdb-export", 'echo "id,name"; echo "1,Ann"'))
    assert [f[3]["columns"] for f in programs.access(file(b"x")).fragments if "columns" in f[3]] == [['["id", "name"]']] * 2
    slow = tool(tmp_path, "slow", "sleep 5")
    monkeypatch.setenv("SLOW_BIN", slow)
    with pytest.raises(Failed, match="too long"):
        programs.run("slow", timeout=0.1)


def test_picture_fields():
    fields = [(271, b"Maker\0"), (306, b"2020:01:02 03:04:05\0")]
    texts, at = b"", 8 + 2 + 12 * len(fields) + 4
    entries = b""
    for tag, text in fields:
        entries += struct.pack("<HHII", tag, 2, len(text), at + len(texts))
        texts += text
    raw = b"\xff\xd8\xff\xe1..Exif\0\0II*\0" + struct.pack("<IH", 8, len(fields)) + entries + bytes(4) + texts
    assert programs.image(file(raw)).props == {"generator": ["Maker"], "modifiedAt": ["2020-01-02T03:04:05"]}
    assert programs.exif_fields(b"\x89PNG") == {} and programs.exif_fields(b"II*\0\xff\xff\xff\xff") == {}


def test_registered_formats(spark):
    kinds, bids, known = list(EXTRACTORS), list(FAMILY_BIDS), dict(EXTRACT)
    try:
        def reversed_text(f):
            out = Result("PlainText")
            out.add("bodyText", f.content.decode()[::-1])
            return out

        register(Extractor("mirror", 30, ("text/x-mirror",), ("mir",)), reversed_text, ("mirror/", 5))
        rows = [("1", "Document", "a.mir", None, b"abc", None, []), ("2", "Document", "b", "mirror/any", b"xyz", None, [])]
        files = spark.createDataFrame(rows, "entity_id string, schema string, file_name string, mime string, content binary, parent string, ancestors array<string>")
        assert {(r.entity_id, r.props["bodyText"][0]) for r in ingest_files(files).fragments.collect()} == {("1", "cba"), ("2", "zyx")}
    finally:
        EXTRACTORS[:], FAMILY_BIDS[:] = kinds, bids
        EXTRACT.clear()
        EXTRACT.update(known)


def test_an_archive_within_itself_ends(spark):
    raw = M.zipped([("a.txt", "x")])
    name = "self.zip"
    files = M.as_files(spark.createDataFrame([(name, raw)], "file_name string, content binary"))
    own = files.select("entity_id").first()[0]
    inside = files.withColumn("parent", F.lit(own)).withColumn("ancestors", F.array(F.lit(own)))
    assert merge(ingest_files(inside).fragments).count() == 2


def test_nfkd(spark):
    assert spark.createDataFrame([(" ﬁn\u00e9 ",), (None,)], "t string").select(T.nfkd(F.col("t"))).collect()[0][0] == "fine\u0301"


def test_language_table_equals_the_profiles():
    known = {"en": {"the": -1.0, " th": -2.0}, "de": {"der": -1.5}}
    best, share = language.detect("The der", known)
    fit = {"en": -1 - 2 + 5 * language.FLOOR, "de": -1.5 + 6 * language.FLOOR}
    assert best == "en" and share == pytest.approx(1 / (1 + 2.718281828459045 ** (fit["de"] - fit["en"])))


def test_cache_by_kind(spark, tmp_path):
    path = str(tmp_path / "cache")
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string")
    cache_results(rows, path, "ocr-1")
    cache_results(rows, path, "ocr-1")
    cache_results(rows, path, "pdf")
    assert spark.read.parquet(path).count() == 4
    assert cache_clear(spark, path, "ocr") == ["ocr-1"] and spark.read.parquet(path).count() == 2 and cache_clear(spark, str(tmp_path / "none")) == []


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("write to ann@example.org")
    arg = lambda name: str(tmp_path / name)
    assert main(["ingest", arg("in"), arg("fragments")], spark) == main(["analyze", arg("fragments"), arg("out")], spark) == 0
    assert [r.value for r in spark.read.parquet(arg("out/tags")).collect()] == ["ann@example.org"]
    main(["process", arg("in"), arg("live"), arg("positions"), "--once"], spark)
    assert [r.value for r in spark.read.parquet(arg("live/tags")).collect()] == ["ann@example.org"] and os.path.exists(arg("positions"))
    main(["cancel", arg("positions")], spark)
    main(["debug", arg("in")], spark)
    assert not os.path.exists(arg("positions")) and "a.txt" in capsys.readouterr().out


def test_files_share_batches_of_rows():
    rows = [{"entity_id": str(k), "schema": "Document", "file_name": f"{k}.txt", "mime": None, "content": b"x" * 10, "parent": None, "ancestors": [], "extractor": "plain"} for k in range(50)]
    batches = list(extracting(dict(EXTRACT))([pa.RecordBatch.from_pylist(rows)]))
    assert [b.num_rows for b in batches] == [50]
    large = [r | {"content": b"x" * (4 << 20)} for r in rows[:9]]
    assert [b.num_rows for b in extracting(dict(EXTRACT))([pa.RecordBatch.from_pylist(large)])] == [4, 4, 1]


def test_rows_of_a_small_table_go_to_many_tasks(spark):
    made = M.made(spark.range(100).coalesce(1).selectExpr("cast(id as string) as key", "id"), M.signed_of)
    assert made.rdd.getNumPartitions() >= 16 and made.count() == 100


def test_a_header_is_parsed_once(monkeypatch):
    seen = []
    real = mail.DEFAULT.header_factory
    monkeypatch.setattr(mail, "DEFAULT", mail.EmailPolicy(header_factory=lambda name, value: seen.append(name) or real(name, value)))
    mail.parsed_header.cache_clear()
    raw = M.addressed_of({"id": 1, "name": "Ann Smith", "segment": "x"})
    assert mail.rfc822(file(raw)).props["from"] == mail.rfc822(file(raw)).props["from"] == ["c1@example.org"]
    mail.parsed_header.cache_clear()
    assert seen and len(seen) == len(set(seen))


def test_files_do_not_grow_with_their_table(spark, tmp_path):
    spark.range(2000).selectExpr("id as doc_id", "'t' as text", "'en' as lang", "'web' as source").write.parquet(str(tmp_path / "documents.parquet"))
    files = formats.texts_by(spark, str(tmp_path), "lang", "source").selectExpr("split_part(key, '.', 1) as by", "size(rows) as n").collect()
    assert sum(r.n for r in files) == 2000 and max(r.n for r in files) == 250 and {r.by for r in files} == {"en"}
    assert b"ORGANIZER;CN=O:mailto:u7@example.org" in M.ics_of({"key": "7.12", "rows": [{"id": 120_001, "kind": "view"}]})


def test_texts_of_tags_are_one_chunk_each(spark, tmp_path):
    spark.range(1500).selectExpr("id as c_custkey", "1 as c_nationkey", "concat('Customer#', lpad(id, 9, '0')) as c_name").write.parquet(str(tmp_path / "customer.parquet"))
    assert [(r.value, r.prop) for r in QUERIES["streamed_tags"](spark, str(tmp_path)).collect()] == [("c1@example.org", "emailMentioned")]


def test_sheets_are_read_row_by_row(monkeypatch):
    """The tree of a workbook's rows is never whole."""
    rows = [{"id": k, "name": f"n{k}", "segment": "s"} for k in range(200)]
    book = M.ods_of({"key": "R", "sheets": [{"title": t, "rows": rows} for t in ("a", "b")]})
    excel = M.xlsx_of({"key": "R", "author": "A", "customers": rows, "suppliers": rows})
    parsed = []
    real = tables.parse_xml
    monkeypatch.setattr(tables, "parse_xml", lambda raw: parsed.append(len(raw)) or real(raw))
    found = [[(f[3]["title"], f[3]["rowCount"]) for f in read(file(raw)).fragments if "rowCount" in f[3]] for read, raw in ((tables.ods, book), (tables.xlsx, excel))]
    assert found == [[(["a"], ["201"]), (["b"], ["201"])], [(["Customers"], ["201"]), (["Suppliers"], ["201"])]] and max(parsed) < 1000


def test_a_table_in_a_cell_is_a_sheet_too():
    cell = lambda x: f"<t:table-cell><x:p>{x}</x:p></t:table-cell>"
    inner = f'<t:table t:name="in"><t:table-row>{cell("c")}</t:table-row></t:table>'
    content = f'<c xmlns:t="urn:t" xmlns:x="urn:x"><t:table t:name="out"><t:table-row>{cell("a")}<t:table-cell>{inner}</t:table-cell></t:table-row></t:table><t:table t:name="next"><t:table-row>{cell("d")}</t:table-row></t:table></c>'
    found = [(f[3]["title"], f[3]["rowCount"]) for f in tables.ods(file(M.zipped([("content.xml", content)]))).fragments if "rowCount" in f[3]]
    assert found == [(["out"], ["3"]), (["in"], ["2"]), (["next"], ["2"])]
