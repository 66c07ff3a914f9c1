"""Extractors on inputs made here, through the whole of ingestion."""

import bz2
import gzip
import io
import sqlite3
import struct
import tarfile
import zipfile

import pytest

from loamline.model import make_id, merge
from loamline.plans.ingest import ingest
from loamline.sources import documents, mail, packages, tables
from loamline.sources.base import ENCRYPTED, Failed, File, decode, inside, worth_indexing

PAGE = """<!DOCTYPE html><html><head><title>A page</title><meta name="description" content="What it  is"><meta name="keywords" content="one, two"><meta name="news_keywords" content="three,two">
<style>p {}</style></head><body><p>Hello <b>web</b>&nbsp;page.</p><script>no()</script>lost tail<p>The <a href="/">end</a>.</p></body></html>"""


def file(content, name="f"):
    return File("id", name, content if isinstance(content, bytes) else content.encode())


def eml(body, kind="text/plain", more=""):
    return f"From: Ann <ann@example.org>\nTo: bob@example.org\nSubject: Hi\nMessage-ID: <first-one@x>\n{more}Content-Type: {kind}\n\n{body}".encode()


def zipped(members):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return raw.getvalue()


def test_html():
    out = documents.html(file(PAGE)).props
    assert out["title"] == ["A page"] and out["summary"] == ["What it is"] and out["keywords"] == ["one", "two", "three"]
    assert out["indexText"] == ["Hello web page. The end ."] and "bodyText" not in out


def test_html_references_end_in_a_semicolon():
    page = documents.read_page('<html lang="a&ampb"><head><title>R&amp;D &amp</title><meta name="author" content="A &lt B &lt; C"></head><body>x &amp;&amp y &unknown; &#38; <!-- &amp z --></body></html>')
    assert (page.titles, page.lang, page.field("author"), page.text()) == (["R&D &amp"], "a&ampb", "A &lt B < C", "x &&amp y &unknown; & &amp z")


def test_html_blank_has_no_text():
    out = documents.html(file("<html><body><pre>\n \n</pre></body></html>")).props
    assert "indexText" not in out and "title" not in out


def test_plain_encodings_and_size():
    assert documents.plain(file("größe".encode("utf-16"))).props["bodyText"] == ["größe"]
    assert documents.plain(file("größe".encode("latin-1"))).props == {"encoding": ["windows-1252"], "bodyText": ["größe"]}
    assert decode(b"\xff\xfe\xff", "ascii")[0]
    with pytest.raises(Failed, match="too large"):
        documents.plain(file(b"x" * (4 << 20) + b"y"))


def test_xml_text_and_table():
    out = documents.xml(file("<a><b>one</b><c><d>two &lt;</d></c></a>")).props
    assert out["bodyText"] == ["one two <"]
    assert out["bodyHtml"] == ["<table><tr><td><p>a</p></td><td><table><tr><td><p>b</p></td><td><p>one</p></td></tr><tr><td><p>c</p></td><td><table><tr><td><p>d</p></td><td><p>two &lt;</p></td></tr></table></td></tr></table></td></tr></table>"]
    with pytest.raises(Failed):
        documents.xml(file('<!DOCTYPE x [<!ENTITY a "b">]><x>&a;</x>'))


def test_json_strings_alone():
    out = documents.json_file(file('{"a": "x", "n": 10, "l": ["y", {"b": "7"}, "z"]}'))
    assert [f[1:] for f in out.fragments] == [("0", "Document", {"indexText": ["x"]}), ("1", "Document", {"indexText": ["y"]}), ("3", "Document", {"indexText": ["z"]})]
    with pytest.raises(Failed):
        documents.json_file(file("{"))


def test_vcard_folded_and_quoted_printable():
    card = "BEGIN:VCARD\r\nVERSION:2.1\r\nN;CHARSET=UTF-8;ENCODING=QUOTED-PRINTABLE:M=C3=BCller;An=\r\nna\r\nFN:Anna\r\n  M\r\nitem1.TEL;type=WORK:+1 781 555 1212\r\nEMAIL:first@x.org\r\nEMAIL:Last@X.org\r\nEND:VCARD\r\nBEGIN:VCARD\r\nFN:No Mail\r\nEND:VCARD\r\n"
    out = documents.vcard(file(card))
    (person, _, schema, props), = out.fragments
    assert schema == "Person" and person == make_id("last@x.org")
    assert props["phone"] == ["+17815551212"] and props["name"] == ["Anna Müller", "Anna M"]


def test_calendar():
    ics = "BEGIN:VCALENDAR\nPRODID:p\nBEGIN:VEVENT\nUID:u1\nSUMMARY:Meet\\, greet\nDTSTART;VALUE=DATE:20200102\nDTEND:20200102T030405Z\nORGANIZER:mailto:o@x.org\nATTENDEE:MAILTO:a@x.org\nATTENDEE;CN=B:mailto:b\n @x.org\nEND:VEVENT\nEND:VCALENDAR\n"
    out = documents.calendar(file(ics))
    schemas = [f[2] for f in out.fragments]
    event = out.fragments[schemas.index("Event")]
    assert schemas.count("Person") == 3 and event[0] == make_id("u1") and out.props["generator"] == ["p"]
    assert event[3]["name"] == ["Meet, greet"] and event[3]["startDate"] == ["2020-01-02"] and event[3]["endDate"] == ["2020-01-02T03:04:05+00:00"] and len(event[3]["involved"]) == 2


def test_mail_alternative_mixed_and_nested():
    part = lambda kind, body: f"Content-Type: {kind}\n\n{body}\n"
    join = lambda b, parts: "".join(f"--{b}\n{p}" for p in parts) + f"--{b}--\n"
    both = [part("text/plain", "Plain"), part("text/html", "<b>Rich</b>")]
    out = mail.rfc822(file(eml(join("x", both), 'multipart/alternative; boundary="x"'))).props
    assert out["bodyText"] == ["Plain"] and out["bodyHtml"] == ["<b>Rich</b>"]
    out = mail.rfc822(file(eml(join("x", both), 'multipart/mixed; boundary="x"'))).props
    assert out["bodyText"] == ["Plain", "Rich"] and out["bodyHtml"] == ["Plain", "<b>Rich</b>"]
    nested = f'Content-Type: multipart/alternative; boundary="y"\n\n{join("y", both)}'
    out = mail.rfc822(file(eml(join("x", [nested, part("text/plain", "After")]), 'multipart/mixed; boundary="x"'))).props
    assert out["bodyText"] == ["Plain", "After"] and out["bodyHtml"] == ["<b>Rich</b>", "After"]


def test_mail_headers_and_attachments():
    more = "References: <a@b.c> <reference-2@x>\nIn-Reply-To: <other@x>\nDate: Thu, 02 Jan 2020 03:04:05 +0000\nX-Mailer: Pigeon\n"
    attached = "--x\nContent-Type: text/plain\n\nIt's <b>\nhere\n--x\nContent-Type: message/rfc822\n\nFrom: c@example.org\nSubject: Inner\nX: no\n\nInner body\n--x\nContent-Type: application/pdf\nContent-Disposition: attachment; filename=a.pdf\n\nPDF\n--x--\n"
    out = mail.rfc822(file(eml(attached, 'multipart/mixed; boundary="x"', more)))
    p = out.props
    assert p["messageId"] == ["first-one@x"] and p["inReplyTo"] == ["reference-2@x"] and p["generator"] == ["Pigeon"] and p["date"] == ["2020-01-02T03:04:05+00:00"]
    assert p["from"] == ["Ann <ann@example.org>"] and p["to"] == ["bob@example.org"] and p["emitters"] == [make_id("ann@example.org")]
    assert p["bodyText"] == ["It's <b>\nhere", "From: c@example.org\nSubject: Inner", "Inner body"] and p["bodyHtml"][0] == "It&#x27;s &lt;b&gt;<br>here"
    assert [(c.name, c.mime) for c in out.children] == [("a.pdf", "application/pdf")]


def test_emlx_and_mbox():
    raw = eml("Body")
    assert mail.emlx(file(str(len(raw)).encode() + b"\n" + raw + b"<plist/>")).props["bodyText"] == ["Body"]
    out = mail.mbox(file(b"From - Thu Jan 2 2020\n" + raw + b"\n\nFrom - Thu Jan 2 2020\n" + raw + b"\n")).everything()
    assert len(out.children) == 2 and out.schema == "Package"


def test_olm():
    message = '<emails><email><OPFMessageCopySubject>S</OPFMessageCopySubject><OPFMessageCopyMessageID>m@x</OPFMessageCopyMessageID><OPFMessageCopySentTime>2020-01-02T03:04:05</OPFMessageCopySentTime><OPFMessageCopyFromAddresses><emailAddress OPFContactEmailAddressName="Ann" OPFContactEmailAddressAddress="a@x.org"/></OPFMessageCopyFromAddresses><OPFMessageCopyAttachmentList><messageAttachment OPFAttachmentURL="att/1" OPFAttachmentName="n.txt"/></OPFMessageCopyAttachmentList></email></emails>'
    out = mail.olm(file(zipped({"Accounts/com.microsoft.__Messages/Inbox/message_1.xml": message, "att/1": "hello", "other.xml": "<x/>"})))
    assert [f[3]["fileName"] for f in out.fragments] == [["Accounts"], ["Inbox"]] and [c.name for c in out.children] == [None, "n.txt"]
    props = mail.opf_message(File("m", None, out.children[0].content)).props
    assert props["subject"] == ["S"] and props["date"] == ["2020-01-02T03:04:05"] and props["from"] == ["Ann <a@x.org>"]


def test_csv_rows_headers_and_hash():
    out = tables.csv_file(file("a,b\n1,\n,\nlong,row,cut\nshort\n"))
    assert out.props["rowCount"] == ["5"] and out.props["columns"] == ['["Column 1", "Column 2"]']
    assert out.props["csvHash"] == tables.csv_file(file("a,b\n1,\nlong,row\nshort\n")).props["csvHash"]
    assert [f[3]["indexText"] for f in out.fragments] == [["a", "b"], ["long", "row"], ["short"]]


def test_sqlite(tmp_path):
    base = sqlite3.connect(tmp_path / "x.db")
    base.executescript('create table "odd name" (a, b); insert into "odd name" values (1, \'x\'), (2, null); create table empty_one (z);')
    base.close()
    out = tables.sqlite(file((tmp_path / "x.db").read_bytes()))
    last = {f[3]["title"][0]: f[3] for f in out.fragments if f[1] == ""}
    assert last["odd name"]["rowCount"] == ["3"] and last["odd name"]["columns"] == ['["a", "b"]'] and "csvHash" not in last["empty_one"]
    with pytest.raises(Failed):
        tables.sqlite(file("no"))


def test_dbf():
    fields = b"NAME".ljust(11, b"\0") + b"C" + bytes(4) + bytes([6]) + bytes(15) + b"DAY".ljust(11, b"\0") + b"D" + bytes(4) + bytes([8]) + bytes(15)
    raw = b"\x03" + bytes(3) + struct.pack("<IHH", 2, 32 + 64 + 1, 15) + bytes(20) + fields + b"\r" + b" Anna  20200102" + b"*Gone  20200102"
    out = tables.dbf(file(raw))
    assert out.props["rowCount"] == ["2"] and out.fragments[0][3]["indexText"] == ["Anna", "2020-01-02"]


def test_xlsx():
    book = '<workbook xmlns:r="urn:r"><sheets><sheet name="One" r:id="rId1"/><sheet name="Chart" r:id="rId2"/></sheets></workbook>'
    rels = '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Target="chartsheets/sheet1.xml"/></Relationships>'
    sheet = '<worksheet><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row><row r="2"><c r="A2" s="1"><v>43832.5</v></c><c r="B2" t="inlineStr"><is><t>in</t></is></c><c r="C2" t="b"><v>1</v></c></row></sheetData></worksheet>'
    styles = '<styleSheet><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    core = '<p xmlns:dc="urn:dc" xmlns:cp="urn:cp" xmlns:t="urn:t"><dc:creator>Ann</dc:creator><cp:lastModifiedBy>Bob</cp:lastModifiedBy><t:created>2020-01-02T03:04:05Z</t:created></p>'
    raw = zipped({"xl/workbook.xml": book, "xl/_rels/workbook.xml.rels": rels, "xl/worksheets/sheet1.xml": sheet, "xl/sharedStrings.xml": "<sst><si><t>Head</t></si></sst>", "xl/styles.xml": styles, "docProps/core.xml": core})
    out = tables.xlsx(file(raw))
    texts = [f[3]["indexText"] for f in out.fragments if "indexText" in f[3]]
    assert texts == [["Head"], ["2020-01-02T12:00:00", "in", "True"]]
    assert out.fragments[0][1] == "initial" and out.fragments[0][3]["author"] == ["Ann", "Bob"] and out.props["authoredAt"] == ["2020-01-02T03:04:05"]
    with pytest.raises(Failed, match="password"):
        tables.xlsx(file(b"\xd0\xcf\x11\xe0"))


def test_ods_and_odt():
    ns = 'xmlns:o="urn:o" xmlns:t="urn:t" xmlns:x="urn:x"'
    sheet = f'<doc {ns}><t:table t:name="S"><t:table-row><t:table-cell o:value-type="currency" o:value="5" o:currency="EUR"/><t:table-cell t:number-columns-repeated="2"><x:p>a</x:p></t:table-cell></t:table-row></t:table></doc>'
    out = tables.ods(file(zipped({"content.xml": sheet, "meta.xml": f'<m xmlns:dc="urn:dc"><dc:creator>Ann</dc:creator></m>'})))
    assert [f[3]["indexText"] for f in out.fragments if "indexText" in f[3]] == [["5 EUR", "a", "a"]] and out.props["author"] == ["Ann"]
    out = tables.opendoc(file(zipped({"content.xml": f"<d {ns}><x:h>Title</x:h><x:p>Text <x:span>more</x:span></x:p></d>"})))
    assert out.fragments[0][3]["bodyText"] == ["Title\nText more"]
    with pytest.raises(Failed, match="password"):
        tables.opendoc(file(zipped({"content.xml": "<d/>", "META-INF/manifest.xml": '<m><encryption-data/></m>'})))


def test_ooxml_pages():
    slide = lambda t: f'<s xmlns:a="urn:a"><a:p><a:r><a:t>{t}</a:t></a:r></a:p></s>'
    out = tables.ooxml(file(zipped({"ppt/slides/slide10.xml": slide("ten"), "ppt/slides/slide2.xml": slide("two")})))
    assert [f[3]["bodyText"] for f in out.fragments if f[2] == "Page"] == [["two"], ["ten"]]


def test_archives_keep_paths_inside():
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w:gz") as t:
        for name, content in (("dir/a.txt", b"A"), ("../escape.txt", b"E"), (".git/config", b"G")):
            item = tarfile.TarInfo(name)
            item.size = len(content)
            t.addfile(item, io.BytesIO(content))
        link = tarfile.TarInfo("link")
        link.type, link.linkname = tarfile.SYMTYPE, "/etc/passwd"
        t.addfile(link)
    for out in (packages.untar(file(raw.getvalue())).everything(), packages.gunzip(file(raw.getvalue(), "x.tgz")).everything()):
        assert [c.name for c in out.children] == ["a.txt"] and [f[3]["fileName"] for f in out.fragments] == [["dir"]]
    assert [(c.name, c.content) for c in packages.gunzip(file(gzip.compress(b"hi"), "x.txt.gz")).everything().children] == [("x.txt", b"hi")]
    assert [(c.name, c.content) for c in packages.bunzip2(file(bz2.compress(b"hi"), "x.bz2")).everything().children] == [("x", b"hi")]
    with pytest.raises(Failed):
        packages.unzip(file("no zip"))
    assert inside("a/../b") and not inside("a/../../b") and not inside("/a") and not inside("C:\\a")


def test_worth_indexing():
    assert [t for t in ("a", " ", "1_000", "12d", "-.5e3", "nan", "Infinity", "1__0", "1 2") if worth_indexing(t)] == ["a", "12d", "1__0", "1 2"]
    assert ENCRYPTED


def test_ingest_to_the_end_of_nesting(spark, tmp_path):
    inner = zipped({"deep/mail.eml": eml("Body")})
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/sub/outer.zip").write_bytes(zipped({"inner.zip": inner, "page.html": PAGE}))
    (tmp_path / "in/empty.txt").write_bytes(b"")
    (tmp_path / "in/a.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "in/odd.bin").write_bytes(b"\x00\x01\x02")
    out = ingest(spark, str(tmp_path / "in"))
    by_name = {r.props["fileName"][0]: r for r in merge(out.fragments).collect() if "fileName" in r.props}
    assert {n: r.schema for n, r in by_name.items()} == {"sub": "Folder", "outer.zip": "Package", "inner.zip": "Package", "page.html": "HyperText", "deep": "Folder", "mail.eml": "Email", "empty.txt": "Document", "a.pdf": "Document", "odd.bin": "Document"}
    assert by_name["a.pdf"].props["processingStatus"] == ["failure"] and by_name["a.pdf"].props["processingError"] == ["No pages in this PDF."]
    assert by_name["odd.bin"].props["processingError"] == ["Format not supported"] and by_name["empty.txt"].props["processingStatus"] == ["success"]
    mail_props, folder = by_name["mail.eml"].props, by_name["deep"]
    assert mail_props["parent"] == [folder.entity_id] and len(mail_props["ancestors"]) == 4 and by_name["sub"].entity_id in mail_props["ancestors"]
    assert {(r.extractor, r.status) for r in out.runs.collect()} == {("zip", "success"), ("html", "success"), ("msg", "success"), ("ignore", "success"), ("pdf", "failure"), (None, "failure")}
