"""The extractors that bid for a file: their media types, file extensions and scores.

Order counts: of equal bids the first wins.  Some formats need a program that is not part of this package; without it such a file becomes a
failed entity, never an exception.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Extractor:
    name: str
    score: int
    mimes: tuple[str, ...]
    extensions: tuple[str, ...]


def _(name: str, score: int, mimes: str = "", extensions: str = "") -> Extractor:
    return Extractor(name, score, tuple(mimes.split()), tuple(extensions.split()))


# Media types, file extensions and scores of each extractor, in order of registration.
EXTRACTORS = [
    _("ignore", 2,
      "application/x-pkcs7-mime application/pkcs7-mime application/pkcs7-signature application/x-pkcs7-signature application/x-pkcs12 application/pgp-encrypted"
      " application/x-shockwave-flash application/vnd.apple.pkpass application/x-executable application/x-mach-binary application/x-sharedlib application/x-dosexec"
      " application/x-java-keystore application/java-archive application/font-sfnt application/vnd.ms-office.vbaproject application/x-x509-ca-cert text/calendar text/css"
      " application/vnd.ms-opentype application/x-font-ttf",
      "json exe dll ini class jar psd indd sql dat log pbl p7m plist ics axd"),
    _("html", 6, "text/html", "htm html xhtml"),
    _("xml", 1, "text/xml", "xml"),
    _("plain", 1,
      "text/plain text/x-c text/x-c++ text/x-diff text/x-python text/x-shellscript text/x-java text/x-php text/troff text/x-ruby text/x-pascal text/x-msdos-batch text/x-yaml"
      " text/x-makefile text/x-perl text/x-objective-c text/x-asm text/x-csrc text/x-sh text/javascript text/x-algol68",
      "txt md rst nfo"),
    _("office", 6,
      "text/richtext text/rtf application/rtf application/x-rtf application/msword application/vnd.ms-word application/wordperfect application/vnd.wordperfect"
      " application/vnd.ms-powerpoint application/vnd.sun.xml.impress application/vnd.ms-powerpoint.presentation application/vnd.ms-powerpoint.presentation.12"
      " application/CDFV2-unknown application/CDFV2-corrupt application/clarisworks application/epub+zip application/macwriteii application/prs.plucker application/vnd.corel-draw"
      " application/vnd.lotus-wordpro application/vnd.ms-powerpoint.presentation.macroEnabled.main+xml application/vnd.ms-works application/vnd.palm application/vnd.sun.xml.draw"
      " application/vnd.sun.xml.draw.template application/vnd.sun.xml.impress.template application/vnd.sun.xml.writer application/vnd.sun.xml.writer.global"
      " application/vnd.sun.xml.writer.template application/vnd.sun.xml.writer.web application/vnd.visio application/x-abiword application/x-aportisdoc application/x-fictionbook+xml"
      " application/x-hwp application/x-iwork-keynote-sffkey application/x-iwork-pages-sffpages application/x-mspublisher application/x-mswrite application/x-pagemaker"
      " application/x-sony-bbeb application/x-t602 image/x-cmx image/x-freehand image/x-wpg",
      "602 abw cdr cmx cwk doc dot dps dpt epub fb2 fh fh1 fh10 fh11 fh2 fh3 fh4 fh5 fh6 fh7 fh8 fh9 fodg fodp fodt hwp key lrf lwp mcw mw mwd nxd odg odm otg oth otm otp ott p65 pages"
      " pdb pm pm6 pmd pot pps ppt pub qxd qxt rtf sda sdd sdw std sti stw sxd sxg sxi sxw vdx vsd vsdm vsdx wn wpd wpg wps wpt wri xlc xlm xls xlw zabw zmf"),
    _("opendoc", 7,
      "application/vnd.oasis.opendocument.text application/vnd.oasis.opendocument.text-template application/vnd.oasis.opendocument.presentation"
      " application/vnd.oasis.opendocument.graphics application/vnd.oasis.opendocument.graphics-flat-xml application/vnd.oasis.opendocument.graphics-template"
      " application/vnd.oasis.opendocument.presentation-flat-xml application/vnd.oasis.opendocument.presentation-template application/vnd.oasis.opendocument.chart"
      " application/vnd.oasis.opendocument.chart-template application/vnd.oasis.opendocument.image application/vnd.oasis.opendocument.image-template"
      " application/vnd.oasis.opendocument.formula application/vnd.oasis.opendocument.formula-template application/vnd.oasis.opendocument.text-flat-xml"
      " application/vnd.oasis.opendocument.text-master application/vnd.oasis.opendocument.text-web",
      "odt odp otp"),
    _("ooxml", 7,
      "application/vnd.openxmlformats-officedocument.wordprocessingml.document application/vnd.openxmlformats-officedocument.wordprocessingml.template"
      " application/vnd.openxmlformats-officedocument.presentationml.slideshow application/vnd.openxmlformats-officedocument.presentationml.presentation"
      " application/vnd.openxmlformats-officedocument.presentationml.template",
      "docx docm dotx dotm potx pptx ppsx pptm ppsm potm"),
    _("djvu", 3, "image/vnd.djvu image/x.djvu image/x-djvu image/djvu"),
    _("pdf", 6, "application/pdf", "pdf"),
    _("rar", 4, "application/rar application/x-rar", "rar"),
    _("zip", 3, "application/zip application/x-zip multipart/x-zip application/zip-compressed application/x-zip-compressed", "zip"),
    _("tar", 4, "application/tar application/x-tar application/x-tgz application/x-gtar", "tar"),
    _("7z", 4, "application/x-7z-compressed application/7z-compressed", "7z 7zip"),
    _("gz", 2, "application/gzip application/x-gzip multipart/x-gzip", "gz tgz"),
    _("bz2", 2, "application/x-bzip application/x-bzip2 multipart/x-bzip multipart/x-bzip2", "bz tbz bz2 tbz2"),
    _("pst", 3, "application/vnd.ms-outlook", "pst ost pab"),
    _("olm", 10, "", "olm"),
    _("opfmsg", 15, "application/xml+opfmessage"),
    _("olemsg", 10, "application/msg application/x-msg application/vnd.ms-outlook msg/rfc822", "msg"),
    _("msg", 7, "multipart/mixed message/rfc822", "eml rfc822 email msg"),
    _("emlx", 8, "", "emlx"),
    _("vcard", 10, "text/vcard text/x-vcard", "vcf vcard"),
    _("calendar", 10, "text/calendar", "ics ical icalendar ifb"),
    _("csv", 7, "text/csv text/tsv text/tab-separated-values", "csv tsv"),
    _("access", 8, "application/msaccess application/x-msaccess application/vnd.msaccess application/vnd.ms-access application/mdb application/x-mdb", "mdb"),
    _("sqlite", 8, "application/x-sqlite3 application/x-sqlite application/sqlite3 application/sqlite", "sqlite3 sqlite db"),
    _("xls", 7, "application/excel application/x-excel application/vnd.ms-excel application/x-msexcel", "xls xlt xla"),
    _("xlsx", 7,
      "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet application/vnd.openxmlformats-officedocument.spreadsheetml.template"
      " application/vnd.ms-excel.sheet.macroenabled.12 application/vnd.ms-excel.sheet.binary.macroenabled.12 application/vnd.ms-excel.template.macroenabled.12"
      " application/vnd.ms-excel.sheet.macroEnabled.main+xml",
      "xlsx xlsm xltx xltm"),
    _("ods", 7, "application/vnd.oasis.opendocument.spreadsheet application/vnd.oasis.opendocument.spreadsheet-template", "ods ots"),
    _("mbox", 6, "application/mbox", "mbox"),
    _("dbf", 3, "application/dbase application/x-dbase application/dbf application/x-dbf", "dbf"),
    _("image", 10,
      "image/x-portable-graymap image/png image/x-png image/jpeg image/jpg image/gif image/pjpeg image/bmp image/x-windows-bmp image/x-portable-bitmap image/x-coreldraw"
      " application/postscript image/vnd.dxf",
      "jpg jpe jpeg png gif bmp"),
    _("tiff", 11, "image/tiff image/x-tiff", "tif tiff"),
    _("svg", 20, "image/svg+xml", "svg"),
    _("audio", 3,
      "audio/mpeg audio/mp3 audio/x-m4a audio/x-hx-aac-adts audio/x-wav audio/mp4 audio/ogg audio/vnd.wav audio/flac audio/x-ms-wma audio/webm",
      "wav mp3 aac ac3 m4a m4b ogg opus flac wma"),
    _("video", 3, "application/x-shockwave-flash video/quicktime video/mp4 video/x-flv", "avi mpg mpeg mkv mp4 mov"),
    _("json", 3, "application/json text/javascript", "json"),
]
# What an extractor bids for any other file of a family of media types.
FAMILY_BIDS = [("image", "image/", 9), ("audio", "audio/", 6), ("video", "video/", 6)]


def add(extractor: Extractor, family: tuple[str, int] | None = None) -> None:
    """Registers an extractor behind the others, or in the place of one of its name."""
    known = [k for k, e in enumerate(EXTRACTORS) if e.name == extractor.name]
    EXTRACTORS[known[0] if known else len(EXTRACTORS) : known[0] + 1 if known else len(EXTRACTORS)] = [extractor]
    if family is not None:
        FAMILY_BIDS[:] = [f for f in FAMILY_BIDS if f[0] != extractor.name] + [(extractor.name, *family)]


def offers(spark: SparkSession, kind: str) -> DataFrame:
    """(key, offers): what extractors bid by media type (``mime``) or file extension (``ext``), a few hundred rows that are part of the plan."""
    by_key: dict[str, list[str]] = {}
    for k, e in enumerate(EXTRACTORS):
        for key in (m.lower() for m in e.mimes) if kind == "mime" else e.extensions:
            by_key.setdefault(key, []).append(f"named_struct('extractor', '{_quoted(e.name)}', 'score', {e.score}, 'ordinal', {k})")
    rows = ", ".join(f"('{_quoted(key)}', array({', '.join(bids)}))" for key, bids in by_key.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(key, offers)")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
