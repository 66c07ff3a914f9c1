"""Compound files: their streams, the metadata of office files, Outlook messages, and workbooks of the older Excel."""

from __future__ import annotations

import datetime
import re
import struct
from collections.abc import Iterator

from loamline.sources.base import ENCRYPTED, Child, Failed, File, Result
from loamline.sources.documents import html_into, identity
from loamline.sources.tables import SHEET_PROPS, sheet_into

MAGIC = bytes.fromhex("D0CF11E0A1B11AE1")
LAST = 0xFFFFFFFA  # sector numbers from here on are marks


class Container:
    """Streams of a compound file by path."""

    def __init__(self, raw: bytes):
        if not raw.startswith(MAGIC) or len(raw) < 512:
            raise Failed("Not a compound file.")
        self.raw = raw
        self.size, mini = 1 << struct.unpack_from("<H", raw, 30)[0], 1 << struct.unpack_from("<H", raw, 32)[0]
        first_dir, = struct.unpack_from("<I", raw, 48)
        cutoff, first_mini, _, first_difat, n_difat = struct.unpack_from("<5I", raw, 56)
        sectors = [s for s in struct.unpack_from("<109I", raw, 76) if s < LAST]
        while first_difat < LAST and n_difat:
            more = self.numbers(first_difat)
            sectors += [s for s in more[:-1] if s < LAST]
            first_difat, n_difat = more[-1], n_difat - 1
        self.next = [x for s in sectors for x in self.numbers(s)]
        entries = self.chain(first_dir)
        mini_next = struct.unpack(f"<{len(m) // 4}I", m) if (m := self.chain(first_mini)) else ()
        self.streams: dict[str, bytes] = {}
        self.nodes = []
        for at in range(0, len(entries) - 127, 128):
            e = entries[at : at + 128]
            name = e[: max(0, struct.unpack_from("<H", e, 64)[0] - 2)].decode("utf-16-le", "replace")
            left, right, child = struct.unpack_from("<3I", e, 68)
            start, length = struct.unpack_from("<IQ", e, 116)
            self.nodes.append((name, e[66], left, right, child, start, length & 0xFFFFFFFF))
        if not self.nodes:
            raise Failed("Not a compound file.")
        small = self.chain(self.nodes[0][5])[: self.nodes[0][6]]
        todo, seen = [(self.nodes[0][4], "")], set()
        while todo:
            k, above = todo.pop()
            if k >= len(self.nodes) or k in seen:
                continue
            seen.add(k)
            name, kind, left, right, child, start, length = self.nodes[k]
            todo += [(left, above), (right, above)]
            if kind == 1:
                todo.append((child, f"{above}{name}/"))
            elif length >= cutoff:
                self.streams[above + name] = self.chain(start)[:length]
            else:
                out, s, steps = [], start, 0
                while s < LAST and s < len(mini_next) and steps <= len(mini_next):
                    out.append(small[s * mini : (s + 1) * mini])
                    s, steps = mini_next[s], steps + 1
                self.streams[above + name] = b"".join(out)[:length]

    def numbers(self, sector: int) -> tuple[int, ...]:
        raw = self.raw[(sector + 1) * self.size : (sector + 2) * self.size]
        return struct.unpack(f"<{len(raw) // 4}I", raw[: len(raw) // 4 * 4]) or (LAST,)

    def chain(self, sector: int) -> bytes:
        out, steps = [], 0
        while sector < LAST and sector < len(self.next) and steps <= len(self.next):
            out.append(self.raw[(sector + 1) * self.size : (sector + 2) * self.size])
            sector, steps = self.next[sector], steps + 1
        return b"".join(out)


def file_time(value: int) -> str | None:
    """Tenths of microseconds since 1601."""
    try:
        return (datetime.datetime(1601, 1, 1) + datetime.timedelta(microseconds=value // 10)).replace(microsecond=0).isoformat() if value else None
    except OverflowError:
        return None


def property_set(raw: bytes) -> dict[int, object]:
    """Numbered values of a property set's first section; texts by its code page."""
    try:
        at, = struct.unpack_from("<I", raw, 44)
        places = [struct.unpack_from("<II", raw, at + 8 + 8 * k) for k in range(struct.unpack_from("<I", raw, at + 4)[0])]
        out: dict[int, object] = {}
        codec = "cp1252"
        for number, place in sorted(places):
            kind, = struct.unpack_from("<I", raw, at + place)
            body = at + place + 4
            if kind == 2:
                out[number] = struct.unpack_from("<H", raw, body)[0]
                if number == 1:
                    codec = {65001: "utf-8", 1200: "utf-16-le", 10000: "mac_roman"}.get(out[1], f"cp{out[1]}")
            elif kind == 30:
                text = raw[body + 4 : body + 4 + struct.unpack_from("<I", raw, body)[0]]
                try:
                    out[number] = text.decode(codec, "replace").rstrip("\0")
                except LookupError:
                    out[number] = text.decode("cp1252", "replace").rstrip("\0")
            elif kind == 31:
                out[number] = raw[body + 4 : body + 4 + 2 * struct.unpack_from("<I", raw, body)[0]].decode("utf-16-le", "replace").rstrip("\0")
            elif kind == 64:
                out[number] = file_time(struct.unpack_from("<Q", raw, body)[0])
        return out
    except struct.error:
        return {}


# Numbers of properties in an office file's summary, and what they become.
SUMMARY = {2: "title", 4: "author", 8: "author", 6: "summary", 18: "generator", 12: "authoredAt", 13: "modifiedAt"}


def metadata_into(out: Result, container: Container) -> None:
    found = property_set(container.streams.get("\x05SummaryInformation", b""))
    for number, prop in SUMMARY.items():
        out.add(prop, found.get(number))
    more = property_set(container.streams.get("\x05DocumentSummaryInformation", b""))
    out.add("author", more.get(15))


# Outlook messages

#: What compressed rich text may refer to before its own first character.
RTF_START = (
    rb"{\rtf1\ansi\mac\deff0\deftab720{\fonttbl;}{\f0\fnil \froman \fswiss \fmodern \fscript \fdecor MS Sans SerifSymbolArialTimes New RomanCourier{\colortbl\red0\green0\blue0" b"\r\n" rb"\par \pard\plain\f0\fs20\b\i\u\tab\tx"
)


def rich_text(raw: bytes) -> bytes:
    """A message's compressed rich text."""
    if len(raw) < 16:
        return b""
    _, length, kind = struct.unpack_from("<III", raw, 0)
    if kind != 0x75465A4C:
        return raw[16 : 16 + length]
    held, out, at = bytearray(RTF_START.ljust(4096, b"\0")), bytearray(), 16
    place = len(RTF_START)
    while at < len(raw) and len(out) < length:
        flags, at = raw[at], at + 1
        for bit in range(8):
            if at >= len(raw) or len(out) >= length:
                break
            if flags >> bit & 1:
                if at + 1 >= len(raw):
                    break
                pair, at = raw[at] << 8 | raw[at + 1], at + 2
                start, n = pair >> 4, (pair & 15) + 2
                if start == place:
                    return bytes(out)
                taken = [start + k for k in range(n)]
            else:
                taken, start = [None], at
                at += 1
            for k in taken:
                c = raw[start] if k is None else held[k % 4096]
                out.append(c)
                held[place] = c
                place = (place + 1) % 4096
    return bytes(out[:length])


# Numbers of a message's fields.
SUBJECT, BODY, HTML, RTF, HEADERS, MESSAGE_ID, REPLY_TO, TOPIC = "0037", "1000", "1013", "1009", "007D", "1035", "1042", "0070"
SENDER, RECEIVED_BY, REPRESENTING = ("0C1A", ("5D01", "0C1F")), ("0040", ("5D07", "0076")), ("0042", ("5D02", "0065"))
NAME, ADDRESSES, FILE_NAMES, DATA, MIME, KIND = "3001", ("39FE", "3003"), ("3707", "3704"), "3701", "370E", 0x0C15
SENT, DELIVERED, CHANGED = 0x0039, 0x0E06, 0x3008


class Part:
    """Fields of a message, a recipient or an attachment: the streams below a storage."""

    def __init__(self, streams: dict[str, bytes], prefix: str):
        self.streams, self.prefix = streams, prefix

    def raw(self, number: str) -> bytes | None:
        return next((v for t in ("001F", "001E", "0102") if (v := self.streams.get(f"{self.prefix}__substg1.0_{number}{t}")) is not None), None)

    def text(self, *numbers: str) -> str | None:
        for n in numbers:
            for kind, codec in (("001F", "utf-16-le"), ("001E", "cp1252")):
                v = self.streams.get(f"{self.prefix}__substg1.0_{n}{kind}")
                if v:
                    return v.decode(codec, "replace").rstrip("\0")
        return None

    def fixed(self, number: int, head: int) -> int | None:
        raw = self.streams.get(f"{self.prefix}__properties_version1.0", b"")
        for at in range(head, len(raw) - 15, 16):
            if struct.unpack_from("<H", raw, at + 2)[0] == number:
                return struct.unpack_from("<Q", raw, at + 8)[0]
        return None

    def storages(self, kind: str) -> list[str]:
        found = {m[0] for k in self.streams if (m := re.match(re.escape(f"{self.prefix}{kind}") + r"[^/]*/", k))}
        return sorted(found)


def outlook_message(file: File) -> Result:
    out = Result("Email")
    outlook_into(out, file, Container(file.content).streams, "")
    return out


def outlook_into(out: Result, file: File, streams: dict[str, bytes], prefix: str) -> None:
    from loamline.sources import mail  # noqa: PLC0415  mail knows messages of all other kinds

    part = Part(streams, prefix)
    head = 32 if not prefix else 24
    headers = part.text(HEADERS)
    if headers:
        mail.headers_into(out, mail.parsed((headers.strip() + "\n\n").encode("utf-8", "replace")))
    out.add("subject", part.text(SUBJECT))
    out.add("threadTopic", part.text(TOPIC))
    out.add("messageId", *mail.ids_in([part.text(MESSAGE_ID) or ""]))
    out.add("inReplyTo", *mail.ids_in([part.text(REPLY_TO) or ""])[:1])
    out.add("bodyText", part.text(BODY))
    html = part.raw(HTML)
    if html:
        from loamline.sources.base import decode

        html_into(out, part.text(HTML) or decode(html)[0], metadata=False, index=False)
    if sent := part.fixed(SENT, head) or part.fixed(DELIVERED, head):
        out.add("date", file_time(sent))
    if changed := part.fixed(CHANGED, head):
        out.add("modifiedAt", file_time(changed))
    for (name, addresses), who, label in ((SENDER, "emitters", "sender"), (REPRESENTING, "emitters", "from"), (RECEIVED_BY, "recipients", None)):
        if part.text(name) or part.text(*addresses):
            mail.apply(out, [identity(out, part.text(name), part.text(*addresses))], who, label)
    for storage in part.storages("__recip_version1.0_"):
        one = Part(streams, storage)
        label = {1: "to", 2: "cc", 3: "bcc"}.get((one.fixed(KIND, 8) or 1) & 0xFFFFFFFF, "to")
        mail.apply(out, [identity(out, one.text(NAME), one.text(*ADDRESSES))], "recipients", label)
    if packed := part.raw(RTF):
        text = rich_text(packed)
        if text:
            out.children.append(Child("body.rtf", text, "application/rtf"))
    for storage in part.storages("__attach_version1.0_"):
        one = Part(streams, storage)
        inner = f"{storage}__substg1.0_{DATA}000D/"
        if any(k.startswith(inner) for k in streams):
            nested = Result("Email")
            outlook_into(nested, file, streams, inner)
            out.add("bodyText", *nested.props.get("subject", []), *nested.props.get("bodyText", []))
            out.children += nested.children
            out.fragments += nested.fragments
        elif (raw := one.raw(DATA)) is not None and (raw or one.text(*FILE_NAMES)):
            out.children.append(Child(one.text(*FILE_NAMES), raw, one.text(MIME)))


# Workbooks

#: Kinds of records.
(BOF, EOF_, SHEET, STRINGS, MORE, TEXT_AT, NUMBER, SHORT, SHORTS, LABEL, BOOLEAN, FORMULA, RESULT, FORMAT, STYLE, ENCRYPTION, DATE_MODE) = (
    0x809, 0x0A, 0x85, 0xFC, 0x3C, 0xFD, 0x203, 0x27E, 0xBD, 0x204, 0x205, 0x06, 0x207, 0x41E, 0xE0, 0x2F, 0x22,
)


def records(raw: bytes, at: int = 0) -> Iterator[tuple[int, bytes]]:
    while at + 4 <= len(raw):
        kind, size = struct.unpack_from("<HH", raw, at)
        yield kind, raw[at + 4 : at + 4 + size]
        at += 4 + size


def shared_strings(parts: list[bytes]) -> list[str]:
    """The texts of a string table, which may go on in further records, in the middle of a text too."""
    out, part, at = [], 0, 8

    def step(n: int) -> bytes:
        nonlocal part, at
        got = b""
        while n:
            if at >= len(parts[part]):
                part, at = part + 1, 0
            own = parts[part][at : at + n]
            got, at, n = got + own, at + len(own), n - len(own)
        return got

    try:
        for _ in range(struct.unpack_from("<I", parts[0], 4)[0]):
            count, flags = struct.unpack("<HB", step(3))
            runs = struct.unpack("<H", step(2))[0] if flags & 8 else 0
            more = struct.unpack("<I", step(4))[0] if flags & 4 else 0
            text, wide = "", flags & 1
            while count:
                if at >= len(parts[part]):
                    part, at = part + 1, 1
                    wide = parts[part][0] & 1
                n = min(count, (len(parts[part]) - at) // (2 if wide else 1))
                text += step(n * 2).decode("utf-16-le", "replace") if wide else step(n).decode("latin-1")
                count -= n
            step(4 * runs + more)
            out.append(text)
    except (IndexError, struct.error):
        pass
    return out


def short_number(value: int) -> float:
    number = float(value >> 2 if value < 1 << 31 else (value >> 2) - (1 << 30)) if value & 2 else struct.unpack("<d", struct.pack("<Q", (value & 0xFFFFFFFC) << 32))[0]
    return number / 100 if value & 1 else number


class Book:
    """Sheets of a workbook stream."""

    def __init__(self, raw: bytes):
        self.raw, self.sheets, self.strings, self.dates, self.epoch = raw, [], [], [], datetime.datetime(1899, 12, 30)
        formats, styles, table = {}, [], []
        for kind, body in records(raw):
            if kind == ENCRYPTION:
                raise Failed(ENCRYPTED)
            if kind == SHEET:
                at, _, sort, n, flags = struct.unpack_from("<IBBBB", body)
                name = body[8 : 8 + 2 * n].decode("utf-16-le", "replace") if flags & 1 else body[8 : 8 + n].decode("latin-1")
                self.sheets.append((name, at, sort))
            elif kind == STRINGS or (kind == MORE and table):
                table.append(body)
                continue
            elif kind == FORMAT:
                number, n, flags = struct.unpack_from("<HHB", body)
                formats[number] = body[5:].decode("utf-16-le" if flags & 1 else "latin-1", "replace")[:n]
            elif kind == STYLE:
                styles.append(struct.unpack_from("<H", body, 2)[0])
            elif kind == DATE_MODE and body[:1] == b"\x01":
                self.epoch = datetime.datetime(1904, 1, 1)
            elif kind == EOF_:
                break
            if table and not self.strings:
                self.strings, table = shared_strings(table), []
        if table:
            self.strings = shared_strings(table)
        shown = {k for k, f in formats.items() if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.lower()))}
        self.dates = [s in shown or 14 <= s <= 22 or 45 <= s <= 47 for s in styles]

    def shown(self, number: float, style: int) -> str | None:
        if style < len(self.dates) and self.dates[style]:
            if number == 0:
                return None
            moment = self.epoch + datetime.timedelta(seconds=round(number * 86400))
            return moment.time().isoformat() if number < 1 else moment.isoformat()
        return str(number)

    def rows(self, at: int) -> Iterator[list[object]]:
        cells: dict[int, dict[int, object]] = {}
        waiting = None
        for kind, body in records(self.raw, at):
            if kind == EOF_:
                break
            if kind == RESULT and waiting:
                n, flags = struct.unpack_from("<HB", body)
                cells.setdefault(waiting[0], {})[waiting[1]] = body[3:].decode("utf-16-le" if flags & 1 else "latin-1", "replace")[:n]
                waiting = None
                continue
            if kind not in (TEXT_AT, NUMBER, SHORT, SHORTS, LABEL, BOOLEAN, FORMULA):
                continue
            row, column, style = struct.unpack_from("<HHH", body)
            own = cells.setdefault(row, {})
            if kind == TEXT_AT:
                k, = struct.unpack_from("<I", body, 6)
                own[column] = self.strings[k] if k < len(self.strings) else None
            elif kind == NUMBER:
                own[column] = self.shown(struct.unpack_from("<d", body, 6)[0], style)
            elif kind == SHORT:
                own[column] = self.shown(short_number(struct.unpack_from("<I", body, 6)[0]), style)
            elif kind == SHORTS:
                for k in range((len(body) - 6) // 6):
                    style, value = struct.unpack_from("<HI", body, 4 + 6 * k)
                    own[column + k] = self.shown(short_number(value), style)
            elif kind == LABEL:
                n, flags = struct.unpack_from("<HB", body, 6)
                own[column] = body[9:].decode("utf-16-le" if flags & 1 else "latin-1", "replace")[:n]
            elif kind == BOOLEAN and not body[7]:
                own[column] = str(body[6])
            elif kind == FORMULA:
                if body[12:14] == b"\xff\xff":
                    waiting = (row, column) if body[6] == 0 else None
                    if body[6] == 1:
                        own[column] = str(body[8])
                else:
                    own[column] = self.shown(struct.unpack_from("<d", body, 6)[0], style)
        for row in sorted(cells):
            width = max(cells[row], default=-1) + 1
            yield [cells[row].get(c) for c in range(width)]


def xls(file: File) -> Result:
    out = Result("Workbook")
    container = Container(file.content)
    metadata_into(out, container)
    raw = container.streams.get("Workbook")
    if raw is None:
        raise Failed(ENCRYPTED if "EncryptedPackage" in container.streams else "Cannot open document.")
    book = Book(raw)
    for name, at, sort in book.sheets:
        if sort == 0:
            sheet_into(out, file, name, book.rows(at), inherited=SHEET_PROPS)
    return out
