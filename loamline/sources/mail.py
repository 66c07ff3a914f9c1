"""Extractors of messages and of folders of messages."""

from __future__ import annotations

import email
import functools
import io
import mailbox
import os
import re
import tempfile
import zipfile
from collections.abc import Iterator
from email.errors import MessageError
from email.message import EmailMessage
from email.policy import EmailPolicy
from email.utils import getaddresses, parsedate_to_datetime
from html import escape
from xml.etree import ElementTree

from loamline.model import make_id
from loamline.sources.base import Child, Failed, File, Result, decode
from loamline.sources.documents import html_into, identity, parse_xml, timestamp

MESSAGE_ID = re.compile(r"<([^>]*)>")
OPF = "application/xml+opfmessage"
# Which headers become which property; whose addresses have which role; headers shown of an inline message.
HEADERS = {"Subject": "subject", "Content-Type": "mimeType", "Thread-Topic": "threadTopic", "X-Mailer": "generator", "Content-Language": "language", "Keywords": "keywords", "Comments": "summary"}
ROLES = (
    (("Return-Path",), None, None), (("Reply-To",), None, None), (("Sender", "X-Sender"), "emitters", "sender"), (("From", "X-From"), "emitters", "from"),
    (("To", "Resent-To"), "recipients", "to"), (("Cc", "Resent-Cc"), "recipients", "cc"), (("Bcc", "Resent-Bcc"), "recipients", "bcc"),
)
SHOWN = frozenset({"from", "to", "cc", "bcc", "subject", "reply-to", "date"})


def values_of(msg: EmailMessage, *names: str) -> list[str]:
    """All values of the headers; one that can't be parsed is left out."""
    out = []
    for name in names:
        try:
            out += [str(v) for v in msg.get_all(name) or []]
        except (TypeError, IndexError, AttributeError, ValueError):
            continue
    return out


def ids_in(values: list[str]) -> list[str]:
    return [x for v in values for m in MESSAGE_ID.findall(v) if len(x := m.strip()) > 4]


def apply(out: Result, people: list[dict[str, str | None]], who: str | None, label: str | None) -> None:
    for p in people:
        if who:
            out.add(who, p["id"])
        if label:
            out.add(label, p["label"])
        out.add("namesMentioned", p["name"])
        out.add("emailMentioned", p["email"])


def headers_into(out: Result, msg: EmailMessage) -> None:
    """Each header is parsed once, as that takes longer than all else here."""
    known: dict[str, list[str]] = {}
    for name in dict.fromkeys(msg.keys()):
        if name.lower() not in known:
            known[name.lower()] = values_of(msg, name)
            out.add("indexText", *known[name.lower()])
    values = lambda *names: [v for n in names for v in known.get(n.lower(), ())]
    for header, prop in HEADERS.items():
        out.add(prop, *values(header))
    for value in values("Date"):
        try:
            out.add("date", parsedate_to_datetime(value).isoformat())
        except (TypeError, ValueError, IndexError):
            continue
    out.add("messageId", *ids_in(values("Message-ID")))
    out.add("inReplyTo", *(ids_in(values("References"))[-1:] or ids_in(values("In-Reply-To"))[:1]))
    for names, who, label in ROLES:
        apply(out, [identity(out, n, a) for n, a in getaddresses(values(*names))], who, label)


def as_html(text: str) -> str:
    return escape(text).strip().replace("\n", "<br>")


def part_text(part: EmailMessage) -> str:
    raw = part.get_payload(decode=True) or b""
    return decode(raw, part.get_content_charset())[0]


def leaves(msg: EmailMessage, siblings: frozenset[str] = frozenset()):
    """(kind, part, siblings) in order: attachment, inline, text/html or text/plain; siblings: types of an alternative's parts."""
    kind, name = msg.get_content_type().lower(), msg.get_filename()
    is_text = kind in ("text/html", "text/plain")
    if msg.is_attachment() or name is not None or not (is_text or msg.is_multipart()):
        yield "attachment", msg, siblings
    elif kind == "message/rfc822":
        yield "inline", msg, siblings
        yield from below(msg)
    elif msg.is_multipart():
        yield from below(msg)
    else:
        yield kind, msg, siblings


def below(msg: EmailMessage):
    parts = msg.get_payload()
    kinds = frozenset(p.get_content_type().lower() for p in parts) if msg.get_content_type().lower() == "multipart/alternative" else frozenset()
    for p in parts:
        yield from leaves(p, kinds)


def message_into(out: Result, msg: EmailMessage) -> None:
    headers_into(out, msg)
    for kind, part, siblings in below(msg) if msg.is_multipart() else leaves(msg):
        if kind == "attachment":
            body = str(part.get_payload(i=0)).encode("utf-8", "replace") if part.is_multipart() else part.get_payload(decode=True)
            if part.get_filename() or body:
                out.children.append(Child(part.get_filename(), body or b"", part.get_content_type().lower()))
        elif kind == "inline":
            shown = "\n".join(f"{k}: {v}" for k, v in part.get_payload(0).items() if k.lower() in SHOWN)
            out.add("bodyText", shown)
            out.add("bodyHtml", as_html(shown))
        elif kind == "text/html":
            text = html_into(out, part_text(part), metadata=False, index=False)
            if "text/plain" not in siblings:
                out.add("bodyText", text)
        else:
            text = part_text(part)
            out.add("bodyText", text)
            if "text/html" not in siblings and text:
                out.add("bodyHtml", as_html(text))


@functools.lru_cache(1024)
def parsed_header(name: str, value: str) -> object:
    return DEFAULT.header_fetch_parse(name, value)


class Remembering(EmailPolicy):
    """The default policy, which parses a header anew each time it is asked for; here those of usual length are remembered."""

    def header_fetch_parse(self, name: str, value: str) -> object:
        return parsed_header(name, value) if type(value) is str and len(value) < 1000 else DEFAULT.header_fetch_parse(name, value)


DEFAULT, REMEMBERING = EmailPolicy(), Remembering()


def parsed(raw: bytes) -> EmailMessage:
    return email.message_from_bytes(raw, policy=REMEMBERING)


def rfc822(file: File) -> Result:
    out = Result("Email")
    try:
        message_into(out, parsed(file.content))
    except (MessageError, ValueError, IndexError, LookupError) as error:
        raise Failed(f"Cannot parse email: {error}") from error
    return out


def emlx(file: File) -> Result:
    """The first line tells the message's length in bytes; behind the message stand data of the program."""
    length, _, rest = file.content.partition(b"\n")
    if not length.strip().isdigit():
        raise Failed("Cannot parse email: no length")
    return rfc822(File(file.entity_id, file.name, rest[: int(length)], file.mime, file.ancestors))


def mbox(file: File) -> Result:

    def messages() -> Iterator[Child]:
        with tempfile.TemporaryDirectory() as folder:  # of this one call
            path = os.path.join(folder, "mbox")
            with open(path, "wb") as f:
                f.write(file.content)
            box = mailbox.mbox(path, create=False)
            for key in box.keys():
                yield Child(None, box.get_bytes(key), "message/rfc822", schema="Email")
            box.close()

    out = Result("Package", stream=messages())
    out.add("mimeType", "application/mbox")
    return out


# Elements of a stored message and what they become.
OPF_PROPS = {"OPFMessageCopySubject": "subject", "OPFMessageCopyThreadTopic": "threadTopic", "OPFMessageCopyPreview": "summary", "OPFMessageCopyMessageID": "messageId", "OPFMessageCopyBody": "bodyText"}
OPF_DATES = {"OPFMessageCopySentTime": "date", "OPFMessageCopyModDate": "modifiedAt"}
OPF_ROLES = {
    "OPFMessageCopySenderAddress": ("emitters", "sender"), "OPFMessageCopyFromAddresses": ("emitters", "from"), "OPFMessageCopyToAddresses": ("recipients", "to"),
    "OPFMessageCopyCCAddresses": ("recipients", "cc"), "OPFMessageCopyBCCAddresses": ("recipients", "bcc"),
}


def opf_message(file: File) -> Result:
    root = parse_xml(file.content)
    found = [root] if root.tag == "email" else root.findall(".//email")
    if len(found) != 1:
        raise Failed("More than one email in file.")
    message, out = found[0], Result("Email")
    fields = {el.tag: el.text for el in message if el.text}
    for tag, prop in OPF_PROPS.items():
        out.add(prop, fields.get(tag))
    for tag, prop in OPF_DATES.items():
        out.add(prop, timestamp(fields.get(tag)))
    for tag, (who, label) in OPF_ROLES.items():
        people = [identity(out, a.get("OPFContactEmailAddressName"), a.get("OPFContactEmailAddressAddress")) for a in message.findall(f"./{tag}/emailAddress")]
        apply(out, people, who, label)
    if fields.get("OPFMessageGetHasHTML") == "1E0" and fields.get("OPFMessageCopyHTMLBody"):
        html_into(out, fields["OPFMessageCopyHTMLBody"], metadata=False)
    return out


def olm(file: File) -> Result:
    """An archive of stored messages: a folder for each part of their paths but one, and the messages with their attachments."""
    out = Result("Package")
    try:
        archive = zipfile.ZipFile(io.BytesIO(file.content))
    except zipfile.BadZipFile as error:
        raise Failed("Invalid OLM file.") from error
    seen: set[str] = set()
    for name in archive.namelist():
        if "message_" not in name or not name.endswith(".xml"):
            continue
        parent, path, above = file.entity_id, file.entity_id, (*file.ancestors, file.entity_id)
        for part in name.split("/")[:-1]:
            path = f"{path}/{part}"
            if part == "com.microsoft.__Messages":
                continue
            folder = make_id(path)
            if folder not in seen:
                seen.add(folder)
                out.emit(folder, "", "Folder", fileName=part, parent=parent, ancestors=list(above))
            parent, above = folder, (*above, folder)
        try:
            raw = archive.read(name)
        except (KeyError, zipfile.BadZipFile, RuntimeError, NotImplementedError):
            continue
        message = make_id(checksum(raw))
        out.children.append(Child(None, raw, OPF, parent, message, above))
        try:
            root = parse_xml(raw)
        except Failed:
            continue
        out.children += attachments(archive, root, message, above)
    return out


def attachments(archive: zipfile.ZipFile, root: ElementTree.Element, message: str, above: tuple[str, ...]) -> list[Child]:
    out = []
    for a in root.iter("messageAttachment"):
        url, name = a.get("OPFAttachmentURL"), a.get("OPFAttachmentName") or a.get("OPFAttachmentContentID")
        if url:
            try:
                raw = archive.read(url)
            except (KeyError, zipfile.BadZipFile, RuntimeError, NotImplementedError):
                raw = b""
            out.append(Child(name, raw, a.get("OPFAttachmentContentType"), message, None, (*above, message)))
    return out


def checksum(raw: bytes) -> str:
    import hashlib

    return hashlib.sha1(raw).hexdigest()
