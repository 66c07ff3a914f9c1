"""What extractors give: an entity's schema and properties, further fragments, and files inside the file."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from loamline.model import make_id

# Messages of failed files.
ENCRYPTED = "The document might be protected with a password. Try removing the password protection and re-uploading the documents."
NOT_SUPPORTED = "Format not supported"
TEXT_TOO_LARGE, XML_TOO_LARGE, JSON_TOO_LARGE = "Text file is too large.", "XML file is too large.", "JSON file is too large."
CANNOT_UNPACK = "Could not unpack the contents of this file."
ESCAPES = "Path escalation"
#: Largest sizes of text, XML and JSON files in bytes.
MAX_TEXT = MAX_XML = 4 << 20
MAX_JSON = 100 << 20

NUMBER = re.compile(r"\s*[+-]?(?:\d+(?:_\d+)*(?:\.(?:\d+(?:_\d+)*)?)?(?:e[+-]?\d+(?:_\d+)*)?|\.\d+(?:_\d+)*(?:e[+-]?\d+(?:_\d+)*)?|inf(?:inity)?|nan)\s*", re.I)
BROKEN = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x84\x86-\x9f\ud800-\udfff￾￿]")


class Failed(Exception):
    """A file that can't be processed; the text is the entity's processingError."""


@dataclass
class File:
    """A file to extract, with the entity that it is."""

    entity_id: str
    name: str | None
    content: bytes
    mime: str | None = None
    ancestors: tuple[str, ...] = ()


@dataclass
class Child:
    """A file found inside another; its entity is made from name and checksum unless ``entity_id`` is given."""

    name: str | None
    content: bytes
    mime: str | None = None
    parent: str | None = None
    entity_id: str | None = None
    ancestors: tuple[str, ...] = ()
    schema: str = "Document"


@dataclass
class Result:
    schema: str | None = None
    props: dict[str, list[str]] = field(default_factory=dict)
    #: Other entities and fragments: (entity id, fragment, schema, properties).
    fragments: list[tuple[str, str, str, dict[str, list[str]]]] = field(default_factory=list)
    children: list[Child] = field(default_factory=list)
    #: What comes out one by one, if a file holds more than fits at once: children, and fragments as above.  It may still fail on the way.
    stream: Iterator[Child | tuple[str, str, str, dict[str, list[str]]]] = field(default_factory=lambda: iter(()))

    def everything(self) -> Result:
        """With what was streamed in its lists."""
        for x in self.stream:
            (self.children if isinstance(x, Child) else self.fragments).append(x)
        return self

    def add(self, prop: str, *values: object) -> None:
        for v in values:
            if v is None:
                continue
            text = clean(v)
            if text:
                held = self.props.setdefault(prop, [])
                if text not in held:
                    held.append(text)

    def emit(self, entity: str, fragment: str, schema: str, **props: object) -> None:
        known = {k: [t for v in (vs if isinstance(vs, (list, tuple)) else [vs]) if v is not None and (t := clean(v))] for k, vs in props.items()}
        self.fragments.append((entity, fragment, schema, {k: v for k, v in known.items() if v}))

    def index(self, entity: str, schema: str, fragment: object, texts: list[object]) -> None:
        """An indexText fragment of the texts that are worth it; none if there are none."""
        kept = [t for x in texts if x is not None and (t := clean(x)) and worth_indexing(t)]
        if kept:
            self.emit(entity, str(fragment), schema, indexText=kept)


Extract = Callable[[File], Result]


def clean(value: object) -> str:
    """Text without control characters and halves of surrogate pairs."""
    return BROKEN.sub("", str(value))


def collapse(text: str | None) -> str | None:
    out = " ".join(text.split()) if text else ""
    return out or None


def worth_indexing(text: str) -> bool:
    return bool(text.strip()) and NUMBER.fullmatch(text) is None


def safe_name(name: str | None, default: str = "attachment") -> str:
    """A file name without path and without characters that file systems refuse."""
    last = re.split(r"[/\\]", name or "")[-1]
    return re.sub(r"[^\w.\- ]+", "_", last).strip(". ")[:200] or default


def inside(path: str) -> bool:
    """Whether a member's path stays below the folder it is unpacked to."""
    depth = 0
    if path.startswith(("/", "\\")) or re.match(r"[A-Za-z]:", path):
        return False
    for part in re.split(r"[/\\]", path):
        depth += -1 if part == ".." else 0 if part in ("", ".") else 1
        if depth < 0:
            return False
    return True


def decode(raw: bytes, declared: str | None = None) -> tuple[str, str]:
    """Text and encoding: the declared one, else a guess, each strictly; else the declared one with replacements."""
    for encoding in [declared] if declared else []:
        try:
            return raw.decode(encoding), encoding.lower()
        except (UnicodeDecodeError, LookupError):
            pass
    guessed = guess_encoding(raw)
    try:
        return raw.decode(guessed), guessed
    except (UnicodeDecodeError, LookupError):
        try:
            return raw.decode(declared or guessed, "replace"), declared or guessed
        except LookupError:
            return raw.decode("utf-8", "replace"), "utf-8"


def guess_encoding(raw: bytes) -> str:
    """By byte order mark, then UTF-8 if it is valid, then zeros of UTF-16, else windows-1252 or latin-1."""
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe\x00\x00", "utf-32"), (b"\x00\x00\xfe\xff", "utf-32"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if raw.startswith(mark):
            return name
    head = raw[:4096]
    if len(head) >= 4 and head[1::2].count(0) > len(head) // 4:
        return "utf-16-le"
    if len(head) >= 4 and head[::2].count(0) > len(head) // 4:
        return "utf-16-be"
    for name in ("utf-8", "windows-1252"):
        try:
            raw.decode(name)
        except UnicodeDecodeError:
            continue
        return name
    return "iso-8859-1"


def fragment_id(*parts: object) -> str:
    return make_id(*parts) or ""
