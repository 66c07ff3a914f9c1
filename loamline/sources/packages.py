"""Extractors of archives: their members become children, below the folders that their paths name."""

from __future__ import annotations

import bz2
import gzip
import io
import re
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

from loamline.model import make_id
from loamline.sources.base import CANNOT_UNPACK, ENCRYPTED, Child, Failed, File, Result, clean, inside

# Names that a crawl leaves out.
SKIPPED = frozenset({".git", ".hg", "__MACOSX", ".gitignore"})


def member(file: File, path: str, content: bytes, seen: set[str]) -> Iterator[Child | tuple[str, str, str, dict[str, list[str]]]]:
    """A child for the member, below a Folder for each part of its path."""
    parts = [p for p in re.split(r"[/\\]", path) if p not in ("", ".")]
    if not parts or any(p in SKIPPED for p in parts) or not inside(path):
        return
    parent, above = file.entity_id, (*file.ancestors, file.entity_id)
    for name in parts[:-1]:
        folder = make_id(parent, name)
        if folder not in seen:
            seen.add(folder)
            yield folder, "", "Folder", {"fileName": [clean(name)], "parent": [parent], "ancestors": list(above)}
        parent, above = folder, (*above, folder)
    yield Child(parts[-1], content, None, parent, None, above)


def unzip(file: File) -> Result:
    try:
        archive = zipfile.ZipFile(io.BytesIO(file.content))
    except zipfile.BadZipFile as error:
        raise Failed(CANNOT_UNPACK) from error

    def members() -> Iterator:
        seen: set[str] = set()
        for item in archive.infolist():
            if item.is_dir() or (item.external_attr >> 16) & 0o170000 == 0o120000:  # links are not followed
                continue
            try:
                content = archive.read(item)
            except RuntimeError as error:
                raise Failed(ENCRYPTED) from error
            except (zipfile.BadZipFile, NotImplementedError, zlib.error, EOFError):
                continue  # one bad member does not spoil the rest
            yield from member(file, item.filename, content, seen)

    return Result("Package", stream=members())


def untar(file: File) -> Result:
    def members() -> Iterator:
        seen: set[str] = set()
        try:
            with tarfile.open(fileobj=io.BytesIO(file.content), mode="r:*") as archive:
                for item in archive:
                    if item.isfile():
                        yield from member(file, item.name, archive.extractfile(item).read(), seen)
        except (tarfile.TarError, EOFError, OSError, zlib.error) as error:
            raise Failed(CANNOT_UNPACK) from error

    return Result("Package", stream=members())


def is_tar(content: bytes) -> bool:
    try:
        return content[257:262] == b"ustar" or tarfile.is_tarfile(io.BytesIO(content))
    except (OSError, EOFError, zlib.error):
        return False


def single(file: File, unpack, endings: tuple[str, ...]) -> Result:
    """One compressed member, named as the file without its ending; a compressed tar is unpacked as such."""
    if is_tar(file.content):
        return untar(file)
    try:
        content = unpack(file.content)
    except (OSError, EOFError, zlib.error) as error:
        raise Failed(CANNOT_UNPACK) from error
    name = file.name or "content"
    for e in endings:
        if name.lower().endswith(e):
            name = name[: -len(e)]
            break
    return Result("Package", stream=member(file, name or "content", content, set()))


def gunzip(file: File) -> Result:
    return single(file, gzip.decompress, (".gz", ".tgz"))


def bunzip2(file: File) -> Result:
    return single(file, bz2.decompress, (".tbz2", ".bz2", ".tbz", ".bz"))
