"""Formats that programs of their own read: office files, DjVu, TIFF, archives, mail folders, Access, images, audio and video.

A program is found by the variable ``<NAME>_BIN``, else on the path.  Without it, or if it fails, the file is a failed entity that says so.
"""

from __future__ import annotations

import csv
import io
import json
import os
import shutil
import struct
import subprocess
import tempfile
from collections.abc import Iterator

from loamline.sources.base import CANNOT_UNPACK, ENCRYPTED, Failed, File, Result, safe_name
from loamline.sources.documents import timestamp
from loamline.sources.packages import member
from loamline.sources.pdf import pages_into
from loamline.sources.tables import sheet_into

# Seconds that programs may take.
SHELL_TIMEOUT, CONVERT_TIMEOUT, PST_TIMEOUT = 600, 300, 43_200
#: Images are recognised between these sizes in bytes, both excluded, in at most so many languages beside English.
OCR_LEAST, OCR_MOST, OCR_LANGUAGES = 2048, (30 << 20) - 1024, 4


def program(name: str) -> str:
    found = os.environ.get(f"{name.upper().replace('-', '_')}_BIN") or shutil.which(name)
    if not found:
        raise Failed(f"The program for this format is missing: {name}")
    return found


def run(name: str, *args: str, timeout: float = SHELL_TIMEOUT, folder: str | None = None) -> bytes:
    """What the program writes."""
    try:
        done = subprocess.run([program(name), *args], capture_output=True, timeout=timeout, cwd=folder, check=False)
    except subprocess.TimeoutExpired as error:
        raise Failed(f"Processing by {name} took too long.") from error
    except OSError as error:
        raise Failed(f"Cannot run {name}: {error}") from error
    if done.returncode:
        raise Failed(f"Processing by {name} failed: {done.stderr.decode('utf-8', 'replace').strip()[-500:]}")
    return done.stdout


def written(folder: str, file: File, default: str) -> str:
    path = os.path.join(folder, safe_name(file.name, default))
    with open(path, "wb") as f:
        f.write(file.content)
    return path


def as_pdf(file: File) -> bytes:
    """An office file as PDF."""
    with tempfile.TemporaryDirectory() as folder:  # of this one call
        path, out = written(folder, file, "document"), os.path.join(folder, "out")
        os.mkdir(out)
        run("soffice", "--headless", "--norestore", "--nolockcheck", f"-env:UserInstallation=file://{folder}/profile", "--convert-to", "pdf", "--outdir", out, path, timeout=CONVERT_TIMEOUT)
        for name in sorted(os.listdir(out)):
            found = os.path.join(out, name)
            if name.endswith(".pdf") and os.path.getsize(found):
                with open(found, "rb") as f:
                    return f.read()
    raise Failed("Could not convert this document to PDF.")


def office(file: File) -> Result:
    from loamline.sources import ole

    out = Result("Pages")
    if file.content.startswith(ole.MAGIC):
        ole.metadata_into(out, ole.Container(file.content))
    pages_into(out, file, as_pdf(file))
    return out


def converted(file: File, name: str, default: str, *attempts: tuple[str, ...]) -> Result:
    """Pages of the PDF that a program makes; attempts are its arguments, with IN and OUT."""
    with tempfile.TemporaryDirectory() as folder:
        path, made = written(folder, file, default), os.path.join(folder, "made.pdf")
        for k, args in enumerate(attempts):
            try:
                run(name, *[{"IN": path, "OUT": made}.get(a, a) for a in args])
                break
            except Failed:
                if k == len(attempts) - 1:
                    raise
        with open(made, "rb") as f:
            raw = f.read()
    out = Result("Pages")
    pages_into(out, file, raw)
    return out


def djvu(file: File) -> Result:
    return converted(file, "ddjvu", "page.djvu", ("-format=pdf", "-quality=85", "IN", "OUT"))


def tiff(file: File) -> Result:
    return converted(file, "tiff2pdf", "image.tiff", ("-x", "300", "-y", "300", "-F", "-o", "OUT", "IN"), ("-o", "OUT", "IN"))


def unpacked(file: File, default: str, name: str, *args: str, timeout: float = SHELL_TIMEOUT) -> Result:
    """Files that a program unpacks.  What it left when it failed counts too."""

    def members() -> Iterator:
        seen: set[str] = set()
        with tempfile.TemporaryDirectory() as folder:
            path, out = written(folder, file, default), os.path.join(folder, "out")
            os.mkdir(out)
            failure = None
            try:
                run(name, *[{"IN": path, "OUT": out}.get(a, a).replace("{OUT}", out) for a in args], timeout=timeout)
            except Failed as error:
                failure = error
            for above, folders, names in os.walk(out):
                folders[:] = sorted(f for f in folders if not os.path.islink(os.path.join(above, f)))
                for n in sorted(names):
                    own = os.path.join(above, n)
                    if os.path.isfile(own) and not os.path.islink(own):
                        with open(own, "rb") as f:
                            yield from member(file, os.path.relpath(own, out), f.read(), seen)
            if failure is not None:
                text = str(failure).lower()
                raise Failed(ENCRYPTED) if "password" in text or "encrypted" in text else failure if "missing" in text or "too long" in text else Failed(CANNOT_UNPACK)

    return Result("Package", stream=members())


def rar(file: File) -> Result:
    return unpacked(file, "archive.rar", "unrar", "x", "-y", "-p-", "IN", "{OUT}/")


def seven_zip(file: File) -> Result:
    return unpacked(file, "archive.7z", "7z", "x", "-y", "-p", "-o{OUT}", "IN")


def pst(file: File) -> Result:
    return unpacked(file, "folder.pst", "readpst", "-e", "-S", "-D", "-r", "-8", "-cv", "-o", "OUT", "IN", timeout=PST_TIMEOUT)


def access(file: File) -> Result:
    out = Result("Workbook")
    with tempfile.TemporaryDirectory() as folder:
        path = written(folder, file, "base.mdb")
        for title in run("mdb-tables", path).decode("utf-8", "replace").split():
            raw = run("mdb-export", path, title).decode("utf-8", "replace")
            rows = csv.reader(io.StringIO(raw))
            sheet_into(out, file, title, rows, next(rows, None))
    return out


# Numbers of the fields that a picture's metadata has, and what they become.
EXIF_DATES, EXIF_MAKER = {36867: "authoredAt", 306: "modifiedAt"}, {271: "generator", 272: "generator"}


def exif_fields(raw: bytes) -> dict[int, str]:
    """Text fields of the first picture directory and of the one for cameras, of a JPEG, PNG or TIFF."""
    at = 0 if raw[:4] in (b"II*\0", b"MM\0*") else raw.find(b"Exif\0\0") + 6 if b"Exif\0\0" in raw[: 1 << 20] else raw.find(b"eXIf") + 4 if raw.startswith(b"\x89PNG") and b"eXIf" in raw else -1
    if at < 0:
        return {}
    body, out = raw[at:], {}
    order = "<" if body[:2] == b"II" else ">"
    todo, seen = [4], set()
    try:
        while todo:
            place = struct.unpack_from(order + "I", body, todo.pop())[0]
            if place in seen:
                continue
            seen.add(place)
            for k in range(struct.unpack_from(order + "H", body, place)[0]):
                tag, kind, count = struct.unpack_from(order + "HHI", body, place + 2 + 12 * k)
                value = place + 10 + 12 * k
                if tag == 34665:
                    todo.append(value)
                elif kind == 2:
                    start = struct.unpack_from(order + "I", body, value)[0] if count > 4 else value
                    out[tag] = body[start : start + count].split(b"\0")[0].decode("utf-8", "replace").strip()
    except struct.error:
        pass
    return out


def ocr(raw: bytes, languages: tuple[str, ...] = ()) -> str | None:
    """Text in a picture, if the program is there; none for pictures too small or too large."""
    if not OCR_LEAST < len(raw) < OCR_MOST:
        return None
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "image")
        with open(path, "wb") as f:
            f.write(raw)
        return run("tesseract", path, "stdout", "-l", "+".join([*sorted(set(languages))[:OCR_LANGUAGES], "eng"])).decode("utf-8", "replace").strip() or None


def image(file: File) -> Result:
    """Dates, make and model of a picture; its text, where the program for it is installed."""
    out = Result("Image")
    for tag, value in exif_fields(file.content).items():
        if tag in EXIF_DATES:
            out.add(EXIF_DATES[tag], timestamp(value))
        elif tag in EXIF_MAKER:
            out.add(EXIF_MAKER[tag], value)
    try:
        text = ocr(file.content)
    except Failed as missing:
        if "missing" not in str(missing):
            raise
        text = None
    if text:
        out.add("bodyText", text)
    return out


# What a track's metadata becomes.
TRACK_PROPS = {"Title": "title", "Encoded_Application": "generator", "Writing_Application": "generator", "Performer": "author", "Copyright": "summary", "Comment": "summary"}
TRACK_DATES = {"Recorded_Date": "authoredAt", "Encoded_Date": "authoredAt", "Tagged_Date": "modifiedAt"}


def media(schema: str):
    def extract(file: File) -> Result:
        with tempfile.TemporaryDirectory() as folder:
            found = json.loads(run("mediainfo", "--Output=JSON", written(folder, file, "media")) or b"{}")
        out = Result(schema)
        for track in (found.get("media") or {}).get("track", []):
            for name, prop in TRACK_PROPS.items():
                out.add(prop, track.get(name))
            for name, prop in TRACK_DATES.items():
                out.add(prop, timestamp(track.get(name)))
            out.add("duration", track.get("Duration"))
        return out

    return extract


PROGRAMS = {
    "office": office, "djvu": djvu, "tiff": tiff, "rar": rar, "7z": seven_zip, "pst": pst, "access": access, "image": image, "audio": media("Audio"), "video": media("Video"),
}
