"""Scalar text functions, as expressions that stay in generated code."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that Python's float() takes, without regard to case.
NUMBER = (
    r"^\s*[+-]?(?:\d+(?:_\d+)*(?:\.(?:\d+(?:_\d+)*)?)?(?:[eE][+-]?\d+(?:_\d+)*)?|\.\d+(?:_\d+)*(?:[eE][+-]?\d+(?:_\d+)*)?|inf(?:inity)?|nan)\s*$"
)
CHUNK, SHORTEST = 25_000, 5

# The patterns of tagged values.
EMAIL = r"[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
PHONE = r"(\+?[\d\-\(\)\/\s]{5,}\d{2})"
IBAN = r"\b([a-zA-Z]{2} ?[0-9]{2} ?[a-zA-Z0-9]{4} ?[0-9]{7} ?([a-zA-Z0-9]?){0,16})\b"

# Timestamp formats in the order in which they are tried.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy:MM:dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy:MM:dd HH:mm:ss'Z'", "z yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyyMMdd",
)


def collapse(text: Column) -> Column:
    """White space runs to one blank, trimmed; null if nothing is left."""
    out = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(out != "", out)


def keeps_text(text: Column) -> Column:
    """Whether a text is worth indexing: not null, not blank, not a number."""
    return F.coalesce(text.rlike(r"(?U)\S") & ~text.rlike("(?iU)" + NUMBER), F.lit(False))


def filter_texts(texts: Column) -> Column:
    """Those of an array of texts that :func:`keeps_text`."""
    return F.filter(texts, keeps_text)


def chunks(text: Column, size: int = CHUNK, shortest: int = SHORTEST) -> Column:
    """Array of slices of the collapsed text; none if it is too short.  The text is collapsed once, not for each slice."""
    none = F.array().cast("array<string>")
    slices = lambda flat: F.transform(F.sequence(F.lit(0), F.floor((F.length(flat) - 1) / size).cast("int")), lambda i: F.substring(flat, i * size + 1, F.lit(size)))
    flat = F.coalesce(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), F.lit(""))
    return F.flatten(F.transform(F.array(flat), lambda flat: F.when(F.length(flat) >= shortest, slices(flat)).otherwise(none)))


#: A word's begin and bound where words are of ASCII letters, digits and ``_``; what ``\b`` means to Java depends on its version.
ASCII_BEGIN = "(?<![0-9A-Za-z_])"
ASCII_BOUND = f"(?:{ASCII_BEGIN}(?=[0-9A-Za-z_])|(?<=[0-9A-Za-z_])(?![0-9A-Za-z_]))"


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern, in order, without regard to case; words end at all that is not ASCII, as in its SQL form.

    A pattern that begins with a bound is to go on with a word's character.
    """
    begin, rest = (ASCII_BEGIN, pattern[2:]) if pattern.startswith(r"\b") else ("", pattern)
    return F.regexp_extract_all(text, F.lit("(?i)" + begin + rest.replace(r"\b", ASCII_BOUND)), F.lit(0))


def clean_email(value: Column) -> Column:
    """Lower-cases the domain; null if a label of it is empty or too long."""
    name, domain = F.substring_index(value, "@", 1), F.lower(F.substring_index(value, "@", -1))
    sound = domain.rlike(r"^[a-z0-9]([a-z0-9-]*[a-z0-9])?(\.[a-z0-9]([a-z0-9-]*[a-z0-9])?)*\.[a-z]{2,63}$") & (F.length(name) <= 64)
    return F.when(sound, F.concat(name, F.lit("@"), domain))


def clean_iban(value: Column) -> Column:
    """Upper case without blanks; null unless the check digits hold (mod 97) and the length is 15 to 34."""
    flat = F.upper(F.replace(value, F.lit(" "), F.lit("")))
    turned = F.concat(F.substring(flat, 5, 34), F.substring(flat, 1, 4))
    digit = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise((acc * F.when(c.rlike("[0-9]"), 10).otherwise(100) + digit(c)) % 97))
    return F.when(F.length(flat).between(15, 34) & (rest == 1), flat)


def clean_phone(value: Column) -> Column:
    """International numbers alone: ``+`` and 8 to 15 digits; a leading 00 counts as ``+``."""
    bare = F.regexp_replace(F.regexp_replace(value, r"\(0\)", ""), r"[^\d+]", "")
    number = F.regexp_replace(bare, "^00", "+")
    return F.when(number.rlike(r"^\+[1-9]\d{7,14}$"), number)


#: Calling codes that name one country, longest first where one begins another.
CALLING_CODES = {
    "20": "eg", "27": "za", "30": "gr", "31": "nl", "32": "be", "33": "fr", "34": "es", "36": "hu", "39": "it", "40": "ro", "41": "ch", "43": "at", "44": "gb", "45": "dk", "46": "se", "47": "no",
    "48": "pl", "49": "de", "51": "pe", "52": "mx", "53": "cu", "54": "ar", "55": "br", "56": "cl", "57": "co", "58": "ve", "60": "my", "61": "au", "62": "id", "63": "ph", "64": "nz", "65": "sg",
    "66": "th", "81": "jp", "82": "kr", "84": "vn", "86": "cn", "90": "tr", "91": "in", "92": "pk", "93": "af", "94": "lk", "95": "mm", "98": "ir", "212": "ma", "213": "dz", "216": "tn", "218": "ly",
    "234": "ng", "254": "ke", "351": "pt", "352": "lu", "353": "ie", "354": "is", "355": "al", "356": "mt", "357": "cy", "358": "fi", "359": "bg", "370": "lt", "371": "lv", "372": "ee", "373": "md",
    "374": "am", "375": "by", "380": "ua", "381": "rs", "382": "me", "385": "hr", "386": "si", "387": "ba", "389": "mk", "420": "cz", "421": "sk", "423": "li", "852": "hk", "886": "tw", "961": "lb",
    "962": "jo", "963": "sy", "964": "iq", "965": "kw", "966": "sa", "971": "ae", "972": "il", "973": "bh", "974": "qa", "994": "az", "995": "ge", "998": "uz",
}


def phone_country(number: Column) -> Column:
    """Country of an international number, by its calling code; null if none or several have it."""
    codes = F.create_map(*[F.lit(x) for pair in CALLING_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, F.substring(number, 2, 3)), F.try_element_at(codes, F.substring(number, 2, 2)))


def iban_country(iban: Column) -> Column:
    return F.lower(F.substring(iban, 1, 2))


def clean_name(name: Column) -> Column:
    """A name of a person or company: at most 100 characters before, more than 4 after cleaning, with a blank."""
    bare = collapse(F.regexp_replace(name, r"^[\s\p{Punct}]+|[\s\p{Punct}]+$", ""))
    return F.when((F.length(name) <= 100) & (F.length(bare) > 4) & bare.contains(" "), bare)


def parse_timestamp(raw: Column) -> Column:
    """The first format that fits; a fraction of a second is cut.  Null if none does."""
    text = F.substring_index(raw, ".", 1)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in TIMESTAMP_FORMATS])


def timestamp_or_raw(raw: Column) -> Column:
    """ISO text of the first format that fits, a fraction of a second cut; text that none fits as it is, and null for blank text."""
    return F.when(raw.rlike(r"(?U)\S"), F.coalesce(F.date_format(parse_timestamp(raw), "yyyy-MM-dd'T'HH:mm:ss"), raw))


def nfkd(text: Column) -> Column:
    """Compatibility decomposition (NFKD) of stripped text, stripped again.  Spark has no expression for it, so it goes by Arrow batches."""

    @F.pandas_udf("string")
    def normal(values: pd.Series) -> pd.Series:
        return values.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x.strip()).strip())

    return normal(text)


def html_escape(text: Column) -> Column:
    """Text as HTML: escaped, trimmed, with ``<br>`` for each line end."""
    out = text
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.replace(F.regexp_replace(out, r"(?U)^\s+|\s+$", ""), F.lit("\n"), F.lit("<br>"))


def message_ids(header: Column) -> Column:
    """The ids between angle brackets, trimmed, of more than 4 characters."""
    found = F.transform(F.regexp_extract_all(header, F.lit("<([^>]*)>"), F.lit(1)), lambda m: F.trim(m))
    return F.coalesce(F.filter(found, lambda x: F.length(x) > 4), F.array().cast("array<string>"))


def reply_target(references: Column, in_reply_to: Column) -> Column:
    """The last of the references, else the first id that is replied to."""
    return F.coalesce(F.get(F.reverse(message_ids(references)), F.lit(0)), F.get(message_ids(in_reply_to), F.lit(0)))


def path_extension(name: Column) -> Column:
    """Lower-case extension of a file name, without the dot; null if none."""
    found = F.lower(F.regexp_extract(name, r"\.([^./\\]+)$", 1))
    return F.when(found != "", found)


#: The first line of a box of messages: who sent it, and a date as asctime gives it, with a zone before or behind the year.  Prose may begin with ``From``, too.
MBOX_LINE = (
    r"^From \S+ +(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),? +(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) +\d{1,2}(?: +\d{1,2}:\d{2}(?::\d{2})?)?(?: +[A-Z]{1,5}| +[+-]\d{4})? +\d{4}(?: +[A-Z]{1,5}| +[+-]\d{4})?"
    r"(?: +remote from \S+)?\s*\n"
)


def sniff(content: Column) -> Column:
    """Media type by the first bytes; null if they tell nothing.  One look at a file's head serves all."""
    head = F.hex(F.substring(content, 1, 512))
    shown = F.decode(F.substring(content, 1, 512), "ISO-8859-1")
    text_at = F.lower(F.ltrim(shown))
    signs = [
        ("25504446", "application/pdf"), ("504B0304", "application/zip"), ("504B0506", "application/zip"), ("1F8B", "application/gzip"), ("425A683", "application/x-bzip2"),
        ("D0CF11E0A1B11AE1", "application/CDFV2-unknown"), ("53514C69746520666F726D6174203300", "application/x-sqlite3"), ("89504E470D0A1A0A", "image/png"), ("FFD8FF", "image/jpeg"),
        ("474946383761", "image/gif"), ("474946383961", "image/gif"), ("49492A00", "image/tiff"), ("4D4D002A", "image/tiff"), ("526172211A07", "application/x-rar"),
        ("377ABCAF271C", "application/x-7z-compressed"), ("41542654464F524D", "image/vnd.djvu"), ("2142444E", "application/vnd.ms-outlook"), ("664C6143", "audio/flac"), ("4F676753", "audio/ogg"),
        ("49443302", "audio/mpeg"), ("49443303", "audio/mpeg"), ("49443304", "audio/mpeg"), ("7B5C727466", "text/rtf"),
    ]
    out = F.when(F.length(content) < 1, F.lit(None).cast("string"))
    for sign, mime in signs:
        out = out.when(head.startswith(sign), F.lit(mime))
    out = out.when(head.startswith("424D") & (F.substring(head, 31, 6) == "000000"), F.lit("image/bmp"))  # the size of its second header, as prose may begin with BM
    out = out.when(F.substring(head, 515, 10) == "7573746172", F.lit("application/x-tar"))
    for start, mime in (("<!doctype html", "text/html"), ("<html", "text/html"), ("<svg", "image/svg+xml"), ("<?xml", "text/xml"), ("begin:vcard", "text/vcard"), ("begin:vcalendar", "text/calendar"), ("return-path:", "message/rfc822"), ("received:", "message/rfc822"), ("message-id:", "message/rfc822")):
        out = out.when(text_at.startswith(start), F.lit(mime))
    out = out.when(shown.rlike(MBOX_LINE), F.lit("application/mbox"))
    return out.when(~shown.contains("\x00"), F.lit("text/plain"))
