"""Text normal forms that see through character variants."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

# Letters of other scripts that look like Latin ones.
LOOKALIKES = {"а": "a", "с": "c", "е": "e", "о": "o", "р": "p", "х": "x", "у": "y", "к": "k", "т": "t", "м": "m", "н": "h", "в": "b", "п": "n", "ԛ": "q", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԝ": "w", "ɡ": "g", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "α": "a", "ο": "o", "ν": "v", "ε": "e", "ι": "i", "κ": "k", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "А": "a", "В": "b", "С": "c", "Е": "e", "Н": "h", "І": "i", "Ј": "j", "К": "k", "М": "m", "О": "o", "Р": "p", "Ѕ": "s", "Т": "t", "Х": "x", "У": "y", "Α": "a", "Β": "b", "Ε": "e", "Ζ": "z", "Η": "h", "Ι": "i", "Κ": "k", "Μ": "m", "Ν": "n", "Ο": "o", "Ρ": "p", "Τ": "t", "Υ": "y", "Χ": "x"}
INVISIBLE = {c: None for c in [0x00AD, 0x034F, 0x061C, 0x180E, 0xFEFF, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070)]}
DASHES = {c: "-" for c in [0x2010, 0x2011, 0x2012, 0x2013, 0x2014, 0x2015, 0x2212, 0xFE58, 0xFE63, 0xFF0D]}
TABLE = {**{ord(k): v for k, v in LOOKALIKES.items()}, **INVISIBLE, **DASHES}
COMBINING = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")
#: Runs beyond ASCII; short ones repeat much, so their readings are remembered.
BEYOND = re.compile(r"[^\x00-\x7f]{1,8}")


@lru_cache(maxsize=200_000)
def _plain_run(run: str) -> str:
    """The Latin reading of a run of other than ASCII characters."""
    return COMBINING.sub("", unicodedata.normalize("NFKD", run).translate(TABLE)).casefold()


def plain(text: str) -> str:
    """Lower-case text without accents, invisible characters and look-alike letters; compatibility forms resolved."""
    return (text if text.isascii() else BEYOND.sub(lambda m: _plain_run(m[0]), text)).lower()


TAG = re.compile(r"</?[a-z][^<>]{0,80}>")
MARK = re.compile(r"\[\s?\d{1,4}(?:\s?[,;–-]\s?\d{1,4})*\s?\]|\(\s?(?:ref\.?|refs\.?|see)\s?\d{1,3}\s?\)")
BREAK = re.compile(r"(?<=[a-z])-[ \t]*\r?\n[ \t>]*(?=[a-z])")
POINT = re.compile(r"(?<=\d)[.,](?=\d)")
#: Signs closed up inside words, and every byte as it stands in words: letters and digits themselves, all others a blank.
CLOSED = b"-'`*_~"
BYTES = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))


def words(text: str | None) -> list[str]:
    """The words of a text, apart from case, punctuation, spacing, line breaks, markup, reference marks and character variants.

    Hyphens inside words and breaks at line ends are closed up; so are points inside numbers. Null gives no words.
    """
    if not text:
        return []
    s = plain(text)
    if "&" in s:
        s = html.unescape(s)
    if "<" in s:
        s = TAG.sub("", s)
    if "[" in s or "(" in s:
        s = MARK.sub(" ", s)
    if "-" in s:
        s = BREAK.sub("", s)
    if "." in s or "," in s:
        s = POINT.sub("", s)
    return s.encode("ascii", "replace").translate(BYTES, CLOSED).decode("ascii").split()
