"""Folding of text to a canonical form, on the Python side and as a Column.

Folded text is lower case and has no accents, glottal marks, invisible
characters or character entities; what is neither letter nor digit is a space.
"""

from __future__ import annotations

import html
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks that stand for a glottal stop or an apostrophe, and the code points without width.
GLOTTALS = "ʻʼ‘’‛`´′‵'ʹʽˈꞌ"
INVISIBLES = "\u00ad\u034f\u061c\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\ufeff"

_DROP = re.compile(f"[{GLOTTALS}{INVISIBLES}]|[\u0300-\u036f]")
_ENTITY = re.compile(r"&#?\w{1,10};")
_WORD = re.compile(r"[^\W_]+")


def unescape(text: str) -> str:
    """text with its character entities replaced, also where they were escaped twice."""
    for _ in range(2):
        if "&" not in text or not _ENTITY.search(text):
            break
        text = html.unescape(text)
    return text


def fold(text: str) -> str:
    """text in folded form, still with its punctuation."""
    if text.isascii() and "&" not in text and "'" not in text and "`" not in text:
        return text.lower()
    return _DROP.sub("", unicodedata.normalize("NFKD", _DROP.sub("", unescape(text)).lower()))


def words(text: str | None) -> list[str]:
    """The words of the folded text."""
    return _WORD.findall(fold(text)) if text else []


def _folds() -> tuple[str, str]:
    """Accented Latin letters and their bare lower-case letters, derived from their Unicode decomposition."""
    source, target = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        bare = unicodedata.normalize("NFKD", chr(code).lower())[0]
        if bare.isascii() and bare.isalpha():
            source.append(chr(code))
            target.append(bare)
    return "".join(source), "".join(target)


_SOURCE, _TARGET = _folds()


def folded(text: Column) -> Column:
    """The Column form for Latin text: words of the folded text, joined by single blanks."""
    plain = F.regexp_replace(text, r"&(?:amp;)?(?:lsquo|rsquo|#8216|#8217|#x2018|#x2019|#39|apos|okina);", "")
    plain = F.regexp_replace(plain, r"&#?\w{1,10};", " ")
    plain = F.translate(F.lower(plain), _SOURCE, _TARGET)
    plain = F.regexp_replace(plain, f"[{GLOTTALS}{INVISIBLES}\u0300-\u036f]", "")
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))
