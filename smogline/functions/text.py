"""Name normalisation, stable ids and search predicates (ops B3, B4, I5)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _accent_table() -> tuple[str, str]:
    """(from, to) strings for ``translate``: every precomposed letter of the Latin,
    Greek and Cyrillic blocks whose canonical decomposition is a base letter plus
    non-spacing marks maps to that base; free-standing combining marks (U+0300..
    U+036F) are deleted. Built by rule from the Unicode database."""
    src, dst = [], []
    blocks = [(0x00C0, 0x024F), (0x0370, 0x03FF), (0x0400, 0x04FF), (0x1E00, 0x1FFF)]
    for lo, hi in blocks:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            d = unicodedata.normalize("NFD", ch)
            base = "".join(x for x in d if unicodedata.category(x) != "Mn")
            if d != ch and len(base) == 1 and base != ch:
                src.append(ch)
                dst.append(base)
    marks = [chr(cp) for cp in range(0x0300, 0x0370)]
    return "".join(src) + "".join(marks), "".join(dst)


_ACCENT_FROM, _ACCENT_TO = _accent_table()

# A character with case; Python's title case upper-cases a cased character that
# follows an uncased one and lower-cases the rest.
_UNCASED = r"[^\p{Lu}\p{Ll}\p{Lt}]"


def strip_accents(c) -> Column:
    return F.translate(_c(c), _ACCENT_FROM, _ACCENT_TO)


def python_title(c) -> Column:
    """``str.title()`` semantics (``initcap`` differs on ``o'neil``, ``3abc``, ``san-juan``)."""
    pieces = F.split(F.lower(_c(c)), rf"(?<={_UNCASED})")
    cap = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))
    return F.array_join(cap, "")


def normalize_name(c) -> Column:
    """null -> '', trim, strip accents, Python title case (op B3)."""
    return python_title(strip_accents(F.trim(F.coalesce(_c(c).cast("string"), F.lit("")))))


def stable_id(text, prefix: str = "", length: int = 8, upper: bool = False) -> Column:
    """prefix + first ``length`` hex chars of MD5(text) (op B4)."""
    h = F.substring(F.md5(_c(text).cast("string")), 1, length)
    if upper:
        h = F.upper(h)
    return F.concat(F.lit(prefix), h) if prefix else h


def contains_ci(c, query: str) -> Column:
    """Case-insensitive substring match; an empty query matches nothing (op I5)."""
    if query is None or query == "":
        return F.lit(False)
    return F.lower(_c(c)).contains(query.lower())
