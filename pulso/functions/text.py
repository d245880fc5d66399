"""Label normalisation and text predicates as native Column expressions.

Everything here compiles to JVM expressions (translate / regexp_replace /
lower / rlike), so it stays inside whole-stage codegen and never ships a row
to Python.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens the reports treat as "no answer" (compared after the
# text is trimmed and lower-cased). The sixth entry is the two characters
# n, backslash, a; the eighth is an en dash.
EMPTY_LIKE = ("", "nan", "none", "na", "n/a", "n\\a", "-", "–", "--", "s/d", "sd")

# Code points whose canonical decomposition is "one base letter + combining
# marks". Built from a rule (NFD, drop category Mn) so the table covers Latin,
# Greek and Cyrillic precomposed letters without listing them by hand.
_FOLD_RANGES = ((0x00C0, 0x0250), (0x0370, 0x0400), (0x0400, 0x0530), (0x1E00, 0x1F00), (0x1F00, 0x2000))


def _accent_fold_table() -> tuple[str, str]:
    src, dst = [], []
    for lo, hi in _FOLD_RANGES:
        for cp in range(lo, hi):
            ch = chr(cp)
            base = "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")
            if base != ch and len(base) == 1:
                src.append(ch)
                dst.append(base)
    return "".join(src), "".join(dst)


FOLD_SRC, FOLD_DST = _accent_fold_table()
_FOLD_MAP = str.maketrans(FOLD_SRC, FOLD_DST)
# Loose combining marks, by rule, for texts of the configuration.
_FOLD_MAP.update(dict.fromkeys(cp for cp in range(0x300, 0x1F000) if unicodedata.category(chr(cp)) == "Mn"))

# Java regex pieces. (?U) makes \s the Unicode White_Space class; Python's
# str.split() additionally splits on the information separators \x1c-\x1f.
_WS_RUN = r"(?U)[\s\x1c-\x1f]+"
_COMBINING = r"\p{Mn}+"
_NUMERIC_PREFIX = r"^\d[^ ]* "


def plain_label(text: str, loose: bool = False) -> str:
    """C1 (C2 if ``loose``) of a configuration text at plan time: the same fold table and patterns as for data."""
    folded = re.sub(r"[\s\x1c-\x1f]+", " ", str(text).translate(_FOLD_MAP)).strip(" ").lower()
    return re.sub(r"[^\w ]|_", "", folded) if loose else folded


def plain_without_prefix(text: str) -> str:
    """C4 of a configuration text at plan time."""
    return re.sub(_NUMERIC_PREFIX, "", text, count=1)


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c: Column | str) -> Column:
    """Remove diacritics: fold precomposed letters, then drop loose combining marks."""
    x = F.translate(_as_col(c).cast("string"), FOLD_SRC, FOLD_DST)
    return F.regexp_replace(x, _COMBINING, "")


def collapse_ws(c: Column | str) -> Column:
    """Collapse every whitespace run to one space and trim; keeps case and accents."""
    return F.trim(F.regexp_replace(_as_col(c).cast("string"), _WS_RUN, " "))


def norm_label(c: Column | str) -> Column:
    """Accent-free, whitespace-collapsed, trimmed, lower-case label. NULL stays NULL."""
    return F.lower(F.trim(F.regexp_replace(strip_accents(c), _WS_RUN, " ")))


def norm_label_loose(c: Column | str) -> Column:
    """C1 then drop everything that is not a letter, a digit or a space.

    Whitespace is collapsed before the punctuation is dropped, so "a - b"
    becomes "a  b" (two spaces), as in the reports it mirrors.
    """
    return F.regexp_replace(norm_label(c), r"[^\p{L}\p{N} ]", "")


def strip_numeric_prefix(c: Column | str) -> Column:
    """C4: "5 o más" -> "o más"; text not starting with a digit, or without a space, is kept."""
    return F.regexp_replace(_as_col(c).cast("string"), "(?U)" + _NUMERIC_PREFIX, "")


def answered_raw(c: Column | str) -> Column:
    """A raw cell counts as an answer.

    nbsp/tab/CR/LF become spaces, the text is trimmed and lower-cased (accents
    kept); it must not be an empty-like token and must contain an ASCII
    letter or digit. NULL -> false.
    """
    s = F.regexp_replace(_as_col(c).cast("string"), r"[\x{A0}\t\r\n]", " ")
    s = F.lower(F.regexp_replace(s, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    return F.coalesce(~s.isin(*EMPTY_LIKE) & s.rlike("[0-9a-zA-Z]"), F.lit(False))


def answered_label(c: Column | str) -> Column:
    """As F2a but over the C1-normalised label (NPS answers)."""
    s = norm_label(c)
    return F.coalesce(~s.isin(*EMPTY_LIKE) & s.rlike("[0-9a-zA-Z]"), F.lit(False))


def nonempty_label(c: Column | str) -> Column:
    """C1 label is not an empty-like token (no alphanumeric test: "?" is a category)."""
    return F.coalesce(~norm_label(c).isin(*EMPTY_LIKE), F.lit(False))

