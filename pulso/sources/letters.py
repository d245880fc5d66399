"""Spreadsheet-letter column addressing (P1, P2, P3) and wide-sheet conversion.

A survey sheet addresses columns by letter (A = first, AA = 27th). These
helpers resolve letters to DataFrame columns when the plan is built; nothing
here touches data.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import plain_label


def letter_to_index(letter: str | None) -> int:
    """Base-26, 0-based; non-letters ignored (accents stripped first); empty / "?" -> -1."""
    digits = re.findall("[A-Z]", plain_label(letter or "").upper())
    return reduce(lambda n, d: 26 * n + ord(d) - 64, digits, 0) - 1


def index_to_letter(idx: int) -> str:
    out = ""
    n = idx + 1
    while n > 0:
        n, r = divmod(n - 1, 26)
        out = chr(ord("A") + r) + out
    return out


def by_position(df: DataFrame) -> DataFrame:
    """The columns renamed c0, c1, ...: whatever their labels hold, and even where labels repeat, a position has one name."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def quoted(name: str) -> str:
    """A label as a column name: dots and backticks lose their meaning."""
    return "`" + name.replace("`", "``") + "`"


def _place(df: DataFrame, letter: str | None) -> int | None:
    """The position of a letter, or None when out of range; an ordinal behind the cells (``row_ord``) has no letter."""
    i = letter_to_index(letter)
    return i if 0 <= i < len(df.columns) - (df.columns[-1:] == ["row_ord"]) else None


def column_name(df: DataFrame, letter: str | None) -> str | None:
    """The label at a letter's position, or None when out of range."""
    i = _place(df, letter)
    return df.columns[i] if i is not None else None


def position_name(df: DataFrame, letter: str | None) -> str | None:
    """The column of ``by_position(df)`` at a letter, or None when out of range."""
    i = _place(df, letter)
    return f"c{i}" if i is not None else None


def col_at(df: DataFrame, letter: str | None, dtype: str = "string") -> Column:
    """The column at a letter, or a typed NULL column when the letter is out of range.

    Where the label at that letter repeats, address ``by_position(df)`` instead.
    """
    name = column_name(df, letter)
    if name is not None and df.columns.count(name) > 1:
        raise ValueError(f"the label {name!r} repeats: take the column from by_position(df)")
    return F.col(quoted(name)) if name is not None else F.lit(None).cast(dtype)


def select_letters(df: DataFrame, mapping: Mapping[str, str | None], missing: str | None = None) -> DataFrame:
    """Project ``{output name: letter}``; absent letters give ``missing`` (NULL by default)."""
    cols = []
    for alias, letter in mapping.items():
        name = position_name(df, letter)
        c = F.col(name).cast("string") if name is not None else F.lit(missing).cast("string")
        cols.append(c.alias(alias))
    return by_position(df).select(*cols)


def wide_to_canonical(df: DataFrame, question_letters: Mapping[str, str], roles: Mapping[str, str | None],
                      row_ord_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split a wide, letter-addressed survey sheet into (respondents, answers).

    ``roles`` maps canonical respondent columns (``id``, ``cohort_raw``,
    ``nps_raw``, ``satisfaction_raw`` ...) to letters; ``question_letters``
    maps question ids to letters. Answers come from one ``unpivot`` (a narrow
    Expand, no shuffle) and carry their row's cohort and NPS cells, so no report has
    to join them back. ``row_ord`` is the given ordinal column; without one there is
    none, and reports that need an order of rows ask for it.
    """
    place = lambda letter: position_name(df, letter)
    ordinal = [F.col(f"c{df.columns.index(row_ord_col)}").cast("bigint").alias("row_ord")] if row_ord_col else []
    named = {name: (F.col(place(letter)) if place(letter) else F.lit(None)).cast("string").alias(name) for name, letter in roles.items()}
    cells = by_position(df)
    resp = cells.select(*ordinal, *named.values())
    carried = [c for c in ("cohort_raw", "nps_raw") if c in named]
    present = {q: place(letter) for q, letter in question_letters.items()}
    present = {q: c for q, c in present.items() if c is not None}
    keys = (["row_ord"] if ordinal else []) + carried
    staged = cells.select(*ordinal, *[named[c] for c in carried],
                       *[F.col(c).cast("string").alias(f"q:{q}") for q, c in present.items()])
    if not present:
        none = F.lit(None).cast("string")
        return resp, staged.select(*keys, none.alias("question_id"), none.alias("score_raw")).limit(0)
    ans = staged.unpivot(keys, [f"q:{q}" for q in present], "question_id", "score_raw")
    return resp, ans.withColumn("question_id", F.substring("question_id", 3, 1 << 20))


def letter_range(first: str, last: str, skip: Sequence[str] = ()) -> list[str]:
    """All letters from ``first`` to ``last`` inclusive, minus ``skip``."""
    lo, hi = letter_to_index(first), letter_to_index(last)
    return [index_to_letter(i) for i in range(lo, hi + 1) if index_to_letter(i) not in set(skip)]
