"""String similarity.

``levenshtein_ratio`` is native (JVM) and SQL-expressible:
1 - distance / max(len). ``ratcliff_ratio`` is the Ratcliff/Obershelp
gestalt ratio 2*M/T of the label-matching reports; Spark has no built-in for
it, so it runs as an Arrow-batched pandas UDF around ``difflib``.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def levenshtein_ratio(a: Column, b: Column) -> Column:
    m = F.greatest(F.length(a), F.length(b))
    r = F.lit(1.0) - F.try_divide(F.levenshtein(a, b).cast("double"), m.cast("double"))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(r, F.lit(1.0)))


def _ratio(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    return SequenceMatcher(None, a, b).ratio()


def _ratcliff_series(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def ratcliff_ratio(a: Column, b: Column) -> Column:
    """Pairwise gestalt ratio of two string columns (a is the probe, b the key)."""
    return F.pandas_udf(_ratcliff_series, "double")(a, b)


def ratcliff_from(a: Column, b: Column, threshold: float) -> Column:
    """The gestalt ratio where it can reach the threshold by the texts' lengths and shared characters, else NULL."""

    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        out, matcher = [], SequenceMatcher(None, "", "")
        for x, y in zip(a, b):
            matcher.set_seqs(x, y)
            out.append(matcher.ratio() if matcher.real_quick_ratio() >= threshold and matcher.quick_ratio() >= threshold else None)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(score, "double")(a, b)


def best_ratcliff_udf(candidates: list[tuple[int, str, str]], threshold: float = 0.0):
    """Pandas UDF: best (value, score, ord) of one label against a bounded candidate list.

    The list is configuration-sized (checked by the caller) and travels with
    the function; ties keep the first candidate (strictly greater wins).
    Candidates that cannot reach ``threshold`` or beat the current best are
    skipped using difflib's cheap upper bounds (length, then multiset), which
    never changes the accepted match.
    """
    cands = list(candidates)

    @F.pandas_udf("value STRING, score DOUBLE, ord BIGINT")
    def best(labels: pd.Series) -> pd.DataFrame:
        # One matcher per candidate: the candidate is seq2, whose index is
        # built once per batch; each label only swaps seq1.
        matchers = [(o, SequenceMatcher(None, "", key), v) for o, key, v in cands]
        vals, scores, ords = [], [], []
        for lab in labels:
            best_v, best_s, best_o = None, 0.0, None
            if lab is not None:
                for o, sm, v in matchers:
                    sm.set_seq1(lab)
                    floor = max(best_s, threshold)
                    ub = sm.real_quick_ratio()
                    if ub < threshold or ub <= best_s:
                        continue
                    ub = sm.quick_ratio()
                    if ub < floor or ub <= best_s:
                        continue
                    s = sm.ratio()
                    if s > best_s:
                        best_v, best_s, best_o = v, s, o
            vals.append(best_v)
            scores.append(best_s if best_v is not None else None)
            ords.append(best_o)
        return pd.DataFrame({"value": vals, "score": scores, "ord": pd.array(ords, dtype="Int64")})

    return best
