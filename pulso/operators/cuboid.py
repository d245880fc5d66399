"""The survey cuboid: every KPI as a (sum, count) cell of one small aggregate.

All averages in the reports are decomposable into sums and counts once the
per-row coercion/clipping is done, and all NPS / cohort metrics are counts.
So each report needs a single scan that aggregates into a table whose size is
bounded by the vocabularies (cohorts x NPS classes x questions), not by the
number of respondents. Map-side partial aggregation collapses rows before the
shuffle; everything after that runs on a few hundred rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.numeric import likert_score, to_number
from .segments import row_nonblank, with_segments


def _segment_keys(df: DataFrame, cohort_col: str | None, nps_col: str | None,
                  response_col: str | None) -> list[str]:
    keys = []
    for c in (cohort_col, nps_col, response_col or nps_col):
        if c and c in df.columns and c not in keys:
            keys.append(c)
    return keys


def respondent_cuboid(df: DataFrame, value_cols: dict[str, str] | None = None,
                      cohort_col: str | None = "cohort_raw", nps_col: str | None = "nps_raw",
                      response_col: str | None = None, loose: bool = False) -> DataFrame:
    """(cohort, nps_class, responded) -> n plus sum/count of each numeric value column.

    Pre-aggregates on the *raw* label columns first: that aggregate runs
    map-side on short strings, and label normalisation/classification then
    runs once per distinct spelling instead of once per respondent. A second
    tiny aggregate folds spellings into classes. ``value_cols`` maps an output
    prefix to a raw column; values are coerced (C5) but not clipped.
    """
    keys = _segment_keys(df, cohort_col, nps_col, response_col)
    src = df
    if not (response_col or nps_col) or (response_col or nps_col) not in df.columns:
        # no response column -> any non-null cell, evaluated per row.
        src = src.withColumn("__responded", row_nonblank(df))
        keys = keys + ["__responded"]
    aggs = [F.count(F.lit(1)).alias("n")]
    names = []
    for name, col in (value_cols or {}).items():
        names.append(name)
        if col and col in df.columns:
            v = to_number(F.col(col))
            aggs += [*exact.sums(v, name), F.count(v).alias(f"{name}_cnt")]
        else:
            aggs += [*exact.no_sums(name), F.lit(0).cast("bigint").alias(f"{name}_cnt")]
    raw = src.groupBy(*keys).agg(*aggs)
    seg = with_segments(raw, cohort_col, nps_col, response_col, loose=loose)
    if "__responded" in keys:
        seg = seg.withColumn("responded", F.col("__responded"))
    folded = [F.sum("n").alias("n")]
    for name in names:
        folded += [*exact.add_up(name), F.sum(f"{name}_cnt").alias(f"{name}_cnt")]
    return seg.groupBy("cohort", "nps_class", "responded").agg(*folded)


BLOCK = 16      # columns of a sheet that one aggregate row adds up: two sums each stay within the columns that Spark compiles


def sheet_cuboid(cells: DataFrame, questions: dict[str, str], cohort: str | None, nps: str | None) -> DataFrame:
    """(question_id, cohort_raw, nps_raw) -> exact sum / count of the clipped score, added up column by column.

    ``questions`` maps question ids to columns of a wide sheet. A respondent becomes one row per block of columns, not one per question: the
    sums of a block are taken side by side for each spelling of cohort and NPS answer, and only that small result is turned into a row per
    question.
    """
    ids = list(questions)
    label = lambda c, name: (F.col(c) if c else F.lit(None)).cast("string").alias(name)
    keys = [label(cohort, "cohort_raw"), label(nps, "nps_raw")]
    blocks = [ids[i:i + BLOCK] for i in range(0, len(ids), BLOCK)] or [[]]
    none = F.lit(None).cast("double")
    rows = [F.struct(F.lit(b).alias("block"), *[(likert_score(F.col(questions[block[i]])) if i < len(block) else none).alias(f"v{i}") for i in range(BLOCK)])
            for b, block in enumerate(blocks)]
    long = cells.select(*keys, F.inline(F.array(*rows)))
    sums = [a for i in range(BLOCK) for a in (exact.likert_sum(F.col(f"v{i}")).alias(f"s{i}"), F.count(f"v{i}").alias(f"c{i}"))]
    small = long.groupBy("block", "cohort_raw", "nps_raw").agg(*sums)
    each = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"s{i}").alias("s_sum"), F.col(f"c{i}").alias("s_cnt")) for i in range(BLOCK)]))
    names = F.array(*[F.lit(q) for q in ids]) if ids else F.array().cast("array<string>")
    out = small.select("block", "cohort_raw", "nps_raw", each).withColumn("question_id", F.get(names, F.col("block") * BLOCK + F.col("i")))
    return out.filter(F.col("question_id").isNotNull()).select("question_id", "cohort_raw", "nps_raw", "s_sum", "s_cnt")


def answer_cuboid(answers: DataFrame, respondents: DataFrame | None = None,
                  score_col: str = "score_raw", cohort_col: str = "cohort_raw", nps_col: str = "nps_raw",
                  loose: bool = False, segments: bool = False) -> DataFrame:
    """(question_id[, cohort, nps_class]) -> exact sum (``exact.likert_sum``) / count of the clipped 1..4 score.

    Without ``respondents`` no join is needed: General scores, or segments too if the
    answers carry their row's label columns (``segments``). Otherwise the
    answers are joined on ``row_ord`` to the respondents' raw segment labels
    and aggregated by (question, raw cohort, raw NPS) right after the join
    (partial aggregation in the join stage); classification runs on that
    small result and a last aggregate folds spellings into classes.
    """
    if "s_sum" in answers.columns:      # added up already, as by ``sheet_cuboid``
        if not segments:
            return answers.groupBy("question_id").agg(F.sum("s_sum").alias("s_sum"), F.sum("s_cnt").alias("s_cnt"))
        return _fold_classes(answers, cohort_col, nps_col, loose)
    s = likert_score(F.col(score_col))
    if respondents is None and segments:
        keys = [c for c in (cohort_col, nps_col) if c in answers.columns]
        return _fold_answers(answers.select("question_id", *keys, s.alias("s")), keys, cohort_col, nps_col, loose)
    if respondents is None:
        return answers.groupBy("question_id").agg(exact.likert_sum(s).alias("s_sum"), F.count(s).alias("s_cnt"))
    keys = [c for c in (cohort_col, nps_col) if c in respondents.columns]
    seg = respondents.select("row_ord", *keys)
    # Parse/clip before the join and keep only answers with a value: the join
    # shuffles (row_ord, question_id, double) for valid answers only, and
    # missing answers would add nothing to a sum or a count anyway.
    scored = answers.select("row_ord", "question_id", s.alias("s")).filter(F.col("s").isNotNull())
    return _fold_answers(scored.join(seg, "row_ord"), keys, cohort_col, nps_col, loose)


def _fold_answers(scored: DataFrame, keys: list[str], cohort_col: str, nps_col: str, loose: bool) -> DataFrame:
    raw = scored.groupBy("question_id", *keys).agg(exact.likert_sum(F.col("s")).alias("s_sum"), F.count("s").alias("s_cnt"))
    return _fold_classes(raw, cohort_col, nps_col, loose)


def _fold_classes(raw: DataFrame, cohort_col: str, nps_col: str, loose: bool) -> DataFrame:
    cls = with_segments(raw, cohort_col, nps_col, loose=loose)
    return cls.groupBy("question_id", "cohort", "nps_class").agg(F.sum("s_sum").alias("s_sum"),
                                                                 F.sum("s_cnt").alias("s_cnt"))
