"""Question x segment matrix of 0..10 scores.

Plan: answers JOIN (row_ord -> cohort, nps_class) -> cuboid on
(question_id, cohort, nps_class) -> per-question conditional sums (the
"pivot", over at most questions x 5 x 5 cells) -> template rows resolved to
question ids by the label matcher -> left join, template order kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.numeric import or_zero, scale4_to_10
from ..operators.cuboid import answer_cuboid
from ..operators.matching import match_labels
from ..operators.segments import filter_ids
from ..sources.dims import Question, question_dim

# Output segment columns, in report order: (column, filter column, filter value).
SEGMENTS = (
    ("general", None, None),
    ("boomers", "cohort", "baby boomers"),
    ("generacion_x", "cohort", "generacion x"),
    ("milenialls", "cohort", "milenialls"),
    ("centenialls", "cohort", "centenialls"),
    ("entusiastas", "nps_class", "promoter"),
    ("pasivos", "nps_class", "passive"),
    ("detractores", "nps_class", "detractor"),
)
SEGMENT_COLS = tuple(s[0] for s in SEGMENTS)


def segment_scores(answers: DataFrame, respondents: DataFrame | None, ids: Iterable | None = None,
                   cohort_col: str = "cohort_raw", nps_col: str = "nps_raw") -> DataFrame:
    """question_id + one 0..10 score per segment (0.0 where a segment has no valid answer).

    Without ``respondents`` the answers carry their row's label columns and nothing is joined.
    """
    sel = filter_ids(respondents, ids) if respondents is not None else None
    # This report matches labels punctuation-insensitively.
    cube = answer_cuboid(answers, sel, cohort_col=cohort_col, nps_col=nps_col, loose=True, segments=True)
    cols = []
    for name, fcol, fval in SEGMENTS:
        cond = F.lit(True) if fcol is None else (F.col(fcol) == F.lit(fval))
        s = F.sum(F.when(cond, F.col("s_sum")))
        c = F.sum(F.when(cond, F.col("s_cnt")))
        cols.append(or_zero(scale4_to_10(exact.likert_mean(s, c))).alias(name))
    return cube.groupBy("question_id").agg(*cols)


def question_matrix(answers: DataFrame, respondents: DataFrame | None, questions: Sequence[Question],
                    template: DataFrame | None = None, ids: Iterable | None = None,
                    cohort_col: str = "cohort_raw", nps_col: str = "nps_raw",
                    metric: str = "ratcliff", threshold: float = 0.75, diagnostics: bool = False) -> DataFrame:
    """One row per template row (or per question when no template is given).

    ``template`` columns: template_ord, index, question, clima, ife, weight
    (see ``dims.template_from_table``). Unmatched rows keep their metadata and
    get NULL scores. The weight is carried, never applied. ``diagnostics``
    adds how each row was matched (exact / normalized / fuzzy) and the fuzzy score.
    """
    spark = answers.sparkSession
    qdim = question_dim(spark, list(questions))
    if template is None:
        # Fallback template = the question dimension itself: every row is its own
        # exact match, so no matching job is needed.
        matched = qdim.select(F.col("ord").cast("bigint").alias("template_ord"),
                              F.lit(None).cast("string").alias("index"), F.col("label").alias("question"),
                              F.lit(None).cast("string").alias("clima"), F.lit(None).cast("string").alias("ife"),
                              F.lit(None).cast("double").alias("weight"),
                              F.col("question_id").alias("match_value"), F.lit("exact").alias("match_method"),
                              F.lit(None).cast("double").alias("match_score"))
    else:
        matched = match_labels(template, "question", qdim, "label", "question_id", "ord", threshold, metric)
    # Only answers to configured questions reach the join and the aggregate.
    asked = answers.filter(F.col("question_id").isin([q.question_id for q in questions]))
    scores = segment_scores(asked, respondents, ids, cohort_col, nps_col)
    out = matched.join(scores, matched["match_value"] == scores["question_id"], "left")
    extra = ["match_method", "match_score"] if diagnostics else []
    return out.select("template_ord", "index", "question", "clima", "ife", "weight",
                      F.col("match_value").alias("question_id"),
                      # A matched question without any valid answer scores 0.0, an unmatched row stays blank.
                      *[F.when(F.col("match_value").isNotNull(), or_zero(c)).alias(c) for c in SEGMENT_COLS], *extra)
