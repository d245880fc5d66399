"""Consolidated KPI report (participation, cohorts, satisfaction, NPS, scores).

Plan: respondents -> filter ids -> classify once (cohort, nps_class,
responded) -> one cuboid aggregate; answers -> one per-question aggregate.
Every metric below is arithmetic over those two small tables, so the whole
report costs one scan of each input and two tiny shuffles, whatever the
number of metrics.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.numeric import or_zero, pct, safe_ratio, scale4_to_10, zero_as_null
from ..operators.cuboid import answer_cuboid, respondent_cuboid
from ..operators.segments import filter_ids
from ..session import materialize
from ..sources.dims import COHORT_KEYS, COHORT_SLUG, Question

_VALID_NPS = ("promoter", "passive", "detractor", "unknown")


def _n_where(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0))), F.lit(0)).cast("bigint")


def _mean(prefix: str, cond: Column | None = None, scale: int = 2) -> Column:
    c = F.col(f"{prefix}_cnt")
    c = c if cond is None else F.when(cond, c)
    return or_zero(F.bround(F.try_divide(exact.total(prefix, cond), F.sum(c).cast("double")), scale))


def parse_universe(value: float | int | str | None) -> float:
    """C14: the universe size as a number; text may use a decimal comma ("1,5"); blank -> 0."""
    if value is None:
        return 0.0
    if isinstance(value, str):
        raw = value.strip()
        return float(raw.replace(",", ".")) if raw else 0.0
    return float(value)


def kpi_cube(respondents: DataFrame, ids: Iterable | None = None, cohort_col: str = "cohort_raw",
             nps_col: str = "nps_raw", response_col: str | None = None,
             satisfaction_col: str | None = "satisfaction_raw", conditions_col: str | None = None,
             id_col: str = "id") -> DataFrame:
    sel = filter_ids(respondents, ids, id_col)
    return respondent_cuboid(sel, {"sat": satisfaction_col, "cond": conditions_col}, cohort_col, nps_col,
                             response_col)


# --- single metrics (each a tiny aggregate over the cube) ----------------------

def responded_count(cube: DataFrame, universe: Column | float | None) -> DataFrame:
    """A1, A2: responses and participation % over a universe size."""
    u = F.lit(universe).cast("double") if not isinstance(universe, Column) else universe.cast("double")
    responses = _n_where(F.col("responded"))
    part = F.when(u > 0, F.bround((responses / u) * F.lit(100.0), 2)).otherwise(F.lit(0.0))
    return cube.agg(u.alias("universe"), responses.alias("responses"), or_zero(part).alias("participation"))


def _cohort_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, k) for i, k in enumerate(COHORT_KEYS)], "cohort_ord INT, cohort STRING")


def cohort_share(cube: DataFrame) -> DataFrame:
    """A3: % of all selected rows (blank cohorts included in the denominator).

    The window runs over the per-cohort aggregate (at most 5 rows), never over
    respondent rows.
    """
    per = cube.groupBy("cohort").agg(F.sum("n").alias("n_cohort"))
    per = per.withColumn("n_sel", F.sum("n_cohort").over(Window.partitionBy()))
    dim = _cohort_dim(cube.sparkSession)
    n = F.coalesce("n_cohort", F.lit(0)).cast("bigint")
    # per has at most one row per cohort of the fixed vocabulary (+ blank): broadcast it.
    return (dim.join(F.broadcast(per), "cohort", "left")
            .select("cohort_ord", "cohort", n.alias("n_cohort"),
                    pct(n, F.max("n_sel").over(Window.partitionBy())).alias("pct")))


def satisfaction_by_cohort(cube: DataFrame) -> DataFrame:
    """A4, A5: mean satisfaction (2 dp, no clipping), overall and per cohort."""
    cols = [_mean("sat").alias("satisfaction_general")]
    cols += [_mean("sat", F.col("cohort") == k).alias(f"satisfaction_{COHORT_SLUG[k]}") for k in COHORT_KEYS]
    return cube.agg(*cols)


def _nps_cols(cond: Column | None = None, prefix: str = "") -> list[Column]:
    base = F.col("nps_class").isin(*_VALID_NPS)
    c = (lambda x: x & cond) if cond is not None else (lambda x: x)
    v = _n_where(c(base))
    p = _n_where(c(F.col("nps_class") == "promoter"))
    d = _n_where(c(F.col("nps_class") == "detractor"))
    nps = F.bround(safe_ratio(p - d, v) * F.lit(100.0), 2)
    return [nps.alias(f"{prefix}nps"), p.alias(f"{prefix}promoters"), d.alias(f"{prefix}detractors"),
            v.alias(f"{prefix}nps_base")]


def nps_overall(cube: DataFrame) -> DataFrame:
    """(P - D) / V * 100, V = answered NPS rows (passives and unknown labels included)."""
    return cube.agg(*_nps_cols())


def nps_by_cohort(cube: DataFrame) -> DataFrame:
    """A10: A9 within each cohort; all four cohorts are always reported.

    One global aggregate over the cube builds a struct per configured cohort
    and ``inline`` turns them into rows. A filter or join on ``cohort`` would be
    pushed below the raw-spelling pre-aggregate (cohort is a function of a
    grouping key) and normalise every respondent row instead of each spelling.
    """
    structs = [F.struct(F.lit(i).alias("cohort_ord"), F.lit(k).alias("cohort"),
                        *_nps_cols(F.col("cohort") == F.lit(k))).alias(f"c{i}")
               for i, k in enumerate(COHORT_KEYS)]
    return cube.agg(*structs).select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(COHORT_KEYS))])))


def nps_category_pct(cube: DataFrame) -> DataFrame:
    """Class share of the answered NPS rows."""
    v = _n_where(F.col("nps_class").isin(*_VALID_NPS))
    return cube.agg(*[pct(_n_where(F.col("nps_class") == k), v).alias(f"pct_{k}") for k in ("promoter", "passive", "detractor")])


# --- answer side ---------------------------------------------------------------

def question_scores(answers: DataFrame, respondents: DataFrame | None = None, ids: Iterable | None = None,
                    id_col: str = "id") -> DataFrame:
    """A6 per question: clip to [1,4], mean, round 1, rescale to 0..10, round 1.

    With an id filter, answers are semi-joined to the selected respondents.
    """
    if ids and respondents is not None:
        keep = filter_ids(respondents, ids, id_col).select("row_ord")
        answers = answers.join(keep, "row_ord", "left_semi")
    cube = answer_cuboid(answers)
    mean4 = exact.likert_mean(F.col("s_sum"), F.col("s_cnt"))
    return cube.select("question_id", F.col("s_cnt").alias("n_valid"),
                       or_zero(scale4_to_10(mean4)).alias("score10"))


def _question_dim(spark: SparkSession, questions: Sequence[Question]) -> DataFrame:
    rows = [(i, q.question_id, q.axis) for i, q in enumerate(questions)]
    return spark.createDataFrame(rows, "q_ord INT, question_id STRING, axis STRING")


def axis_scores(qscores: DataFrame, questions: Sequence[Question]) -> DataFrame:
    """Per axis, the mean of its question scores that are > 0, round 1 (0.0 if none)."""
    dim = _question_dim(qscores.sparkSession, questions)
    # Only configured questions are kept, so the broadcast side is bounded by the config.
    mine = qscores.filter(F.col("question_id").isin([q.question_id for q in questions]))
    j = dim.join(F.broadcast(mine), "question_id", "left")
    axes = list(dict.fromkeys(q.axis for q in questions if q.axis))
    adim = qscores.sparkSession.createDataFrame([(i, a) for i, a in enumerate(axes)], "axis_ord INT, axis STRING")
    per = j.groupBy("axis").agg(F.bround(F.avg(zero_as_null("score10")), 1).alias("axis_score"))
    return adim.join(F.broadcast(per), "axis", "left").select("axis_ord", "axis",
                                                              or_zero("axis_score").alias("axis_score"))


def climate_index(axes: DataFrame) -> DataFrame:
    """Mean of the axis scores that are > 0, round 1."""
    return axes.agg(or_zero(F.bround(F.avg(zero_as_null("axis_score")), 1)).alias("climate_index"))


# --- A22: the single-row report ------------------------------------------------

def survey_kpis(respondents: DataFrame, answers: DataFrame, questions: Sequence[Question],
                universe: DataFrame | float | None = None, ids: Iterable | None = None,
                cohort_col: str = "cohort_raw", nps_col: str = "nps_raw", response_col: str | None = None,
                satisfaction_col: str | None = "satisfaction_raw", conditions_col: str | None = None,
                axis_members: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """One wide row: participation, cohort mix, satisfaction, climate index, NPS family,
    then each axis score followed by its question scores.

    ``universe`` is a number or a one-row DataFrame with a ``universe`` column
    (e.g. a count over a population table). An axis score is the mean of the
    non-zero scores of its members: ``axis_members[axis]`` when given (e.g.
    sub-component columns), else the displayed questions of that axis. The respondent-side row, the
    answer-side row and the universe row are unioned and folded with ``max``
    (each column is non-null in exactly one of them), so no join is needed.
    """
    if ids:
        # Both the respondent cube and the answer semi-join read the selection:
        # write it once so the respondents are scanned a single time.
        respondents = materialize(filter_ids(respondents, ids), "kpi-selection")
        ids = None
        answers = answers.join(respondents.select("row_ord"), "row_ord", "left_semi")
    cube = kpi_cube(respondents, ids, cohort_col, nps_col, response_col, satisfaction_col, conditions_col)
    if isinstance(universe, DataFrame):
        u_col = F.col("universe")
    else:
        u_col = F.lit(parse_universe(universe))
    responses = _n_where(F.col("responded"))
    n_sel = _n_where(F.lit(True))
    r_cols = [responses.alias("respuestas")]
    r_cols += [pct(_n_where(F.col("cohort") == k), n_sel).alias(f"pct_{COHORT_SLUG[k]}") for k in COHORT_KEYS]
    r_cols += [_mean("sat").alias("satisfaccion_general")]
    r_cols += [_mean("sat", F.col("cohort") == k).alias(f"satisfaccion_{COHORT_SLUG[k]}") for k in COHORT_KEYS]
    r_cols += [_mean("cond").alias("condiciones_trabajo")]
    r_cols += [_nps_cols()[0]]
    r_cols += [_nps_cols(F.col("cohort") == k, f"{COHORT_SLUG[k]}_")[0].alias(f"nps_{COHORT_SLUG[k]}")
               for k in COHORT_KEYS]
    v = _n_where(F.col("nps_class").isin(*_VALID_NPS))
    for k, name in (("promoter", "nps_entusiastas"), ("passive", "nps_pasivos"), ("detractor", "nps_detractores")):
        r_cols.append(pct(_n_where(F.col("nps_class") == k), v).alias(name))
    r_row = cube.agg(*r_cols)

    # Answer side in one pass: per-question scores, then one aggregate that
    # yields every question column and every axis mean (scores > 0 only).
    axes = list(axis_members) if axis_members else list(dict.fromkeys(q.axis for q in questions if q.axis))
    members = {a: list(axis_members[a]) for a in axes} if axis_members else \
        {a: [q.question_id for q in questions if q.axis == a] for a in axes}
    needed = list(dict.fromkeys([q.question_id for q in questions] + [m for a in axes for m in members[a]]))
    # Only configured columns are aggregated (the filter reaches the scan side).
    qs = question_scores(answers.filter(F.col("question_id").isin(needed)), respondents, ids)
    qid = F.col("question_id")
    q_cols = [F.max(F.when(qid == q.question_id, F.col("score10"))).alias(f"q_{q.question_id}") for q in questions]
    q_cols += [F.bround(F.avg(F.when(qid.isin(members[a]), zero_as_null("score10"))), 1).alias(f"axis_{a}")
               for a in axes]
    q_row = qs.agg(*q_cols)
    # Climate index: mean of the non-zero axis scores, from the axis columns of the row.
    valid = [F.when(F.col(f"axis_{a}") > 0, F.col(f"axis_{a}")) for a in axes]
    if valid:
        total = F.lit(0.0)
        count = F.lit(0)
        for v in valid:
            total = total + F.coalesce(v, F.lit(0.0))
            count = count + v.isNotNull().cast("int")
        q_row = q_row.withColumn("indice_clima", F.bround(F.try_divide(total, count.cast("double")), 1))
    else:
        q_row = q_row.withColumn("indice_clima", F.lit(0.0))

    parts = [r_row, q_row]
    if isinstance(universe, DataFrame):
        parts.append(universe.select(u_col.cast("double").alias("total_personas")))
    folded_cols = [c for p in parts for c in p.columns]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    row = u.agg(*[F.max(c).alias(c) for c in folded_cols])
    if not isinstance(universe, DataFrame):
        row = row.withColumn("total_personas", u_col.cast("double"))

    total = F.col("total_personas")
    participation = or_zero(F.when(total > 0, F.bround((F.col("respuestas") / total) * F.lit(100.0), 2)))
    order: list[Column] = [
        total.alias("total_personas"), F.coalesce("respuestas", F.lit(0)).cast("bigint").alias("respuestas"),
        participation.alias("pct_participacion"),
        *[or_zero(f"pct_{COHORT_SLUG[k]}").alias(f"pct_{COHORT_SLUG[k]}") for k in COHORT_KEYS],
        or_zero("satisfaccion_general").alias("satisfaccion_general"),
        *[or_zero(f"satisfaccion_{COHORT_SLUG[k]}").alias(f"satisfaccion_{COHORT_SLUG[k]}") for k in COHORT_KEYS],
        F.lit("").alias("covid"),
        or_zero("condiciones_trabajo").alias("condiciones_trabajo"),
        or_zero("indice_clima").alias("indice_clima"),
        or_zero("nps").alias("nps"),
        *[or_zero(f"nps_{COHORT_SLUG[k]}").alias(f"nps_{COHORT_SLUG[k]}") for k in COHORT_KEYS],
        *[or_zero(c).alias(c) for c in ("nps_entusiastas", "nps_pasivos", "nps_detractores")],
    ]
    for a in axes:
        order.append(or_zero(f"axis_{a}").alias(f"axis_{a}"))
        order += [or_zero(f"q_{q.question_id}").alias(f"q_{q.question_id}") for q in questions if q.axis == a]
    order += [or_zero(f"q_{q.question_id}").alias(f"q_{q.question_id}") for q in questions if not q.axis]
    return row.select(*order)
