"""DuckDB SQL oracles for the registered queries.

Written independently of the Spark plans, straight from the report
definitions, over the pre-registered base tables. ``round_even`` is DuckDB's
banker's rounding (the Spark side uses ``bround``).
"""

from __future__ import annotations

from .catalog import ID_FILTER_IDS
from .sources.fixtures import FIXTURE_QUESTIONS, with_views
from .sources.layout import AXES as SHEET_AXES
from .sources.layout import QUESTION_LABELS
from .sources.letters import letter_range

# Empty-like tokens, NPS class and cohort spellings.
EMPTY = "('', 'nan', 'none', 'na', 'n/a', 'n\\a', '-', '–', '--', 's/d', 'sd')"
PROM = "('entusiasta', 'entusiastas', 'promotor', 'promotores', 'promoter', 'promoters')"
PAS = "('pasivo', 'pasivos', 'neutral', 'neutrales', 'indiferente', 'indiferentes')"
DET = "('detractor', 'detractores')"
COHORTS = [
    ("centenialls", "('centenialls', 'centennials', 'centennial', 'centenials', 'centenial', 'generacion z', 'gen z', 'z')"),
    ("milenialls", "('milenialls', 'millennials', 'millenials', 'millennial', 'millenial', 'generacion y', 'gen y', 'y')"),
    ("generacion x", "('generacion x', 'gen x', 'x')"),
    ("baby boomers", "('baby boomers', 'baby boomer', 'babyboomers', 'babyboomer', 'boomers', 'boomer')"),
]
SLUG = {"centenialls": "centenialls", "milenialls": "milenialls", "generacion x": "generacion_x",
        "baby boomers": "baby_boomers"}


def norm(x: str) -> str:
    return f"lower(trim(regexp_replace(strip_accents({x}), '\\s+', ' ', 'g')))"


def num(x: str) -> str:
    # Independent of the engine's pattern: only characters of a number, and the parser must take the whole text.
    t = f"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"
    return f"(CASE WHEN {t} <> '' AND translate({t}, '0123456789+-.eE', '') = '' THEN TRY_CAST({t} AS DOUBLE) END)"


def clip(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 1 THEN 1.0 WHEN {x} > 4 THEN 4.0 ELSE {x} END)"


def conv10(mean4: str) -> str:
    return f"round_even((round_even({mean4}, 1) - 1.0::DOUBLE) * (10.0::DOUBLE / 3.0::DOUBLE), 1)"


def pct(n: str, d: str) -> str:
    return f"COALESCE(round_even((CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0)) * 100.0::DOUBLE, 2), 0.0)"


def _cohort_case(x: str) -> str:
    whens = " ".join(f"WHEN {norm(x)} IN {vs} THEN '{k}'" for k, vs in COHORTS)
    return f"CASE {whens} END"


def _responded(x: str) -> str:
    s = f"lower(trim(regexp_replace({x}, '[\\t\\r\\n\\x{{a0}}]', ' ', 'g')))"
    return f"COALESCE(({s} NOT IN {EMPTY}) AND regexp_matches({s}, '[0-9a-zA-Z]'), false)"


SEG_CTE = f"""seg AS (
  SELECT r.*, {_cohort_case('r.cohort_raw')} AS cohort,
    CASE WHEN {norm('r.nps_raw')} IN {PROM} THEN 'promoter'
         WHEN {norm('r.nps_raw')} IN {PAS} THEN 'passive'
         WHEN {norm('r.nps_raw')} IN {DET} THEN 'detractor'
         WHEN {norm('r.nps_raw')} NOT IN {EMPTY} AND regexp_matches({norm('r.nps_raw')}, '[0-9a-zA-Z]') THEN 'unknown'
         ELSE 'empty' END AS nps_class,
    {_responded('r.nps_raw')} AS responded,
    {num('r.satisfaction_raw')} AS sat
  FROM respondents r)"""

COHORT_VALUES = "(VALUES " + ", ".join(f"({i}, '{k}')" for i, (k, _) in enumerate(COHORTS)) + ") AS d(cohort_ord, cohort)"


VALID = "nps_class IN ('promoter', 'passive', 'detractor', 'unknown')"


def _nps_expr(cond: str = "TRUE") -> str:
    v = f"count_if({VALID} AND {cond})"
    p = f"count_if(nps_class = 'promoter' AND {cond})"
    d = f"count_if(nps_class = 'detractor' AND {cond})"
    return f"COALESCE(round_even((CAST({p} - {d} AS DOUBLE) / NULLIF(CAST({v} AS DOUBLE), 0)) * 100.0::DOUBLE, 2), 0.0)"


def _ids_sql() -> str:
    return "(" + ", ".join("'" + s.strip() + "'" for s in ID_FILTER_IDS) + ")"


def _answers_q(where_ids: bool = False) -> str:
    flt = ""
    if where_ids:
        flt = f" WHERE a.row_ord IN (SELECT row_ord FROM respondents WHERE trim(id) IN {_ids_sql()})"
    return f"""qs AS (
  SELECT question_id, CAST(count(s) AS BIGINT) AS n_valid,
         COALESCE({conv10('avg(s)')}, 0.0) AS score10
  FROM (SELECT a.question_id, {clip(num('a.score_raw'))} AS s FROM answers a{flt}) t
  GROUP BY question_id)"""


QDIM = "(VALUES " + ", ".join(f"({i}, '{q.question_id}', '{q.axis}')" for i, q in enumerate(FIXTURE_QUESTIONS)) + \
    ") AS qd(q_ord, question_id, axis)"
AXES = list(dict.fromkeys(q.axis for q in FIXTURE_QUESTIONS))
ADIM = "(VALUES " + ", ".join(f"({i}, '{a}')" for i, a in enumerate(AXES)) + ") AS ad(axis_ord, axis)"
AXES_CTE = f"""ax AS (
  SELECT ad.axis_ord, ad.axis, COALESCE(x.axis_score, 0.0) AS axis_score
  FROM {ADIM} LEFT JOIN (
    SELECT qd.axis, round_even(avg(NULLIF(qs.score10, 0.0)), 1) AS axis_score
    FROM {QDIM} LEFT JOIN qs ON qd.question_id = qs.question_id GROUP BY qd.axis) x ON ad.axis = x.axis)"""


def _kpis_sql(with_ids: bool) -> str:
    where = f"trim(r.id) IN {_ids_sql()}" if with_ids else ""
    r_cols = ["CAST(count_if(responded) AS BIGINT) AS respuestas"]
    r_cols += [f"{pct(f'count_if(cohort = {chr(39)}{k}{chr(39)})', 'count(*)')} AS pct_{SLUG[k]}" for k, _ in COHORTS]
    r_cols += ["COALESCE(round_even(avg(sat), 2), 0.0) AS satisfaccion_general"]
    r_cols += [f"COALESCE(round_even(avg(sat) FILTER (WHERE cohort = '{k}'), 2), 0.0) AS satisfaccion_{SLUG[k]}"
               for k, _ in COHORTS]
    r_cols += [f"{_nps_expr()} AS nps"]
    r_cols += [f"{_nps_expr(f'cohort = {chr(39)}{k}{chr(39)}')} AS nps_{SLUG[k]}" for k, _ in COHORTS]
    for cls, name in (("promoter", "nps_entusiastas"), ("passive", "nps_pasivos"), ("detractor", "nps_detractores")):
        r_cols.append(f"{pct(f'count_if(nps_class = {chr(39)}{cls}{chr(39)})', f'count_if({VALID})')} AS {name}")
    q_cols = [f"COALESCE(max(score10) FILTER (WHERE question_id = '{q.question_id}'), 0.0) AS q_{q.question_id}"
              for q in FIXTURE_QUESTIONS]
    a_cols = [f"COALESCE(max(axis_score) FILTER (WHERE axis = '{a}'), 0.0) AS axis_{a}" for a in AXES]
    a_cols.append("COALESCE(round_even(avg(NULLIF(axis_score, 0.0)), 1), 0.0) AS indice_clima")
    order = ["total_personas", "respuestas",
             "COALESCE(CASE WHEN total_personas > 0 THEN round_even((respuestas / total_personas) * 100.0::DOUBLE, 2) END, 0.0) AS pct_participacion"]
    order += [f"pct_{SLUG[k]}" for k, _ in COHORTS] + ["satisfaccion_general"]
    order += [f"satisfaccion_{SLUG[k]}" for k, _ in COHORTS]
    order += ["'' AS covid", "0.0::DOUBLE AS condiciones_trabajo", "indice_clima", "nps"]
    order += [f"nps_{SLUG[k]}" for k, _ in COHORTS] + ["nps_entusiastas", "nps_pasivos", "nps_detractores"]
    for a in AXES:
        order.append(f"axis_{a}")
        order += [f"q_{q.question_id}" for q in FIXTURE_QUESTIONS if q.axis == a]
    seg = SEG_CTE if not where else SEG_CTE.replace("FROM respondents r)", f"FROM respondents r WHERE {where})")
    return (with_views("", "respondents", "answers").rstrip() + ",\n" + seg + ",\n" + _answers_q(with_ids) + ",\n"
            + AXES_CTE + f""",
rr AS (SELECT {', '.join(r_cols)} FROM seg),
qq AS (SELECT {', '.join(q_cols)} FROM qs),
aa AS (SELECT {', '.join(a_cols)} FROM ax),
uu AS (SELECT CAST(count(*) AS DOUBLE) AS total_personas FROM orders)
SELECT {', '.join(order)} FROM rr, qq, aa, uu""")


def _sql() -> dict[str, str]:
    resp = with_views("", "respondents").rstrip() + ",\n" + SEG_CTE + "\n"
    ans = with_views("", "answers").rstrip() + ",\n" + _answers_q() + "\n"
    q = {}
    q["nps_overall"] = resp + f"""SELECT {_nps_expr()} AS nps,
  CAST(count_if(nps_class = 'promoter') AS BIGINT) AS promoters,
  CAST(count_if(nps_class = 'detractor') AS BIGINT) AS detractors,
  CAST(count_if({VALID}) AS BIGINT) AS nps_base FROM seg"""
    q["nps_by_cohort"] = resp + f"""SELECT d.cohort_ord, d.cohort, COALESCE(a.nps, 0.0) AS nps,
  CAST(COALESCE(a.promoters, 0) AS BIGINT) AS promoters, CAST(COALESCE(a.detractors, 0) AS BIGINT) AS detractors,
  CAST(COALESCE(a.nps_base, 0) AS BIGINT) AS nps_base
FROM {COHORT_VALUES} LEFT JOIN (
  SELECT cohort, {_nps_expr()} AS nps, count_if(nps_class = 'promoter') AS promoters,
         count_if(nps_class = 'detractor') AS detractors, count_if({VALID}) AS nps_base
  FROM seg WHERE cohort IS NOT NULL GROUP BY cohort) a ON d.cohort = a.cohort"""
    q["nps_category_pct"] = resp + "SELECT " + ", ".join(
        f"{pct(f'count_if(nps_class = {chr(39)}{k}{chr(39)})', f'count_if({VALID})')} AS pct_{k}"
        for k in ("promoter", "passive", "detractor")) + " FROM seg"
    q["cohort_share"] = resp + f"""SELECT d.cohort_ord, d.cohort, CAST(COALESCE(a.n, 0) AS BIGINT) AS n_cohort,
  {pct('COALESCE(a.n, 0)', '(SELECT count(*) FROM seg)')} AS pct
FROM {COHORT_VALUES} LEFT JOIN (SELECT cohort, count(*) AS n FROM seg GROUP BY cohort) a ON d.cohort = a.cohort"""
    q["satisfaction_by_cohort"] = resp + "SELECT COALESCE(round_even(avg(sat), 2), 0.0) AS satisfaction_general, " + \
        ", ".join(f"COALESCE(round_even(avg(sat) FILTER (WHERE cohort = '{k}'), 2), 0.0) AS satisfaction_{SLUG[k]}"
                  for k, _ in COHORTS) + " FROM seg"
    q["responded_count"] = resp + f"""SELECT CAST(count_if(responded) AS BIGINT) AS responses,
  (SELECT CAST(count(*) AS DOUBLE) FROM orders) AS universe,
  COALESCE(round_even((count_if(responded) / (SELECT CAST(count(*) AS DOUBLE) FROM orders)) * 100.0::DOUBLE, 2), 0.0) AS participation
FROM seg"""
    q["question_scores"] = ans + "SELECT question_id, n_valid, score10 FROM qs"
    q["axis_scores"] = ans.rstrip() + ",\n" + AXES_CTE + "\nSELECT axis_ord, axis, axis_score FROM ax"
    q["climate_index"] = ans.rstrip() + ",\n" + AXES_CTE + \
        "\nSELECT COALESCE(round_even(avg(NULLIF(axis_score, 0.0)), 1), 0.0) AS climate_index FROM ax"
    q["survey_kpis"] = _kpis_sql(False)
    q["survey_kpis_by_id"] = _kpis_sql(True)
    q.update(_matrix_and_matching())
    q["hierarchy_rollup"] = _hierarchy_sql()
    q.update(_demographics_sql())
    q["report_roundtrip"] = q["sheet_demographics"] = q["demographic_report"]
    q["demographic_mapped"] = q["demographic_report"].replace("w1.display_raw AS variable", "w1.label AS variable")
    q["hierarchy_mapped"] = q["hierarchy_rollup"]
    q.update(_misc_sql())
    q.update(_files_sql())
    q["label_match_many"] = _match_many_sql()
    return q


def _misc_sql() -> dict[str, str]:
    resp = with_views("", "respondents").rstrip() + "\n"
    ans = with_views("", "answers").rstrip() + "\n"
    q = {}
    q["id_filter"] = resp + f"SELECT row_ord, id, cohort_raw, nps_raw FROM respondents WHERE trim(id) IN {_ids_sql()}"
    q["id_filter_semi"] = resp + """SELECT row_ord, id FROM respondents WHERE trim(id) IN (
  SELECT trim(CAST(c_custkey AS VARCHAR)) FROM customer WHERE c_mktsegment = 'BUILDING')"""
    q["row_nonblank"] = resp + """SELECT (cohort_raw IS NOT NULL OR nps_raw IS NOT NULL) AS nonblank, count(*) AS n
FROM respondents GROUP BY 1"""
    q["label_normalize"] = resp + f""", v AS (
  SELECT DISTINCT raw FROM (SELECT unnest([cohort_raw, nps_raw, dem_segment_raw, dem_status_raw]) AS raw FROM respondents) t
  WHERE raw IS NOT NULL)
SELECT raw, {norm('raw')} AS norm, {loose('raw')} AS norm_loose, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS ws,
  regexp_replace(raw, '^[0-9][^ ]* ', '') AS no_prefix, {_responded('raw')} AS answered,
  COALESCE({norm('raw')} NOT IN {EMPTY} AND regexp_matches({norm('raw')}, '[0-9a-zA-Z]'), false) AS answered_label,
  COALESCE({norm('raw')} NOT IN {EMPTY}, false) AS nonempty
FROM v"""
    q["label_normalize"] = q["label_normalize"].replace("\n, v AS (", ",\nv AS (")
    q["text_normalize"] = f"""SELECT doc_id, {norm('text')} AS norm, {loose('text')} AS norm_loose
FROM documents"""
    q["number_forms"] = f"""WITH f AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice, [q, q || ',5', '  ' || q || '.25 ', q || '.5d', q || 'e2', '-' || q || 'E-1',
    'inf', 'NaN', 'true', '', '+.' || q, q || '.'][CAST(l_orderkey % 12 AS INTEGER) + 1] AS raw
  FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem))
SELECT l_orderkey, l_linenumber, raw, {num('raw')} AS num, {num("replace(raw, ',', '.')")} AS num_comma,
  printf('%.3f', l_extendedprice) AS price_text FROM f"""
    q["report_publish"] = _demographics_sql()["demographic_counts"].rsplit("SELECT grupo, label", 1)[0] + """
SELECT m.mode, m.reports, (SELECT count(*) FROM ord) AS n_rows
FROM (VALUES ('keep-others 0', 'comentarios,consolidado,demografia'), ('only 0', 'demografia'),
  ('keep-others 2', 'consolidado,demografia')) AS m(mode, reports)"""
    q["report_versions"] = _demographics_sql()["demographic_counts"].rsplit("SELECT grupo, label", 1)[0] + """
SELECT 'consolidado' AS report, 0::BIGINT AS n_rows UNION ALL SELECT 'demografia', count(*) FROM ord WHERE grupo = 'SEGMENT'
UNION ALL SELECT 'indice_clima', count(DISTINCT grupo) FROM ord"""
    q.update(_sheet_sql())
    q["numeric_coerce_clip"] = ans + f"""SELECT score_raw, {num('score_raw')} AS num, {clip(num('score_raw'))} AS clipped,
  count(*) AS n FROM answers GROUP BY score_raw"""
    q["scale_convert"] = ans + f"""SELECT question_id, avg(s) AS mean4, round_even(avg(s), 1) AS mean4_r1, {conv10('avg(s)')} AS score10
FROM (SELECT question_id, {clip(num('score_raw'))} AS s FROM answers) t GROUP BY question_id"""
    q["positional_select"] = resp + """SELECT CAST(row_ord AS VARCHAR) AS row_ord, id, cohort_raw AS generacion,
  nps_raw AS tipo_nps, satisfaction_raw AS satisfaccion, CAST(NULL AS VARCHAR) AS fuera_de_rango FROM respondents"""
    comments = """SELECT CAST(d.doc_id AS VARCHAR) AS id, d.lang AS variable_1, d.source AS variable_2,
  CAST(l.quality AS VARCHAR) AS variable_3, CAST(l.toxic AS VARCHAR) AS tipo_nps, '' AS generacion,
  CAST(d.n_chars AS VARCHAR) AS antiguedad, '' AS tipo_contrato, d.text AS comentarios
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
    q["comments_projection"] = comments
    q["comments_by_id"] = comments + " WHERE trim(CAST(d.doc_id AS VARCHAR)) IN (SELECT trim(CAST(doc_id AS VARCHAR)) FROM labels WHERE toxic = 1)"
    return q


def _files_sql() -> dict[str, str]:
    """What was written is what is read."""
    return {
        "sheet_csv_read": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal FROM customer",
        "sheet_csv_rejects": """SELECT CASE WHEN c_custkey % 2 = 0 THEN 'quotes' ELSE 'cells' END AS reason, count(*) AS n,
  CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer WHERE c_custkey % 97 = 0 GROUP BY 1""",
        "sheet_row_ordinal": """SELECT fmt, row_number() OVER (PARTITION BY fmt ORDER BY o_orderkey) - 1 AS row_ord, o_orderkey
FROM orders, (VALUES ('csv'), ('parquet')) f(fmt)""",
        "demographic_free_text": """
WITH few AS (SELECT o_orderpriority AS label, count(*) AS general, min(o_orderkey) AS first_seen FROM orders GROUP BY 1),
many AS (SELECT concat_ws(' ', 'pedido', CAST(o_orderkey AS VARCHAR), o_orderpriority) AS label, 1 AS general, o_orderkey AS first_seen FROM orders)
SELECT CAST(row_number() OVER (ORDER BY grupo, first_seen) - 1 AS BIGINT) AS index, grupo, label, CAST(general AS BIGINT) AS general, first_seen
FROM (SELECT 'FEW' AS grupo, * FROM few UNION ALL SELECT 'MANY', * FROM many)""",
    }


def _match_many_sql() -> str:
    """Every wanted name against every key, by the measure itself."""
    return f"""
WITH names AS (SELECT s_suppkey, concat_ws(' ', s_name, n_name) AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
w AS (SELECT s_suppkey, concat(substr(name, 1, CAST(s_suppkey % 20 AS INT)), substr(name, CAST(s_suppkey % 20 AS INT) + 2)) AS wanted FROM names),
keys AS (SELECT {loose('name')} AS nk, min(s_suppkey) AS o, max(s_suppkey) AS v FROM names GROUP BY 1),
p AS (SELECT s_suppkey, wanted, {loose('wanted')} AS probe FROM w),
early AS (SELECT p.*, coalesce(e.v, n.v) AS v, CASE WHEN e.v IS NOT NULL THEN 'exact' WHEN n.v IS NOT NULL THEN 'normalized' END AS method
  FROM p LEFT JOIN (SELECT name, max(s_suppkey) AS v FROM names GROUP BY 1) e ON e.name = wanted LEFT JOIN keys n ON n.nk = probe),
scored AS (SELECT s_suppkey, k.o, k.v, 1.0::DOUBLE - levenshtein(probe, k.nk)::DOUBLE / greatest(length(probe), length(k.nk)) AS s
  FROM early JOIN keys k ON early.method IS NULL AND abs(length(probe) - length(k.nk)) <= 3),
best AS (SELECT * FROM scored WHERE s >= 0.95 QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY s DESC, o) = 1)
SELECT early.s_suppkey, wanted, CAST(coalesce(early.v, best.v) AS VARCHAR) AS match_value,
  CASE WHEN method IS NOT NULL THEN method WHEN best.v IS NOT NULL THEN 'fuzzy' END AS match_method, best.s AS match_score
FROM early LEFT JOIN best USING (s_suppkey)"""


def _sheet_sql() -> dict[str, str]:
    """The wide sheet: one cell per row and question (its smallest text); Q1..Q7 stand at AL..AR and, again, at
    the sub-components IC..IF (axis IB) and IH..IJ (axis IG)."""
    cells = "cells AS (SELECT row_ord, question_id, min(score_raw) AS score_raw FROM answers GROUP BY row_ord, question_id)"
    letters = {letter: f"Q{i}" for i, letter in enumerate(("AL", "AM", "AN", "AO", "AP", "AQ", "AR"), 1)}
    segs = ["TRUE", "cohort = 'baby boomers'", "cohort = 'generacion x'", "cohort = 'milenialls'", "cohort = 'centenialls'",
            "nps_class = 'promoter'", "nps_class = 'passive'", "nps_class = 'detractor'"]
    names = ["general", "boomers", "generacion_x", "milenialls", "centenialls", "entusiastas", "pasivos", "detractores"]
    rows = ", ".join(f"({i}, '{letter}', {_q(label)}, {_q(letters[letter]) if letter in letters else 'NULL'})"
                     for i, (letter, label) in enumerate(QUESTION_LABELS))
    base = with_views("", "respondents", "answers").rstrip() + f",\n{cells},\n{SEG_CTE}"
    scores = ", ".join(f"COALESCE({conv10(f'avg(s) FILTER (WHERE {w})')}, 0.0) AS {n}" for n, w in zip(names, segs))
    matrix = base + f""",
sc AS (SELECT c.question_id, {scores}
  FROM (SELECT row_ord, question_id, {clip(num('score_raw'))} AS s FROM cells) c JOIN seg ON c.row_ord = seg.row_ord GROUP BY c.question_id)
SELECT CAST(t.ord AS BIGINT) AS template_ord, CAST(NULL AS VARCHAR) AS index, t.label AS question, CAST(NULL AS VARCHAR) AS clima,
  CAST(NULL AS VARCHAR) AS ife, CAST(NULL AS DOUBLE) AS weight, t.letter AS question_id,
  {', '.join(f'COALESCE(sc.{n}, 0.0) AS {n}' for n in names)}
FROM (VALUES {rows}) AS t(ord, letter, label, qid) LEFT JOIN sc ON sc.question_id = t.qid"""
    kpis = _kpis_sql(False).replace("FROM answers a)", "FROM cells a)").replace(",\nqs AS (", f",\n{cells},\nqs AS (", 1)
    head = kpis[:kpis.index("qq AS (")]
    score = lambda q: f"COALESCE(max(score10) FILTER (WHERE question_id = '{q}'), 0.0)"
    axis = lambda qs: f"COALESCE(round_even(avg(NULLIF(score10, 0.0)) FILTER (WHERE question_id IN ({qs})), 1), 0.0)"
    members = {"IB": "'Q1', 'Q2', 'Q3', 'Q4'", "IG": "'Q5', 'Q6', 'Q7'"}
    cols = []
    for a, _, (first, last) in SHEET_AXES:
        cols.append(f"{'axis_' + a if a in members else '0.0::DOUBLE'} AS axis_{a}")
        cols += [f"{'q_' + x if x in letters else '0.0::DOUBLE'} AS q_{x}" for x in letter_range(first, last)]
    keep = ["total_personas", "respuestas",
            "COALESCE(CASE WHEN total_personas > 0 THEN round_even((respuestas / total_personas) * 100.0::DOUBLE, 2) END, 0.0) AS pct_participacion"]
    keep += [f"pct_{SLUG[k]}" for k, _ in COHORTS] + ["satisfaccion_general"] + [f"satisfaccion_{SLUG[k]}" for k, _ in COHORTS]
    keep += ["'' AS covid", "satisfaccion_general AS condiciones_trabajo",
             "COALESCE(round_even((axis_IB + axis_IG) / 2, 1), 0.0) AS indice_clima", "nps"]
    keep += [f"nps_{SLUG[k]}" for k, _ in COHORTS] + ["nps_entusiastas", "nps_pasivos", "nps_detractores"] + cols
    return {"sheet_question_matrix": matrix, "sheet_kpis": head + f"""qq AS (SELECT {', '.join(f'{score(q)} AS q_{x}' for x, q in letters.items())},
  {', '.join(f'{axis(m)} AS axis_{a}' for a, m in members.items())} FROM qs),
uu AS (SELECT CAST(count(*) AS DOUBLE) AS total_personas FROM orders)
SELECT {', '.join(keep)} FROM rr, qq, uu"""}


def _demographics_sql() -> dict[str, str]:
    """Fixture groups: SEGMENT (ordered, normalise map), STATUS (no order), '?' column skipped."""
    order0 = ["0 Automobile", "1 Building", "2 Furniture", "3 Household"]
    in_order = "(" + ", ".join(_q(x) for x in order0) + ")"
    auto = " ".join(f"WHEN {norm('l1')} = '{x.split(' ', 1)[1].lower()}' THEN {_q(x)}" for x in order0)
    pos = " ".join(f"WHEN {_q(x)} THEN {i}" for i, x in enumerate(order0))
    chain = with_views("", "respondents").rstrip() + f""",
long AS (SELECT row_ord, nps_raw, 0 AS group_ord, dem_segment_raw AS raw FROM respondents
         UNION ALL SELECT row_ord, nps_raw, 1 AS group_ord, dem_status_raw AS raw FROM respondents),
l1 AS (SELECT *, CASE WHEN group_ord = 0 AND {norm('raw')} = 'building' THEN '1 Building' ELSE raw END AS l1 FROM long),
lab AS (SELECT *, CASE WHEN group_ord = 0 THEN (CASE WHEN l1 IN {in_order} THEN l1 {auto} ELSE l1 END) ELSE l1 END AS label,
          CASE WHEN {norm('nps_raw')} IN {DET} THEN 'D' WHEN {norm('nps_raw')} IN {PAS} THEN 'P'
               WHEN {norm('nps_raw')} IN {PROM} THEN 'E' END AS c
        FROM l1),
rawfirst AS (SELECT group_ord, raw, min(row_ord) AS raw_first FROM long GROUP BY group_ord, raw),
valid AS (SELECT * FROM lab WHERE {norm('label')} NOT IN {EMPTY}),
per_raw AS (SELECT group_ord, label, raw, count(*) AS n_raw, min(row_ord) AS first_raw,
              count_if(c = 'D') AS d, count_if(c = 'P') AS p, count_if(c = 'E') AS e
            FROM valid GROUP BY group_ord, label, raw),
disp AS (SELECT group_ord, label, raw AS display_raw FROM (
           SELECT *, row_number() OVER (PARTITION BY group_ord, label ORDER BY n_raw DESC, first_raw) AS rn
           FROM per_raw) t WHERE rn = 1),
per_label AS (SELECT group_ord, label, sum(n_raw) AS general, min(first_raw) AS first_seen,
                sum(d) AS detractores, sum(p) AS pasivos, sum(e) AS entusiastas
              FROM per_raw GROUP BY group_ord, label),
g AS (SELECT count(*) AS global_nps FROM respondents WHERE {norm('nps_raw')} NOT IN {EMPTY}),
ord AS (SELECT pl.*, d.display_raw,
          CASE WHEN pl.group_ord = 0 THEN COALESCE(CASE pl.label {pos} END, 4)
               ELSE COALESCE(rf.raw_first, 4611686018427387904) END AS order_idx,
          CASE pl.group_ord WHEN 0 THEN 'SEGMENT' ELSE 'STATUS' END AS grupo,
          sum(pl.general) OVER (PARTITION BY pl.group_ord) AS group_total, g.global_nps
        FROM per_label pl JOIN disp d ON pl.group_ord = d.group_ord AND pl.label = d.label
        LEFT JOIN rawfirst rf ON rf.group_ord = pl.group_ord AND rf.raw = pl.label, g),
idx AS (SELECT *, CAST(row_number() OVER (ORDER BY group_ord, order_idx, general DESC, first_seen) - 1 AS BIGINT) AS index
        FROM ord),
sh AS (SELECT *, COALESCE(round_even(detractores / CAST(global_nps AS DOUBLE), 2), 0.0) AS pct_detractores,
          COALESCE(round_even(pasivos / CAST(global_nps AS DOUBLE), 2), 0.0) AS pct_pasivos,
          COALESCE(round_even(entusiastas / CAST(global_nps AS DOUBLE), 2), 0.0) AS pct_entusiastas FROM idx),
w1a AS (SELECT *, (general * 10000) // group_total AS fl, (general * 10000) % group_total AS rem FROM sh),
w1b AS (SELECT *, 10000 - sum(fl) OVER (PARTITION BY group_ord) AS need,
          row_number() OVER (PARTITION BY group_ord ORDER BY rem DESC, index) AS rk FROM w1a),
w1 AS (SELECT *, (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) / 10000.0::DOUBLE AS pct FROM w1b),
m AS (SELECT group_ord, index, 0 AS m_ord, CAST(round_even(pct_detractores * 100.0::DOUBLE, 0) AS BIGINT) AS h FROM sh
      UNION ALL SELECT group_ord, index, 1, CAST(round_even(pct_pasivos * 100.0::DOUBLE, 0) AS BIGINT) FROM sh
      UNION ALL SELECT group_ord, index, 2, CAST(round_even(pct_entusiastas * 100.0::DOUBLE, 0) AS BIGINT) FROM sh),
m2 AS (SELECT *, sum(h) OVER (PARTITION BY group_ord) AS tot FROM m),
m3 AS (SELECT *, CASE WHEN tot > 0 THEN (h * 100) // tot END AS fl,
          CASE WHEN tot > 0 THEN (h * 100) % tot END AS rem FROM m2),
m4 AS (SELECT *, 100 - sum(fl) OVER (PARTITION BY group_ord) AS need,
          row_number() OVER (PARTITION BY group_ord ORDER BY rem DESC, index, m_ord) AS rk FROM m3),
m5 AS (SELECT group_ord, index, m_ord,
          CASE WHEN tot > 0 THEN (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) / 100.0::DOUBLE END AS v FROM m4),
w2 AS (SELECT group_ord, index,
          COALESCE(max(v) FILTER (WHERE m_ord = 0), 0.0) AS pct_detractores,
          COALESCE(max(v) FILTER (WHERE m_ord = 1), 0.0) AS pct_pasivos,
          COALESCE(max(v) FILTER (WHERE m_ord = 2), 0.0) AS pct_entusiastas FROM m5 GROUP BY group_ord, index)
"""
    strip = "regexp_replace(label, '^[0-9][^ ]* ', '')"
    return {
        "demographic_counts": chain + """SELECT grupo, label, CAST(general AS BIGINT) AS general,
  CAST(group_total AS BIGINT) AS group_total, round_even(general / CAST(group_total AS DOUBLE), 6) AS share FROM ord""",
        "demographic_nps": chain + """SELECT grupo, label, CAST(detractores AS BIGINT) AS detractores,
  CAST(pasivos AS BIGINT) AS pasivos, CAST(entusiastas AS BIGINT) AS entusiastas, CAST(global_nps AS BIGINT) AS global_nps,
  pct_detractores, pct_pasivos, pct_entusiastas FROM sh""",
        "demographic_display": chain + f"""SELECT grupo, label, COALESCE(display_raw, {strip}) AS variable,
  {strip} AS variable_no_prefix, first_seen FROM ord""",
        "share_apportioned": chain + "SELECT grupo, label, index, pct FROM w1",
        "nps_share_apportioned": chain + """SELECT sh.grupo, sh.label, sh.index, w2.pct_detractores, w2.pct_pasivos,
  w2.pct_entusiastas FROM sh JOIN w2 ON sh.group_ord = w2.group_ord AND sh.index = w2.index""",
        "demographic_report": chain + """SELECT w1.index, w1.display_raw AS variable, CAST(w1.general AS BIGINT) AS general,
  w1.pct, CAST(w1.detractores AS BIGINT) AS detractores, CAST(w1.pasivos AS BIGINT) AS pasivos,
  CAST(w1.entusiastas AS BIGINT) AS entusiastas, w2.pct_detractores, w2.pct_pasivos, w2.pct_entusiastas, w1.grupo
  FROM w1 JOIN w2 ON w1.group_ord = w2.group_ord AND w1.index = w2.index""",
    }


def _hierarchy_sql() -> str:
    """Fixture tree: Index -> A1 (Q1, Q2), A2 (Q3, Q4), A3 (Q5, Q6, Q7); one CTE per level."""
    return with_views("", "answers").rstrip() + f""",
cm AS (SELECT lower(question_id) AS col, sum(s) / count(s) AS col_mean
       FROM (SELECT question_id, {clip(num('score_raw'))} AS s FROM answers) t
       GROUP BY question_id HAVING count(s) > 0),
own_edges AS (SELECT * FROM (VALUES ('Index', 'q1'), ('A1', 'q1'), ('A1', 'q2'), ('Q1', 'q1'), ('Q2', 'q2'),
    ('A2', 'q3'), ('A2', 'q4'), ('Q3', 'q3'), ('Q4', 'q4'), ('A3', 'q5'), ('A3', 'q6'), ('A3', 'q7'),
    ('Q5', 'q5'), ('Q6', 'q6'), ('Q7', 'q7')) AS e(label, col)),
own AS (SELECT e.label, avg(cm.col_mean) AS r FROM own_edges e JOIN cm ON e.col = cm.col GROUP BY e.label),
own_s AS (SELECT label, COALESCE(r, 0.0) AS real, COALESCE(round_even(r, 1), 0.0) AS e4,
          COALESCE({conv10('round_even(r, 1)')}, 0.0) AS e10 FROM own),
l0 AS (SELECT * FROM own_s WHERE label IN ('Q1', 'Q2', 'Q3', 'Q4', 'Q5', 'Q6', 'Q7')),
e1 AS (SELECT * FROM (VALUES ('A1', 'Q1'), ('A1', 'Q2'), ('A2', 'Q3'), ('A2', 'Q4'),
    ('A3', 'Q5'), ('A3', 'Q6'), ('A3', 'Q7')) AS t(parent, child)),
g1 AS (SELECT e1.parent AS label, avg(NULLIF(l0.real, 0.0)) AS cr, avg(NULLIF(l0.e4, 0.0)) AS c4,
       avg(NULLIF(l0.e10, 0.0)) AS c10 FROM e1 LEFT JOIN l0 ON e1.child = l0.label GROUP BY e1.parent),
l1 AS (SELECT g1.label,
  CASE WHEN cr IS NOT NULL OR c4 IS NOT NULL OR c10 IS NOT NULL THEN COALESCE(cr, 0.0) ELSE o.real END AS real,
  CASE WHEN cr IS NOT NULL OR c4 IS NOT NULL OR c10 IS NOT NULL THEN COALESCE(round_even(c4, 1), 0.0) ELSE o.e4 END AS e4,
  CASE WHEN cr IS NOT NULL OR c4 IS NOT NULL OR c10 IS NOT NULL THEN COALESCE(round_even(c10, 1), 0.0) ELSE o.e10 END AS e10
  FROM g1 LEFT JOIN own_s o ON g1.label = o.label),
g2 AS (SELECT 'Index' AS label, avg(NULLIF(real, 0.0)) AS cr, avg(NULLIF(e4, 0.0)) AS c4,
       avg(NULLIF(e10, 0.0)) AS c10 FROM l1),
l2 AS (SELECT g2.label,
  CASE WHEN cr IS NOT NULL OR c4 IS NOT NULL OR c10 IS NOT NULL THEN COALESCE(cr, 0.0) ELSE o.real END AS real,
  CASE WHEN cr IS NOT NULL OR c4 IS NOT NULL OR c10 IS NOT NULL THEN COALESCE(round_even(c4, 1), 0.0) ELSE o.e4 END AS e4,
  CASE WHEN cr IS NOT NULL OR c4 IS NOT NULL OR c10 IS NOT NULL THEN COALESCE(round_even(c10, 1), 0.0) ELSE o.e10 END AS e10
  FROM g2 LEFT JOIN own_s o ON g2.label = o.label),
allv AS (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2),
ord AS (SELECT * FROM (VALUES (0, 'Index'), (1, 'A1'), (2, 'Q1'), (3, 'Q2'), (4, 'A2'), (5, 'Q3'), (6, 'Q4'),
    (7, 'A3'), (8, 'Q5'), (9, 'Q6'), (10, 'Q7')) AS t(node_ord, label))
SELECT ord.node_ord, ord.label AS node, round_even(NULLIF(a.real, 0.0), 6) AS real,
  NULLIF(a.e4, 0.0) AS scale4, NULLIF(a.e10, 0.0) AS scale10
FROM ord LEFT JOIN allv a ON ord.label = a.label"""


def loose(x: str) -> str:
    return f"regexp_replace({norm(x)}, '[^\\p{{L}}\\p{{N}} ]', '', 'g')"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def gestalt(pairs: str) -> str:
    """CTEs giving ratio(a, b, score) for the distinct strings of ``pairs(a, b)``: twice the matched characters over all.

    Matched are the longest common block (ties: first in a, then first in b) and, again, what stands left
    and right of it. ``run`` has the common run that begins at each pair of equal characters.
    """
    return f"""pr AS (SELECT row_number() OVER () AS pid, a, b FROM (SELECT DISTINCT a, b FROM {pairs}) x),
eq AS (SELECT pid, i, j FROM (SELECT pid, a, b, i, unnest(range(1, length(b) + 1)) AS j
    FROM (SELECT pid, a, b, unnest(range(1, length(a) + 1)) AS i FROM pr) x) y WHERE a[i] = b[j]),
isl AS (SELECT pid, i, j, i - row_number() OVER (PARTITION BY pid, i - j ORDER BY i) AS g FROM eq),
run AS (SELECT pid, i, j, max(i) OVER (PARTITION BY pid, i - j, g) - i + 1 AS l FROM isl),
blk AS (SELECT pid, CAST(1 AS BIGINT) AS al, CAST(length(a) + 1 AS BIGINT) AS ah, CAST(1 AS BIGINT) AS bl,
    CAST(length(b) + 1 AS BIGINT) AS bh, CAST(0 AS BIGINT) AS k FROM pr
  UNION ALL
  SELECT pid, CASE side WHEN 0 THEN al ELSE m.k - m.ni END, CASE side WHEN 0 THEN -m.ni ELSE ah END,
    CASE side WHEN 0 THEN bl ELSE m.k - m.nj END, CASE side WHEN 0 THEN -m.nj ELSE bh END, CASE side WHEN 0 THEN m.k ELSE 0 END
  FROM (SELECT s.pid, s.al, s.ah, s.bl, s.bh, max(struct_pack(k := least(r.l, s.ah - r.i, s.bh - r.j), ni := -r.i, nj := -r.j)) AS m
        FROM blk s JOIN run r ON r.pid = s.pid AND r.i >= s.al AND r.i < s.ah AND r.j >= s.bl AND r.j < s.bh
        GROUP BY s.pid, s.al, s.ah, s.bl, s.bh) best, (VALUES (0), (1)) AS v(side)),
ratio AS (SELECT pr.a, pr.b, CASE WHEN length(pr.a) + length(pr.b) = 0 THEN 1.0::DOUBLE
    ELSE (2.0::DOUBLE * x.m) / (length(pr.a) + length(pr.b)) END AS score
  FROM pr JOIN (SELECT pid, sum(k) AS m FROM blk GROUP BY pid) x ON x.pid = pr.pid)"""


def _matrix_and_matching() -> dict[str, str]:
    q = {}
    coh = "CASE " + " ".join(f"WHEN {loose('r.cohort_raw')} IN {vs} THEN '{k}'" for k, vs in COHORTS) + " END"
    cls = (f"CASE WHEN {loose('r.nps_raw')} IN {PROM} THEN 'promoter' WHEN {loose('r.nps_raw')} IN {PAS} THEN 'passive' "
           f"WHEN {loose('r.nps_raw')} IN {DET} THEN 'detractor' END")
    segs = [("general", "TRUE"), ("boomers", "cohort = 'baby boomers'"), ("generacion_x", "cohort = 'generacion x'"),
            ("milenialls", "cohort = 'milenialls'"), ("centenialls", "cohort = 'centenialls'"),
            ("entusiastas", "nps_class = 'promoter'"), ("pasivos", "nps_class = 'passive'"),
            ("detractores", "nps_class = 'detractor'")]
    cols = ", ".join(f"COALESCE({conv10(f'avg(s) FILTER (WHERE {c})')}, 0.0) AS {n}" for n, c in segs)
    qlab = "(VALUES " + ", ".join(f"({i}, '{x.question_id}', {_q(x.label)})" for i, x in enumerate(FIXTURE_QUESTIONS)) + \
        ") AS qd(q_ord, question_id, label)"
    q["question_matrix"] = with_views("", "respondents", "answers").rstrip() + f""",
seg AS (SELECT r.row_ord, {coh} AS cohort, {cls} AS nps_class FROM respondents r),
j AS (SELECT a.question_id, g.cohort, g.nps_class, {clip(num('a.score_raw'))} AS s FROM answers a JOIN seg g ON a.row_ord = g.row_ord),
sc AS (SELECT question_id, {cols} FROM j GROUP BY question_id)
SELECT CAST(qd.q_ord AS BIGINT) AS template_ord, CAST(NULL AS VARCHAR) AS index, qd.label AS question,
  CAST(NULL AS VARCHAR) AS clima, CAST(NULL AS VARCHAR) AS ife, CAST(NULL AS DOUBLE) AS weight,
  qd.question_id, {', '.join('sc.' + n for n, _ in segs)}
FROM {qlab} LEFT JOIN sc ON qd.question_id = sc.question_id"""

    q["question_matrix_template"] = with_views("", "respondents", "answers").rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + f""",
seg AS (SELECT r.row_ord, {coh} AS cohort, {cls} AS nps_class FROM respondents r),
j AS (SELECT a.question_id, g.cohort, g.nps_class, {clip(num('a.score_raw'))} AS s FROM answers a JOIN seg g ON a.row_ord = g.row_ord),
sc AS (SELECT question_id, {cols} FROM j GROUP BY question_id),
lbl AS (SELECT * FROM {qlab.replace('AS qd(q_ord, question_id, label)', 'AS lb(ord, qid, label)')}),
tpl AS (SELECT CAST(n.n_nationkey AS BIGINT) AS template_ord, 'T' || CAST(n.n_nationkey AS VARCHAR) AS index,
  CASE (n.n_nationkey // {len(FIXTURE_QUESTIONS)}) % 4
    WHEN 0 THEN l.label WHEN 1 THEN '¡' || upper(l.label) || '!'
    WHEN 2 THEN substr(l.label, 1, CAST(n.n_nationkey % 20 AS INTEGER)) || substr(l.label, CAST(n.n_nationkey % 20 AS INTEGER) + 2)
    ELSE n.n_name END AS question,
  n.n_name AS clima, CAST(NULL AS VARCHAR) AS ife, CAST(n.n_regionkey AS DOUBLE) AS weight
  FROM nation n JOIN lbl l ON l.ord = n.n_nationkey % {len(FIXTURE_QUESTIONS)}),
nk AS (SELECT ord, qid, label, {loose('label')} AS nkey FROM lbl),
ex AS (SELECT t.template_ord, max_by(nk.qid, nk.ord) AS ev FROM tpl t JOIN nk ON nk.label = t.question GROUP BY 1),
nm AS (SELECT t.template_ord, max_by(nk.qid, nk.ord) AS nv FROM tpl t JOIN nk ON nk.nkey = {loose('t.question')} GROUP BY 1),
pairs AS (SELECT {loose('t.question')} AS a, nk.nkey AS b FROM tpl t, nk),
{gestalt('pairs')},
fs AS (SELECT t.template_ord, nk.qid, nk.ord, r.score
  FROM tpl t, nk JOIN ratio r ON r.a = {loose('t.question')} AND r.b = nk.nkey),
best AS (SELECT template_ord, qid AS fv, score FROM (
  SELECT *, row_number() OVER (PARTITION BY template_ord ORDER BY score DESC, ord) AS rn FROM fs) x WHERE rn = 1),
m AS (SELECT t.*, COALESCE(ex.ev, nm.nv, CASE WHEN best.score >= 0.75 THEN best.fv END) AS question_id
  FROM tpl t LEFT JOIN ex ON t.template_ord = ex.template_ord LEFT JOIN nm ON t.template_ord = nm.template_ord
  LEFT JOIN best ON t.template_ord = best.template_ord)
SELECT m.template_ord, m.index, m.question, m.clima, m.ife, m.weight, m.question_id,
  {', '.join('sc.' + n for n, _ in segs)}
FROM m LEFT JOIN sc ON m.question_id = sc.question_id"""

    nq = len(FIXTURE_QUESTIONS)
    lbl = "(VALUES " + ", ".join(f"({i}, '{x.question_id}', {_q(x.label)})" for i, x in enumerate(FIXTURE_QUESTIONS)) + \
        ") AS lbl(ord, qid, label)"
    wanted = f"""w AS (
  SELECT p.p_partkey, CASE (p.p_partkey // {nq}) % 4
    WHEN 0 THEN l.label
    WHEN 1 THEN substr(l.label, 1, CAST(p.p_partkey % 20 AS INTEGER)) || substr(l.label, CAST(p.p_partkey % 20 AS INTEGER) + 2)
    WHEN 2 THEN '¡' || upper(l.label) || '!'
    ELSE p.p_name END AS wanted
  FROM part p JOIN {lbl} ON l.ord = p.p_partkey % {nq})"""
    wanted = wanted.replace("AS lbl(ord", "AS l(ord")
    match = f"""nk AS (SELECT ord, qid, label, {loose('label')} AS nkey FROM {lbl}),
ex AS (SELECT w.p_partkey, max_by(nk.qid, nk.ord) AS ev FROM w JOIN nk ON nk.label = w.wanted GROUP BY w.p_partkey),
nm AS (SELECT w.p_partkey, max_by(nk.qid, nk.ord) AS nv FROM w JOIN nk ON nk.nkey = {loose('w.wanted')} GROUP BY w.p_partkey),
sc AS (SELECT w.p_partkey, nk.qid, nk.ord,
  1 - levenshtein(nk.nkey, {loose('w.wanted')}) / CAST(greatest(length(nk.nkey), length({loose('w.wanted')})) AS DOUBLE) AS score
  FROM w, nk),
best AS (SELECT p_partkey, qid AS fv, score FROM (
  SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, ord) AS rn FROM sc) t WHERE rn = 1),
m AS (SELECT w.p_partkey, w.wanted,
  COALESCE(ex.ev, nm.nv, CASE WHEN best.score >= 0.75 THEN best.fv END) AS match_value,
  CASE WHEN ex.ev IS NOT NULL THEN 'exact' WHEN nm.nv IS NOT NULL THEN 'normalized'
       WHEN best.score >= 0.75 THEN 'fuzzy' END AS match_method,
  CASE WHEN ex.ev IS NULL AND nm.nv IS NULL AND best.score >= 0.75 THEN best.score END AS match_score
  FROM w LEFT JOIN ex ON w.p_partkey = ex.p_partkey LEFT JOIN nm ON w.p_partkey = nm.p_partkey
  LEFT JOIN best ON w.p_partkey = best.p_partkey)"""
    q["label_match"] = f"WITH {wanted},\n{match}\nSELECT p_partkey, wanted, match_value, match_method, match_score FROM m"
    q["label_match_ratcliff"] = (f"WITH RECURSIVE {wanted},\n{match}\nSELECT p_partkey, wanted, match_value, match_method, match_score FROM m"
                                 .replace("sc AS (SELECT", f"""pairs AS (SELECT {loose('w.wanted')} AS a, nk.nkey AS b FROM w, nk
  WHERE w.p_partkey NOT IN (SELECT p_partkey FROM ex) AND w.p_partkey NOT IN (SELECT p_partkey FROM nm)),
{gestalt('pairs')},
sc AS (SELECT""", 1).replace(f"1 - levenshtein(nk.nkey, {loose('w.wanted')}) / CAST(greatest(length(nk.nkey), length({loose('w.wanted')})) AS DOUBLE) AS score\n  FROM w, nk)",
                                              f"r.score\n  FROM w, nk JOIN ratio r ON r.a = {loose('w.wanted')} AND r.b = nk.nkey)"))
    q["label_unmatched"] = f"WITH {wanted},\n{match}\nSELECT p_partkey, wanted FROM m WHERE match_value IS NULL"

    q["name_resolve"] = """WITH w AS (
  SELECT p.p_partkey, CASE (p.p_partkey // 25) % 4
    WHEN 0 THEN lower(n.n_name)
    WHEN 1 THEN substr(n.n_name, 1, 4)
    WHEN 2 THEN substr(n.n_name, 1, CAST(p.p_partkey % 5 AS INTEGER)) || substr(n.n_name, CAST(p.p_partkey % 5 AS INTEGER) + 2)
    ELSE p.p_name END AS wanted
  FROM part p JOIN nation n ON n.n_nationkey = p.p_partkey % 25),
c AS (SELECT n_nationkey AS ord, n_name, lower(trim(n_name)) AS k FROM nation),
pf AS (SELECT w.p_partkey, arg_min(c.n_name, c.ord) AS pv FROM w JOIN c
       ON c.k = lower(trim(w.wanted)) OR starts_with(c.k, lower(trim(w.wanted))) GROUP BY w.p_partkey),
fk AS (SELECT k, min(ord) AS ord, arg_min(n_name, ord) AS v FROM c GROUP BY k),
sc AS (SELECT w.p_partkey, fk.v, fk.ord,
  1 - levenshtein(fk.k, lower(trim(w.wanted))) / CAST(greatest(length(fk.k), length(lower(trim(w.wanted)))) AS DOUBLE) AS score
  FROM w, fk),
best AS (SELECT p_partkey, v AS fv, score FROM (
  SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, ord) AS rn FROM sc) t WHERE rn = 1)
SELECT w.p_partkey, w.wanted,
  COALESCE(pf.pv, CASE WHEN best.score >= 0.6 THEN best.fv END) AS match_value,
  CASE WHEN pf.pv IS NOT NULL THEN 'prefix' WHEN best.score >= 0.6 THEN 'fuzzy' END AS match_method,
  CASE WHEN pf.pv IS NULL AND best.score >= 0.6 THEN best.score END AS match_score
FROM w LEFT JOIN pf ON w.p_partkey = pf.p_partkey LEFT JOIN best ON w.p_partkey = best.p_partkey"""
    q["name_resolve_ratcliff"] = (q["name_resolve"].replace("WITH w", "WITH RECURSIVE w", 1)
                                  .replace("sc AS (SELECT", f"""pairs AS (SELECT lower(trim(w.wanted)) AS a, fk.k AS b FROM w, fk
  WHERE w.p_partkey NOT IN (SELECT p_partkey FROM pf)),
{gestalt('pairs')},
sc AS (SELECT""", 1).replace("1 - levenshtein(fk.k, lower(trim(w.wanted))) / CAST(greatest(length(fk.k), length(lower(trim(w.wanted)))) AS DOUBLE) AS score\n  FROM w, fk)",
                             "r.score\n  FROM w, fk JOIN ratio r ON r.a = lower(trim(w.wanted)) AND r.b = fk.k)"))
    return q


ORACLE_SQL = _sql()
