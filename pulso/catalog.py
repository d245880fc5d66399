"""Registered report queries over the provided tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame. Building some of
them runs small jobs (materialised pre-aggregates, the bounded fetch of a label dimension). ``__spark_entry__.queries()`` exposes this dict to the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.numeric import fixed, likert_score, scale4_to_10, to_number, to_number_decimal_comma
from .functions.text import (answered_label, answered_raw, collapse_ws, nonempty_label, norm_label,
                             norm_label_loose, strip_numeric_prefix)
from .operators.hierarchy import hierarchy_report
from .operators.matching import match_labels, unmatched
from .operators.segments import filter_ids, filter_ids_table, row_nonblank
from .plans.comments import comments_projection
from .plans import demographics as demo
from .plans import kpis
from .plans.question_matrix import question_matrix
from .plans.sheet import sheet_reports
from .sources import fixtures as fx
from .session import materialize, stage_path
from .sources.dims import (DemographicGroup, demographic_groups, hierarchy_nodes, question_dim, read_demographic_json,
                           read_hierarchy_json, template_from_table)
from .sources.io import list_reports, read_report, write_report
from .sources.publish import manifest, publish, published
from .sources.letters import index_to_letter, select_letters, wide_to_canonical
from .sources.sheets import read_sheet, write_sheet

# Fixed parameters of the ID-filter queries: literal ids (with padding to
# exercise trimming, plus one that matches nothing).
ID_FILTER_IDS = ["1", " 7", "13 ", "42", "100", "1000", "abc"]


def _cube(spark: SparkSession, sf_dir: str, ids=None):
    return kpis.kpi_cube(fx.respondents(spark, sf_dir), ids=ids)


def _universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).cast("double").alias("universe"))


def q_nps_overall(spark, sf_dir):
    return kpis.nps_overall(_cube(spark, sf_dir))


def q_nps_by_cohort(spark, sf_dir):
    return kpis.nps_by_cohort(_cube(spark, sf_dir))


def q_nps_category_pct(spark, sf_dir):
    return kpis.nps_category_pct(_cube(spark, sf_dir))


def q_cohort_share(spark, sf_dir):
    return kpis.cohort_share(_cube(spark, sf_dir))


def q_satisfaction_by_cohort(spark, sf_dir):
    return kpis.satisfaction_by_cohort(_cube(spark, sf_dir))


def q_responded_count(spark, sf_dir):
    cube = _cube(spark, sf_dir)
    r = cube.agg(F.coalesce(F.sum(F.when(F.col("responded"), F.col("n"))), F.lit(0)).cast("bigint").alias("responses"))
    u = _universe(spark, sf_dir)
    row = (r.unionByName(u, allowMissingColumns=True)
           .agg(F.max("responses").alias("responses"), F.max("universe").alias("universe")))
    part = F.coalesce(F.when(F.col("universe") > 0,
                             F.bround((F.col("responses") / F.col("universe")) * F.lit(100.0), 2)), F.lit(0.0))
    return row.select("responses", "universe", part.alias("participation"))


def q_question_scores(spark, sf_dir):
    return kpis.question_scores(fx.answers(spark, sf_dir))


def q_axis_scores(spark, sf_dir):
    qs = kpis.question_scores(fx.answers(spark, sf_dir))
    return kpis.axis_scores(qs, fx.FIXTURE_QUESTIONS)


def q_climate_index(spark, sf_dir):
    return kpis.climate_index(q_axis_scores(spark, sf_dir))


def q_survey_kpis(spark, sf_dir):
    return kpis.survey_kpis(fx.respondents(spark, sf_dir), fx.answers(spark, sf_dir), fx.FIXTURE_QUESTIONS,
                            universe=_universe(spark, sf_dir))


def q_survey_kpis_by_id(spark, sf_dir):
    return kpis.survey_kpis(fx.respondents(spark, sf_dir, native_id=True), fx.answers(spark, sf_dir),
                            fx.FIXTURE_QUESTIONS, universe=_universe(spark, sf_dir), ids=ID_FILTER_IDS)


def q_question_matrix(spark, sf_dir):
    return question_matrix(fx.answers(spark, sf_dir), fx.respondents(spark, sf_dir), fx.FIXTURE_QUESTIONS)


def _nation_template(spark, sf_dir):
    """A template table derived from nation: one row per nation, whose question
    is a question label kept, upper-cased with punctuation, missing a character,
    or unrelated (the nation name)."""
    n = fx.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    labels = F.array(*[F.lit(q.label) for q in fx.FIXTURE_QUESTIONS])
    k = F.col("n_nationkey").cast("bigint")
    nq = len(fx.FIXTURE_QUESTIONS)
    lab = F.element_at(labels, (k % nq + 1).cast("int"))
    kind = (F.floor(k / nq) % 4).cast("int")
    pos = (k % 20 + 1).cast("int")
    question = (F.when(kind == 0, lab)
                .when(kind == 1, F.concat(F.lit("¡"), F.upper(lab), F.lit("!")))
                .when(kind == 2, F.concat(F.substring(lab, 1, pos - 1), F.expr("substring(__lab, __pos + 1)")))
                .otherwise(F.col("n_name")))
    return (n.withColumn("__lab", lab).withColumn("__pos", pos)
            .select(k.alias("template_ord"), F.concat(F.lit(" T"), k.cast("string")).alias("index"),
                    question.alias("Pregunta"), F.col("n_name").alias("Clima"), F.col("n_regionkey").cast("string").alias("PESO")))


def q_question_matrix_template(spark, sf_dir):
    return question_matrix(fx.answers(spark, sf_dir), fx.respondents(spark, sf_dir), fx.FIXTURE_QUESTIONS,
                           template=template_from_table(_nation_template(spark, sf_dir)), metric="ratcliff")


def _perturbed_labels(spark, sf_dir):
    """One wanted label per part row: a question label kept, with a dropped
    character, upper-cased with punctuation, or replaced by the part name."""
    labels = F.array(*[F.lit(q.label) for q in fx.FIXTURE_QUESTIONS])
    p = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("p_partkey")
    lab = F.element_at(labels, (k % len(fx.FIXTURE_QUESTIONS) + 1).cast("int"))
    pos = (k % 20 + 1).cast("int")
    kind = (F.floor(k / len(fx.FIXTURE_QUESTIONS)) % 4).cast("int")
    wanted = (F.when(kind == 0, lab)
              .when(kind == 1, F.concat(F.substring(lab, 1, pos - 1), F.expr("substring(__lab, __pos + 1)")))
              .when(kind == 2, F.concat(F.lit("¡"), F.upper(lab), F.lit("!")))
              .otherwise(F.col("p_name")))
    return (p.withColumn("__lab", lab).withColumn("__pos", pos)
            .select("p_partkey", wanted.alias("wanted")))


def q_label_match(spark, sf_dir):
    qdim = question_dim(spark, fx.FIXTURE_QUESTIONS)
    m = match_labels(_perturbed_labels(spark, sf_dir), "wanted", qdim, "label", "question_id", "ord",
                     threshold=0.75, metric="levenshtein")
    return m.select("p_partkey", "wanted", "match_value", "match_method", "match_score")


def q_label_match_ratcliff(spark, sf_dir):
    qdim = question_dim(spark, fx.FIXTURE_QUESTIONS)
    m = match_labels(_perturbed_labels(spark, sf_dir), "wanted", qdim, "label", "question_id", "ord",
                     threshold=0.75, metric="ratcliff")
    return m.select("p_partkey", "wanted", "match_value", "match_method", "match_score")


def q_label_unmatched(spark, sf_dir):
    qdim = question_dim(spark, fx.FIXTURE_QUESTIONS)
    m = match_labels(_perturbed_labels(spark, sf_dir), "wanted", qdim, "label", "question_id", "ord",
                     threshold=0.75, metric="levenshtein")
    return unmatched(m).select("p_partkey", "wanted")


def q_label_match_many(spark, sf_dir):
    """J3, W5 against a dimension of as many keys as rows, by joins: suppliers with their nation, one character of each left out."""
    s, n = fx.table(spark, sf_dir, "supplier"), fx.table(spark, sf_dir, "nation")
    k = F.col("s_suppkey")
    names = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", F.concat_ws(" ", "s_name", "n_name").alias("name"))
    wanted = names.withColumn("pos", (k % 20 + 1).cast("int")).select(
        "s_suppkey", F.concat(F.substring(F.col("name"), F.lit(1), F.col("pos") - 1), F.expr("substring(name, pos + 1)")).alias("wanted"))
    dim = names.select((k + F.lit(1 << 33)).alias("ord"), "name", k.alias("key"))
    m = match_labels(wanted, "wanted", dim, "name", "key", "ord", threshold=0.95, metric="levenshtein", max_inline=0)
    return m.select("s_suppkey", "wanted", "match_value", "match_method", "match_score")


def _wanted_names(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    n = fx.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = p.join(n, (p.p_partkey % 25) == n.n_nationkey)
    k = F.col("p_partkey")
    kind = (F.floor(k / 25) % 4).cast("int")
    pos = (k % 5 + 1).cast("int")
    wanted = (F.when(kind == 0, F.lower(F.col("n_name")))
              .when(kind == 1, F.substring(F.col("n_name"), 1, 4))
              .when(kind == 2, F.concat(F.substring(F.col("n_name"), 1, pos - 1), F.expr("substring(n_name, __pos + 1)")))
              .otherwise(F.col("p_name")))
    return j.withColumn("__pos", pos).select("p_partkey", wanted.alias("wanted"))


def q_name_resolve(spark, sf_dir):
    nation = fx.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    m = match_labels(_wanted_names(spark, sf_dir), "wanted", nation, "n_name", "n_name", "n_nationkey",
                     threshold=0.6, metric="levenshtein", mode="name")
    return m.select("p_partkey", "wanted", "match_value", "match_method", "match_score")


def q_name_resolve_ratcliff(spark, sf_dir):
    nation = fx.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    m = match_labels(_wanted_names(spark, sf_dir), "wanted", nation, "n_name", "n_name", "n_nationkey",
                     threshold=0.6, metric="ratcliff", mode="name")
    return m.select("p_partkey", "wanted", "match_value", "match_method", "match_score")


def q_hierarchy_rollup(spark, sf_dir):
    return hierarchy_report(fx.answers(spark, sf_dir), fx.FIXTURE_HIERARCHY)


def _labels(spark, sf_dir):
    return demo.label_table(fx.respondents(spark, sf_dir), fx.FIXTURE_DEMOGRAPHICS)


def q_demographic_counts(spark, sf_dir):
    t = _labels(spark, sf_dir)
    return t.select("grupo", "label", F.col("general").cast("bigint").alias("general"),
                    F.col("group_total").cast("bigint").alias("group_total"),
                    F.bround(F.col("general") / F.col("group_total"), 6).alias("share"))


def q_demographic_nps(spark, sf_dir):
    t = demo.nps_shares(_labels(spark, sf_dir))
    return t.select("grupo", "label", *[F.col(c).cast("bigint").alias(c) for c in
                                        ("detractores", "pasivos", "entusiastas", "global_nps")],
                    "pct_detractores", "pct_pasivos", "pct_entusiastas")


def q_demographic_display(spark, sf_dir):
    t = _labels(spark, sf_dir)
    return t.select("grupo", "label", demo.display_label("raw").alias("variable"),
                    demo.display_label("no-prefix").alias("variable_no_prefix"), "first_seen")


def q_share_apportioned(spark, sf_dir):
    t = demo.apportion_share(demo.with_index(_labels(spark, sf_dir)))
    return t.select("grupo", "label", "index", "pct")


def q_nps_share_apportioned(spark, sf_dir):
    t = demo.apportion_nps(demo.with_index(demo.nps_shares(_labels(spark, sf_dir))))
    return t.select("grupo", "label", "index", "pct_detractores", "pct_pasivos", "pct_entusiastas")


def q_demographic_report(spark, sf_dir):
    return demo.demographic_report(fx.respondents(spark, sf_dir), fx.FIXTURE_DEMOGRAPHICS)


def q_id_filter(spark, sf_dir):
    r = fx.respondents(spark, sf_dir, native_id=True)
    return filter_ids(r, ID_FILTER_IDS).select("row_ord", F.col("id").cast("string").alias("id"), "cohort_raw", "nps_raw")


def q_id_filter_semi(spark, sf_dir):
    ids = fx.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    r = fx.respondents(spark, sf_dir, native_id=True)
    return filter_ids_table(r, ids, "id", "c_custkey").select("row_ord", F.col("id").cast("string").alias("id"))


def q_row_nonblank(spark, sf_dir):
    r = fx.respondents(spark, sf_dir).select("cohort_raw", "nps_raw")
    return (r.select(row_nonblank(r).alias("nonblank")).groupBy("nonblank")
            .agg(F.count(F.lit(1)).alias("n")))


def q_label_normalize(spark, sf_dir):
    r = fx.respondents(spark, sf_dir)
    raw = (r.select(F.explode(F.array("cohort_raw", "nps_raw", "dem_segment_raw", "dem_status_raw")).alias("raw"))
           .filter(F.col("raw").isNotNull()).distinct())
    return raw.select("raw", norm_label("raw").alias("norm"), norm_label_loose("raw").alias("norm_loose"),
                      collapse_ws("raw").alias("ws"), strip_numeric_prefix("raw").alias("no_prefix"),
                      answered_raw("raw").alias("answered"), answered_label("raw").alias("answered_label"),
                      nonempty_label("raw").alias("nonempty"))


def q_text_normalize(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return d.select("doc_id", norm_label("text").alias("norm"), norm_label_loose("text").alias("norm_loose"))


def q_numeric_coerce_clip(spark, sf_dir):
    a = fx.answers(spark, sf_dir)
    return (a.groupBy("score_raw").agg(F.count(F.lit(1)).alias("n"))
            .select("score_raw", to_number("score_raw").alias("num"), likert_score("score_raw").alias("clipped"), "n"))


def q_scale_convert(spark, sf_dir):
    s = likert_score("score_raw")
    a = fx.answers(spark, sf_dir).groupBy("question_id").agg(F.avg(s).alias("mean4"))
    return a.select("question_id", "mean4", F.bround("mean4", 1).alias("mean4_r1"),
                    scale4_to_10("mean4").alias("score10"))


POSITIONAL = {"row_ord": "A", "id": "B", "generacion": "C", "tipo_nps": "D", "satisfaccion": "E",
              "fuera_de_rango": "IZ"}


def q_positional_select(spark, sf_dir):
    return select_letters(fx.respondents(spark, sf_dir), POSITIONAL)


COMMENT_SOURCES = {"id": "doc_id", "variable_1": "lang", "variable_2": "source", "variable_3": "quality",
                   "tipo_nps": "toxic", "generacion": None, "antiguedad": "n_chars", "tipo_contrato": None,
                   "comentarios": "text"}


def _docs(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    lab = fx.table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


def q_comments_projection(spark, sf_dir):
    return comments_projection(_docs(spark, sf_dir), COMMENT_SOURCES)


def q_comments_by_id(spark, sf_dir):
    ids = fx.table(spark, sf_dir, "labels").filter(F.col("toxic") == 1).select("doc_id")
    return comments_projection(_docs(spark, sf_dir), COMMENT_SOURCES, ids_table=ids)


def q_report_roundtrip(spark, sf_dir):
    """Publish the demographic report into the shared checkpoint folder and read it back."""
    base = stage_path(spark, "reports")
    write_report(q_demographic_report(spark, sf_dir), base, "demographic_report", mode="only")
    return read_report(spark, base, "demographic_report")


def q_report_publish(spark, sf_dir):
    """The reports left after publishing in each mode (a few names, whatever the data's size)."""
    counts = q_demographic_counts(spark, sf_dir).select("grupo", "label")
    left = []
    for mode, drop in (("keep-others", ()), ("only", ()), ("keep-others", ("comentarios", "demografia"))):
        base = stage_path(spark, "publish")
        for name in ("consolidado", "comentarios"):
            write_report(counts, base, name)
        write_report(counts, base, "demografia", mode=mode, drop=drop)
        published = read_report(spark, base, "demografia").agg(F.count(F.lit(1)).alias("n_rows"))
        left.append(published.select(F.lit(f"{mode} {len(drop)}").alias("mode"), F.lit(",".join(list_reports(spark, base))).alias("reports"), "n_rows"))
    return left[0].unionByName(left[1]).unionByName(left[2])


def q_report_versions(spark, sf_dir):
    """Three versions published over each other; the reports of the last one and their rows."""
    counts = materialize(q_demographic_counts(spark, sf_dir).select("grupo", "label"), "versions-counts")
    base = stage_path(spark, "versions")
    publish({"consolidado": counts, "comentarios": counts}, base)
    publish({"demografia": counts.filter("grupo = 'SEGMENT'")}, base)
    publish({"consolidado": counts.limit(0), "indice_clima": counts.select("grupo").distinct()}, base, drop=("comentarios", "indice_clima"))
    reports = [published(spark, base, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("report"), "n_rows") for name in manifest(spark, base)]
    return reduce(DataFrame.unionByName, reports)


def _number_forms(spark, sf_dir):
    """One number text per line item, in the spellings a survey cell may hold."""
    li = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    q, k = F.col("l_quantity").cast("bigint").cast("string"), F.col("l_orderkey") % 12
    forms = [q, F.concat(q, F.lit(",5")), F.concat(F.lit("  "), q, F.lit(".25 ")), F.concat(q, F.lit(".5d")), F.concat(q, F.lit("e2")),
             F.concat(F.lit("-"), q, F.lit("E-1")), F.lit("inf"), F.lit("NaN"), F.lit("true"), F.lit(""), F.concat(F.lit("+."), q), F.concat(q, F.lit("."))]
    raw = F.lit(None).cast("string")
    for i, f in enumerate(forms):
        raw = F.when(k == i, f).otherwise(raw)
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw"), "l_extendedprice")


def q_number_forms(spark, sf_dir):
    """Cell texts as numbers, with a decimal comma too, and fixed-decimal display text."""
    d = _number_forms(spark, sf_dir)
    return d.select("l_orderkey", "l_linenumber", "raw", to_number("raw").alias("num"), to_number_decimal_comma("raw").alias("num_comma"),
                    fixed("l_extendedprice", 3).alias("price_text"))


SHEET_PLACES = {"A": "id", "E": "satisfaction_raw", "G": "satisfaction_raw", "GU": "cohort_raw", "GV": "nps_raw", "CM": "dem_segment_raw",
                **{letter: f"Q{i}" for i, letter in enumerate(("AL", "AM", "AN", "AO", "AP", "AQ", "AR"), 1)},
                **{letter: f"Q{i}" for i, letter in enumerate(("IC", "ID", "IE", "IF", "IH", "II", "IJ"), 1)}}


def wide_sheet(spark, sf_dir):
    """The fixture as a classic 260-column sheet; a cell takes the smallest answer text of its row and question."""
    questions = [q.question_id for q in fx.FIXTURE_QUESTIONS]
    cells = fx.answers(spark, sf_dir).groupBy("row_ord").pivot("question_id", questions).agg(F.min("score_raw"))
    rows = fx.respondents(spark, sf_dir).join(cells, "row_ord", "left")
    place = [SHEET_PLACES.get(index_to_letter(i)) for i in range(260)]
    return rows.select("row_ord", *[(F.col(p) if p else F.lit(None)).cast("string").alias(f"c{i}") for i, p in enumerate(place)]) \
        .select(*[f"c{i}" for i in range(260)], "row_ord")


def q_sheet_question_matrix(spark, sf_dir):
    return sheet_reports(wide_sheet(spark, sf_dir))["por_pregunta"]


def q_sheet_kpis(spark, sf_dir):
    return sheet_reports(wide_sheet(spark, sf_dir), universe=_universe(spark, sf_dir))["consolidado"]


# --- sheets as files ------------------------------------------------------------

# Fixed parameters: labels with dots, a repeat and backticks, and the order of the columns in each of four files.
SHEET_LABELS = ("ID.", "¿Nombre?", "x`y", "x`y", "Saldo. 1")
SHEET_ORDERS = ((0, 1, 2, 3, 4), (4, 2, 0, 3, 1), (2, 1, 3, 4, 0), (1, 4, 2, 3, 0))


def _customer_sheet(spark, sf_dir):
    """The customers in files of four column orders, and one of records that are no rows."""
    c = fx.table(spark, sf_dir, "customer")
    base = stage_path(spark, "customer-sheet")
    fields = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    folders = [f"{base}/order{i}" for i in range(len(SHEET_ORDERS))] + [f"{base}/broken"]
    for i, (order, folder) in enumerate(zip(SHEET_ORDERS, folders)):
        part = c.filter(F.col("c_custkey") % len(SHEET_ORDERS) == i)
        write_sheet(part.select(*[fields[j] for j in order]), folder, [SHEET_LABELS[j] for j in order])
    broken = c.filter(F.col("c_custkey") % 97 == 0).select(
        F.concat(F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, F.lit(',"open')).otherwise(F.lit(",too,many"))).alias("value"))
    broken.write.text(f"{base}/lines")
    # every file of records begins with its header, as files of a sheet do
    lines = spark.read.text(f"{base}/lines")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines.select(F.when(first, F.concat(F.lit("ID.,¿Nombre?\n"), "value")).otherwise(F.col("value")).alias("value")).write.text(folders[-1])
    return read_sheet(spark, folders)


def q_sheet_csv_read(spark, sf_dir):
    rows = _customer_sheet(spark, sf_dir).rows
    return rows.select(F.col("c0").cast("bigint").alias("c_custkey"), F.col("c1").alias("c_name"), F.col("c2").cast("int").alias("c_nationkey"),
                       F.col("c3").alias("c_mktsegment"), F.col("c4").cast("double").alias("c_acctbal"))


def q_sheet_csv_rejects(spark, sf_dir):
    rejects = _customer_sheet(spark, sf_dir).rejects
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum(F.substring_index("record", ",", 1).cast("bigint")).alias("key_sum"))


def q_sheet_row_ordinal(spark, sf_dir):
    """Orders written in key order, numbered again from CSV and from Parquet files."""
    base = stage_path(spark, "ordinal-sheet")
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority").repartitionByRange(6, "o_orderkey").sortWithinPartitions("o_orderkey")
    write_sheet(o, f"{base}/csv")
    o.write.parquet(f"{base}/parquet")
    both = [read_sheet(spark, f"{base}/{fmt}", fmt, ordinal=True).rows.select(F.lit(fmt).alias("fmt"), "row_ord", F.col("c0").cast("bigint").alias("o_orderkey"))
            for fmt in ("csv", "parquet")]
    return both[0].unionByName(both[1])


def q_sheet_demographics(spark, sf_dir):
    """The demographic report of a CSV sheet whose rows have no ordinal but their place."""
    folder = f"{stage_path(spark, 'demographic-sheet')}/csv"
    r = fx.respondents(spark, sf_dir).repartitionByRange(6, "row_ord").sortWithinPartitions("row_ord")
    write_sheet(r.select("id", "nps_raw", "dem_segment_raw", "dem_status_raw"), folder, ["ID.", "NPS.", "Área.", "Área."])
    sheet = read_sheet(spark, folder, ordinal=True)
    roles = {"id": "A", "nps_raw": "B", "dem_segment_raw": "C", "dem_status_raw": "D"}
    return demo.demographic_report(wide_to_canonical(sheet.rows, {}, roles, "row_ord")[0], fx.FIXTURE_DEMOGRAPHICS)


def q_demographic_free_text(spark, sf_dir):
    """A free-text demographic with as many labels as rows beside one with few."""
    o = fx.table(spark, sf_dir, "orders")
    r = o.select(F.col("o_orderkey").alias("row_ord"), F.lit("Pasivo").alias("nps_raw"), F.col("o_orderpriority").alias("few"),
                 F.concat_ws(" ", F.lit("pedido"), F.col("o_orderkey").cast("string"), F.col("o_orderpriority")).alias("many"))
    groups = [DemographicGroup("FEW", "few", (), {}), DemographicGroup("MANY", "many", (), {})]
    return demo.with_index(demo.label_table(r, groups)).select("index", "grupo", "label", F.col("general").cast("bigint").alias("general"), "first_seen")


def _mapping_file(spark, name, content):
    """A mapping file in the shared stage folder."""
    path = stage_path(spark, name)
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.text(path)
    return path


def q_demographic_mapped(spark, sf_dir):
    """Groups, and the NPS column as a default, from a mapping file; labels with their prefix."""
    mapping = {"defaults": {"npsColumn": "nps_raw"}, "groups": [
        {"group": g.group, "column": g.column, "order": list(g.order), "normalize": dict(g.normalize)} for g in fx.FIXTURE_DEMOGRAPHICS]}
    groups, defaults = demographic_groups(read_demographic_json(spark, _mapping_file(spark, "demographics", mapping)))
    return demo.demographic_report(fx.respondents(spark, sf_dir), groups, defaults["npsColumn"], label_mode="prefixed")


def q_hierarchy_mapped(spark, sf_dir):
    """The tree from a mapping file with columns as comma-separated text and the aggregation as a default."""
    mapping = {"defaults": {"groupAggregation": "unweighted"}, "rows": [
        {"label": n.label, "kind": n.kind, "columns": " , ".join(n.columns), "children": list(n.children)} for n in fx.FIXTURE_HIERARCHY]}
    nodes, defaults = hierarchy_nodes(read_hierarchy_json(spark, _mapping_file(spark, "hierarchy", mapping)))
    return hierarchy_report(fx.answers(spark, sf_dir), nodes, defaults["groupAggregation"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "nps_overall": q_nps_overall,
    "nps_by_cohort": q_nps_by_cohort,
    "nps_category_pct": q_nps_category_pct,
    "cohort_share": q_cohort_share,
    "satisfaction_by_cohort": q_satisfaction_by_cohort,
    "responded_count": q_responded_count,
    "question_scores": q_question_scores,
    "axis_scores": q_axis_scores,
    "climate_index": q_climate_index,
    "survey_kpis": q_survey_kpis,
    "survey_kpis_by_id": q_survey_kpis_by_id,
    "question_matrix": q_question_matrix,
    "question_matrix_template": q_question_matrix_template,
    "label_match": q_label_match,
    "label_match_ratcliff": q_label_match_ratcliff,
    "label_match_many": q_label_match_many,
    "label_unmatched": q_label_unmatched,
    "name_resolve": q_name_resolve,
    "name_resolve_ratcliff": q_name_resolve_ratcliff,
    "hierarchy_rollup": q_hierarchy_rollup,
    "demographic_counts": q_demographic_counts,
    "demographic_nps": q_demographic_nps,
    "demographic_display": q_demographic_display,
    "share_apportioned": q_share_apportioned,
    "nps_share_apportioned": q_nps_share_apportioned,
    "demographic_report": q_demographic_report,
    "id_filter": q_id_filter,
    "id_filter_semi": q_id_filter_semi,
    "row_nonblank": q_row_nonblank,
    "label_normalize": q_label_normalize,
    "text_normalize": q_text_normalize,
    "numeric_coerce_clip": q_numeric_coerce_clip,
    "scale_convert": q_scale_convert,
    "positional_select": q_positional_select,
    "comments_projection": q_comments_projection,
    "comments_by_id": q_comments_by_id,
    "report_roundtrip": q_report_roundtrip,
    "report_publish": q_report_publish,
    "report_versions": q_report_versions,
    "number_forms": q_number_forms,
    "sheet_question_matrix": q_sheet_question_matrix,
    "sheet_kpis": q_sheet_kpis,
    "sheet_csv_read": q_sheet_csv_read,
    "sheet_csv_rejects": q_sheet_csv_rejects,
    "sheet_row_ordinal": q_sheet_row_ordinal,
    "sheet_demographics": q_sheet_demographics,
    "demographic_free_text": q_demographic_free_text,
    "demographic_mapped": q_demographic_mapped,
    "hierarchy_mapped": q_hierarchy_mapped,
}
