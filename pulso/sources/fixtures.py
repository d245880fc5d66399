"""Canonical survey tables derived from the provided TPC-H-style parquet data.

``respondents`` (one row per order) and ``answers`` (one row per line item)
are built with DataFrame joins and expressions over the given tables, so their
size grows with the data. The same definitions exist as SQL text
(``RESPONDENTS_SQL`` / ``ANSWERS_SQL``) for the independent DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .dims import DemographicGroup, HierarchyNode, Question

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Declared schemas of the provided tables. Reading with a schema skips footer
# inference on the driver (what a catalog-backed table does on a cluster).
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
               "props STRING"),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Raw spellings injected per region (cohort) and per order
# priority (NPS answer), as defined in FIXTURES.md.
_COHORT_SPELLINGS = {
    0: ["Centennials", "centenialls", " Gen Z ", "Generación Z"],
    1: ["Millennials", "milenialls", "GEN Y", "Generación  Y"],
    2: ["Generación X", "generacion x", "Gen X", "X"],
    3: ["Baby Boomers", "BOOMERS", "baby boomer", " Baby  Boomers "],
}
_COHORT_OTHER = [None, "N/A", "-", "Otro"]


def _spark_sql(sql: str, tables: tuple[str, ...]) -> str:
    out = sql.replace("AS VARCHAR", "AS STRING")
    for t in tables:
        out = out.replace(f"FROM {t} ", f"FROM {{{t}}} ").replace(f"JOIN {t} ", f"JOIN {{{t}}} ")
        if out.rstrip().endswith(f"FROM {t}"):
            out = out.rstrip()[: -len(t)] + f"{{{t}}}"
    return out


def respondents(spark: SparkSession, sf_dir: str, native_id: bool = False) -> DataFrame:
    """row_ord, id, cohort_raw, nps_raw, satisfaction_raw, dem_segment_raw, dem_status_raw.

    Built from the FIXTURES.md view definition in one ``spark.sql`` call over
    the schema-declared tables. Catalyst sizes the joins: nation/region (25 / 5
    rows) and, at small scale, customer are broadcast; beyond the broadcast
    threshold customer is sort-merge joined on the customer key. With
    ``native_id`` the id keeps its stored type, so id filters reach the scan.
    """
    names = ("orders", "customer", "nation", "region")
    sql = RESPONDENTS_SQL.replace("CAST(o.o_custkey AS VARCHAR) AS id", "o.o_custkey AS id") if native_id else RESPONDENTS_SQL
    return spark.sql(_spark_sql(sql, names), **{t: table(spark, sf_dir, t) for t in names})


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_ord, question_id, score_raw: quarter-step answers 0.5..4.25 with junk and NULLs."""
    return spark.sql(_spark_sql(ANSWERS_SQL, ("lineitem",)), lineitem=table(spark, sf_dir, "lineitem"))


def _sql_pick(key: str, mod: int, values: list) -> str:
    parts = [f"CASE {key} % {mod}"]
    for i, v in enumerate(values[:-1]):
        parts.append(f" WHEN {i} THEN {_sql_lit(v)}")
    parts.append(f" ELSE {_sql_lit(values[-1])} END")
    return "".join(parts)


def _sql_lit(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _respondents_sql() -> str:
    cohort = "CASE r.r_regionkey" + "".join(
        f" WHEN {r} THEN {_sql_pick('o.o_orderkey', 4, s)}" for r, s in _COHORT_SPELLINGS.items()
    ) + f" ELSE {_sql_pick('o.o_orderkey', 4, _COHORT_OTHER)} END"
    return f"""
SELECT o.o_orderkey AS row_ord, CAST(o.o_custkey AS VARCHAR) AS id,
 {cohort} AS cohort_raw,
 CASE o.o_orderpriority
  WHEN '1-URGENT' THEN CASE o.o_orderkey % 2 WHEN 0 THEN 'Entusiasta' ELSE 'Promotores' END
  WHEN '2-HIGH' THEN 'Entusiastas'
  WHEN '3-MEDIUM' THEN CASE o.o_orderkey % 2 WHEN 0 THEN 'Pasivo' ELSE 'NEUTRAL' END
  WHEN '4-NOT SPECIFIED' THEN CASE o.o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 's/d' ELSE 'No aplica' END
  ELSE CASE o.o_orderkey % 2 WHEN 0 THEN 'Detractor' ELSE ' DETRACTORES ' END END AS nps_raw,
 CASE WHEN o.o_orderkey % 17 = 0 THEN 'N/A' ELSE CAST(1 + o.o_orderkey % 10 AS VARCHAR) END AS satisfaction_raw,
 CASE o.o_orderkey % 3 WHEN 0 THEN c.c_mktsegment
   WHEN 1 THEN concat(upper(substr(c.c_mktsegment,1,1)), lower(substr(c.c_mktsegment,2)))
   ELSE concat('  ', lower(c.c_mktsegment), ' ') END AS dem_segment_raw,
 CASE WHEN o.o_orderkey % 29 = 0 THEN '--' ELSE o.o_orderstatus END AS dem_status_raw
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""


RESPONDENTS_SQL = _respondents_sql()

ANSWERS_SQL = """
SELECT l_orderkey AS row_ord, concat('Q', CAST(l_linenumber AS VARCHAR)) AS question_id,
 CASE WHEN CAST(l_quantity AS BIGINT) % 13 = 0 THEN 'n/a' WHEN CAST(l_quantity AS BIGINT) % 11 = 0 THEN NULL
   ELSE CAST(0.5e0 + (CAST(l_quantity AS BIGINT) % 16) / 4e0 AS VARCHAR) END AS score_raw
FROM lineitem"""


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the fixture views it needs as CTEs."""
    defs = {"respondents": RESPONDENTS_SQL, "answers": ANSWERS_SQL}
    ctes = ",\n".join(f"{n} AS ({defs[n]})" for n in names)
    return f"WITH {ctes}\n{sql}"


# --- Small dimensions of the fixture -------------------------------------------

# Question labels of the first seven survey questions, used as the
# fixture's question dimension (Q1..Q7) and grouped into three axes.
FIXTURE_QUESTIONS = [
    Question("Q1", "Me siento orgulloso(a) cuando le cuento a otros que estoy trabajando en esta Organización.", "A1"),
    Question("Q2", "Recomendaría a otros trabajar en esta Organización.", "A1"),
    Question("Q3", "Me parece inspiradora la misión de la Organización y estoy comprometido (a) con ella.", "A2"),
    Question("Q4", "Comprendo los objetivos de la organización y sé cómo puedo aportar a conseguirlos desde mi cargo.", "A2"),
    Question("Q5", "Se reciben beneficios no monetarios que hacen más agradable la experiencia en la Organización.", "A3"),
    Question("Q6", "Se realizan actividades de bienestar que brindan espacios de esparcimiento para el empleado y su familia.", "A3"),
    Question("Q7", "Las características de mi trabajo me permiten tener un adecuado balance entre mi trabajo y mi vida personal.", "A3"),
]
FIXTURE_AXES = ("A1", "A2", "A3")

FIXTURE_HIERARCHY = [
    HierarchyNode("Index", "group", ("Q1",), ("A1", "A2", "A3"), "unweighted"),
    HierarchyNode("A1", "group", ("Q1", "Q2"), ("Q1", "Q2"), "unweighted"),
    HierarchyNode("Q1", "value", ("Q1",)),
    HierarchyNode("Q2", "value", ("Q2",)),
    HierarchyNode("A2", "group", ("Q3", "Q4"), ("Q3", "Q4"), "unweighted"),
    HierarchyNode("Q3", "value", ("Q3",)),
    HierarchyNode("Q4", "value", ("Q4",)),
    HierarchyNode("A3", "group", ("Q5", "Q6", "Q7"), ("Q5", "Q6", "Q7"), "unweighted"),
    HierarchyNode("Q5", "value", ("Q5",)),
    HierarchyNode("Q6", "value", ("Q6",)),
    HierarchyNode("Q7", "value", ("Q7",)),
]

FIXTURE_DEMOGRAPHICS = [
    DemographicGroup("SEGMENT", "dem_segment_raw",
                     ("0 Automobile", "1 Building", "2 Furniture", "3 Household"),
                     {"building": "1 Building"}),
    DemographicGroup("STATUS", "dem_status_raw", (), {}),
    DemographicGroup("UNMAPPED", "?", ("0 No", "1 Sí"), {}),
]
