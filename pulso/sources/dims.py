"""Small configuration dimensions: vocabularies, question layout, hierarchy, demographics.

These are configuration, not data: a few dozen entries that fix the shape of
a report. They are applied as literal ``CASE``/``IN`` expressions or as
broadcast joins of a fixed, tiny size. Loaders for the JSON mapping files
(S3) and template tables (S4) live here too.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Accepted spellings of each generation cohort (compared after
# label normalisation), used by the KPI row and the question matrix.
COHORT_VARIANTS: dict[str, tuple[str, ...]] = {
    "centenialls": ("centenialls", "centennials", "centennial", "centenials", "centenial",
                    "generacion z", "generación z", "gen z", "z"),
    "milenialls": ("milenialls", "millennials", "millenials", "millennial", "millenial",
                   "generacion y", "generación y", "gen y", "y"),
    "generacion x": ("generacion x", "generación x", "gen x", "x"),
    "baby boomers": ("baby boomers", "baby boomer", "babyboomers", "babyboomer", "boomers", "boomer"),
}

# NPS class spellings (normalised).
PROMOTER_VARIANTS = ("entusiasta", "entusiastas", "promotor", "promotores", "promoter", "promoters")
PASSIVE_VARIANTS = ("pasivo", "pasivos", "neutral", "neutrales", "indiferente", "indiferentes")
DETRACTOR_VARIANTS = ("detractor", "detractores")
NPS_VARIANTS: dict[str, tuple[str, ...]] = {
    "promoter": PROMOTER_VARIANTS,
    "passive": PASSIVE_VARIANTS,
    "detractor": DETRACTOR_VARIANTS,
}
# ---------------------------------------------------------------------------

# Output column suffixes for the four cohorts, in report order.
COHORT_KEYS = ("centenialls", "milenialls", "generacion x", "baby boomers")
COHORT_SLUG = {
    "centenialls": "centenialls",
    "milenialls": "milenialls",
    "generacion x": "generacion_x",
    "baby boomers": "baby_boomers",
}
NPS_KEYS = ("promoter", "passive", "detractor")


@dataclass(frozen=True)
class Question:
    question_id: str
    label: str
    axis: str | None = None


@dataclass(frozen=True)
class HierarchyNode:
    label: str
    kind: str  # "group" | "value"
    columns: tuple[str, ...] = ()
    children: tuple[str, ...] = ()
    group_aggregation: str | None = None


@dataclass(frozen=True)
class DemographicGroup:
    group: str
    column: str | None
    order: tuple[str, ...] = ()
    normalize: dict[str, str] = field(default_factory=dict)


def question_dim(spark: SparkSession, questions: list[Question]) -> DataFrame:
    schema = "question_id STRING, label STRING, axis STRING, ord INT"
    rows = [(q.question_id, q.label, q.axis, i) for i, q in enumerate(questions)]
    return spark.createDataFrame(rows, schema)


# --- S3: JSON mapping sources -------------------------------------------------

def parse_letters(value) -> list[str]:
    """P5: a list of letters, or one comma-separated string."""
    if value is None:
        return []
    if isinstance(value, str):
        return [x.strip() for x in value.split(",") if x.strip()]
    return [str(x).strip() for x in value if str(x).strip()]


def load_hierarchy_mapping(path: str | Path) -> tuple[list[HierarchyNode], dict]:
    """Read a hierarchy mapping file ({"rows": [...], "defaults": {...}})."""
    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(f"mapping file not found: {p}")
    data = json.loads(p.read_text(encoding="utf-8"))
    defaults = data.get("defaults", {}) or {}
    nodes = [
        HierarchyNode(
            label=r["label"],
            kind=r.get("kind", "value"),
            columns=tuple(parse_letters(r.get("columns"))),
            children=tuple(r.get("children", []) or []),
            group_aggregation=r.get("groupAggregation"),
        )
        for r in data.get("rows", [])
    ]
    return nodes, defaults


def load_demographic_mapping(path: str | Path) -> tuple[list[DemographicGroup], dict]:
    """Read a demographic mapping file ({"groups": [...], "defaults": {...}})."""
    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(f"mapping file not found: {p}")
    data = json.loads(p.read_text(encoding="utf-8"))
    groups = [
        DemographicGroup(
            group=g["group"],
            column=g.get("column"),
            order=tuple(g.get("order", []) or []),
            normalize=dict(g.get("normalize", {}) or {}),
        )
        for g in data.get("groups", [])
    ]
    return groups, data.get("defaults", {}) or {}


def _mapping_rows(spark: SparkSession, path: str, key: str, fields: str) -> DataFrame:
    """The entries of a mapping file on any storage Spark reads, numbered in file order, with its defaults."""
    schema = f"{key} ARRAY<STRUCT<{fields}>>, defaults MAP<STRING, STRING>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    return raw.select(F.posexplode(key).alias("ord", "r"), F.coalesce("defaults", F.create_map().cast("map<string,string>")).alias("defaults"))


def read_hierarchy_json(spark: SparkSession, path: str) -> DataFrame:
    """S3: node_ord, label, kind, columns, children, group_aggregation, defaults of a hierarchy mapping.

    ``columns`` may be a list or one comma-separated string, as in P5.
    """
    rows = _mapping_rows(spark, path, "rows", "label STRING, kind STRING, columns STRING, children ARRAY<STRING>, groupAggregation STRING")
    text = F.trim("r.columns")  # a JSON list arrives as its text
    items = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.split(text, ","))
    columns = F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")
    none = F.array().cast("array<string>")
    return rows.select(F.col("ord").alias("node_ord"), "r.label", F.coalesce("r.kind", F.lit("value")).alias("kind"),
                       F.coalesce(columns, none).alias("columns"), F.coalesce("r.children", none).alias("children"),
                       F.col("r.groupAggregation").alias("group_aggregation"), "defaults")


def read_demographic_json(spark: SparkSession, path: str) -> DataFrame:
    """S3: group_ord, group, column, order, normalize, defaults of a demographic mapping."""
    rows = _mapping_rows(spark, path, "groups", "`group` STRING, `column` STRING, `order` ARRAY<STRING>, normalize MAP<STRING, STRING>")
    return rows.select(F.col("ord").alias("group_ord"), "r.group", "r.column", F.coalesce("r.order", F.array().cast("array<string>")).alias("order"),
                       F.coalesce("r.normalize", F.create_map().cast("map<string,string>")).alias("normalize"), "defaults")


def hierarchy_nodes(mapping: DataFrame) -> tuple[list[HierarchyNode], dict]:
    """A hierarchy mapping table (configuration: a few dozen rows) as plan-time nodes and defaults."""
    rows = mapping.orderBy("node_ord").collect()
    nodes = [HierarchyNode(r["label"], r["kind"], tuple(r["columns"]), tuple(r["children"]), r["group_aggregation"]) for r in rows]
    return nodes, dict(rows[0]["defaults"]) if rows else {}


def demographic_groups(mapping: DataFrame) -> tuple[list[DemographicGroup], dict]:
    """A demographic mapping table (configuration: a few dozen rows) as plan-time groups and defaults."""
    rows = mapping.orderBy("group_ord").collect()
    groups = [DemographicGroup(r["group"], r["column"], tuple(r["order"]), dict(r["normalize"])) for r in rows]
    return groups, dict(rows[0]["defaults"]) if rows else {}


# --- S4: template metadata ----------------------------------------------------

TEMPLATE_COLUMNS = ("index", "Pregunta", "Clima", "IFE", "PESO")


def template_from_table(df: DataFrame) -> DataFrame | None:
    """Keep the known template columns, trim texts, coerce the weight.

    Returns None when none of the known columns exist (caller falls back to
    the question dimension). The order of the rows is the source column
    ``template_ord``, else the numeric ``index``; a table has no order of its own.
    """
    from ..functions.numeric import to_number

    present = [c for c in TEMPLATE_COLUMNS if c in df.columns]
    if not present:
        return None
    out = df
    if "template_ord" not in out.columns:
        if "index" not in present:
            raise ValueError("a template needs template_ord or index: its rows are reported in order")
        out = out.withColumn("template_ord", F.trim(F.col("index").cast("string")).try_cast("double"))
    cols = [F.col("template_ord")]
    for name, alias in (("index", "index"), ("Pregunta", "question"), ("Clima", "clima"), ("IFE", "ife")):
        cols.append((F.trim(F.col(name).cast("string")) if name in present else F.lit(None).cast("string")).alias(alias))
    cols.append((to_number(F.col("PESO")) if "PESO" in present else F.lit(None).cast("double")).alias("weight"))
    return out.select(*cols)
