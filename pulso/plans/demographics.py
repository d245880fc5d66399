"""Demographic frequency table x NPS class.

Plan:

1. one ``inline`` unpivot of the configured demographic columns;
2. a pre-aggregate on (group, raw value, raw NPS answer) with the first-seen
   row — map-side partial aggregation collapses the fan-out before the
   shuffle, and a hot value costs one row per map task;
3. label resolution (normalise map, ordered-label auto-map), validity and
   NPS classes on that small table, as literal-map lookups;
4. per (group, label, raw) and per (group, label) aggregates, then the
   largest-remainder windows per group (W1 for the share, W2 for the three
   NPS shares) and the running index over the (tiny) final table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import EMPTY_LIKE, norm_label, plain_label, plain_without_prefix, strip_numeric_prefix
from ..operators.apportion import apportion
from ..operators.numbering import running_index
from ..operators.segments import filter_ids
from ..session import materialize
from ..sources.dims import NPS_VARIANTS, DemographicGroup

_SEP = "\u0001"
_ALL = -1
REPORT_COLUMNS = ("index", "variable", "general", "pct", "detractores", "pasivos", "entusiastas",
                  "pct_detractores", "pct_pasivos", "pct_entusiastas", "grupo")


def _key(group_ord: Column, key: Column) -> Column:
    return F.concat(group_ord.cast("string"), F.lit(_SEP), key)


def _lit_map(d: dict[str, object]) -> Column | None:
    if not d:
        return None
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def active_groups(groups: Sequence[DemographicGroup], columns: Iterable[str]) -> list[tuple[int, DemographicGroup]]:
    """Groups whose source column exists; '?' or missing columns are skipped (plan time)."""
    cols = set(columns)
    return [(i, g) for i, g in enumerate(groups) if g.column and g.column in cols]


def label_table(respondents: DataFrame, groups: Sequence[DemographicGroup], nps_col: str = "nps_raw",
                ids: Iterable | None = None) -> DataFrame:
    """One row per (group, label) present among valid values, with counts and ordering keys.

    Columns: group_ord, grupo, label, display_raw, general, first_seen, order_idx,
    detractores, pasivos, entusiastas, group_total, global_nps.
    """
    sel = filter_ids(respondents, ids)
    active = active_groups(groups, sel.columns)
    elems = [F.struct(F.lit(i).alias("group_ord"), F.col(g.column).cast("string").alias("raw")) for i, g in active]
    if not elems:  # no configured column exists: empty report with the right schema
        elems = [F.struct(F.lit(_ALL).alias("group_ord"), F.lit(None).cast("string").alias("raw"))]
    long = sel.select("row_ord", F.col(nps_col).cast("string").alias("nps_raw"), F.inline(F.array(*elems)))
    pre = long.groupBy("group_ord", "raw", "nps_raw").agg(F.count(F.lit(1)).alias("n"),
                                                          F.min("row_ord").alias("first_row"))
    # Several branches below read this small aggregate; write it once so the
    # respondents are scanned (and unpivoted) a single time.
    pre = materialize(pre, "demographics-pre")

    # NPS class and validity, once per distinct answer spelling.
    nn = norm_label(F.col("nps_raw"))
    cls = None
    for code, key in (("D", "detractor"), ("P", "passive"), ("E", "promoter")):
        cond = nn.isin(*sorted({plain_label(v) for v in NPS_VARIANTS[key]}))
        cls = F.when(cond, F.lit(code)) if cls is None else cls.when(cond, F.lit(code))
    pre = (pre.withColumn("__nn", nn).withColumn("nps_cls", cls)
           .withColumn("nps_valid", F.coalesce(~F.col("__nn").isin(*EMPTY_LIKE), F.lit(False))).drop("__nn"))
    # Survey-wide valid-NPS count: every group's unpivot holds each respondent
    # exactly once, so it is the group's own sum. It is joined back at the end as one
    # row per configured group, so no task ever holds all spellings of a group.
    totals = pre.groupBy("group_ord").agg(
        F.sum(F.when(F.col("nps_valid"), F.col("n")).otherwise(F.lit(0))).alias("global_nps"))
    pre = pre.filter(F.col("group_ord") != _ALL)

    # Label resolution: normalise map (keys normalised too), then ordered-label auto-map.
    g = F.col("group_ord")
    norm_map, order_pos, order_len, auto_map = {}, {}, {}, {}
    for i, grp in active:
        for k, v in grp.normalize.items():
            norm_map[f"{i}{_SEP}{plain_label(k)}"] = v
        order_len[str(i)] = len(grp.order)
        for pos, item in enumerate(grp.order):
            order_pos[f"{i}{_SEP}{item}"] = pos  # later duplicates win, as in a dict
            if item:
                auto_map[f"{i}{_SEP}{plain_label(plain_without_prefix(str(item)))}"] = item  # later entries win
    raw = F.col("raw")
    nmap = _lit_map(norm_map)
    label1 = F.coalesce(F.element_at(nmap, _key(g, norm_label(raw))), raw) if nmap is not None else raw
    pre = pre.withColumn("label1", label1)
    pos_map, amap = _lit_map(order_pos), _lit_map(auto_map)
    in_order = F.element_at(pos_map, _key(g, F.col("label1"))).isNotNull() if pos_map is not None else F.lit(False)
    remapped = F.coalesce(F.element_at(amap, _key(g, norm_label(F.col("label1")))), F.col("label1")) \
        if amap is not None else F.col("label1")
    explicit = [i for i, grp in active if grp.order]
    implicit_with_map = [i for i, grp in active if not grp.order and grp.normalize]
    label = F.when(g.isin(explicit) & ~in_order, remapped).otherwise(F.col("label1")) if explicit else F.col("label1")
    pre = pre.withColumn("label", label)
    if implicit_with_map:
        pre = _remap_implicit(pre, implicit_with_map)

    # Implicit order = first-seen position of the raw value equal to the label.
    first_of_raw = pre.groupBy("group_ord", F.col("raw").alias("label")).agg(F.min("first_row").alias("raw_first"))
    pre = pre.filter(F.coalesce(~norm_label(F.col("label")).isin(*EMPTY_LIKE), F.lit(False)))
    per_raw = pre.groupBy("group_ord", "label", "raw").agg(
        F.sum("n").alias("n_raw"), F.min("first_row").alias("first_raw"),
        *[F.sum(F.when(F.col("nps_cls") == c, F.col("n")).otherwise(F.lit(0))).alias(c) for c in ("D", "P", "E")])
    per_label = per_raw.groupBy("group_ord", "label").agg(
        F.sum("n_raw").alias("general"), F.min("first_raw").alias("first_seen"),
        F.max_by("raw", F.struct(F.col("n_raw"), -F.col("first_raw"))).alias("display_raw"),
        F.sum("D").alias("detractores"), F.sum("P").alias("pasivos"), F.sum("E").alias("entusiastas"))
    per_label = per_label.join(first_of_raw, ["group_ord", "label"], "left")
    big = F.lit(1 << 62)
    olen = _lit_map(order_len)
    explicit_idx = F.coalesce(F.element_at(pos_map, _key(g, F.col("label"))).cast("bigint"),
                              F.element_at(olen, g.cast("string")).cast("bigint")) if pos_map is not None else big
    order_idx = F.when(g.isin(explicit), explicit_idx).otherwise(F.coalesce(F.col("raw_first"), big)) \
        if explicit else F.coalesce(F.col("raw_first"), big)
    names = _lit_map({str(i): grp.group for i, grp in active})
    sizes = per_raw.groupBy("group_ord").agg(F.sum("n_raw").alias("group_total"))
    # At most one row per configured group on the broadcast sides.
    return (per_label.withColumn("order_idx", order_idx)
            .withColumn("grupo", F.element_at(names, g.cast("string")) if names is not None else F.lit(None).cast("string"))
            .join(F.broadcast(totals), "group_ord").join(F.broadcast(sizes), "group_ord")
            .drop("raw_first"))


def _remap_implicit(pre: DataFrame, group_ords: list[int]) -> DataFrame:
    """Empty-order groups with a normalise map: the order is the set of raw values
    (first-seen), so a mapped label outside it is auto-mapped onto a raw value."""
    g = F.col("group_ord")
    raws = (pre.filter(g.isin(group_ords) & F.col("raw").isNotNull())
            .groupBy("group_ord", "raw").agg(F.min("first_row").alias("fr")))
    members = raws.select("group_ord", F.col("raw").alias("label"), F.lit(True).alias("__member"))
    auto = (raws.withColumn("__ak", norm_label(strip_numeric_prefix(F.col("raw"))))
            .groupBy("group_ord", "__ak").agg(F.max_by("raw", "fr").alias("__av")))
    p = pre.join(members, ["group_ord", "label"], "left")
    p = p.join(auto, (p["group_ord"] == auto["group_ord"]) & (norm_label(p["label"]) == auto["__ak"]), "left") \
        .drop(auto["group_ord"])
    fix = g.isin(group_ords) & F.col("__member").isNull() & F.col("__av").isNotNull()
    return p.withColumn("label", F.when(fix, F.col("__av")).otherwise(F.col("label"))).drop("__member", "__ak", "__av")


def with_index(labels: DataFrame) -> DataFrame:
    """W3 + O1/O2/O6: 0-based running index in (group order, label order, count desc, first seen)."""
    order = [F.col("group_ord"), F.col("order_idx"), F.col("general").desc(), F.col("first_seen"), F.col("label")]
    return running_index(labels, order, "index", "demographics")


def nps_shares(labels: DataFrame) -> DataFrame:
    """Class counts over the survey-wide valid NPS count, rounded to 2 dp (before W2)."""
    out = labels
    for c, name in (("detractores", "pct_detractores"), ("pasivos", "pct_pasivos"), ("entusiastas", "pct_entusiastas")):
        out = out.withColumn(name, F.coalesce(F.bround(F.try_divide(F.col(c).cast("double"),
                                                                    F.col("global_nps").cast("double")), 2),
                                              F.lit(0.0)))
    return out


def apportion_share(indexed: DataFrame) -> DataFrame:
    """Category share per group in 1/10000 units, summing to exactly 1.0000."""
    out = apportion(indexed, ["group_ord"], "general", 10000, ["index"], "pct")
    return out.withColumn("pct", F.coalesce("pct", F.lit(0.0)))


def apportion_nps(indexed: DataFrame) -> DataFrame:
    """The three NPS shares of a group rescaled to 100 hundredths over all its rows.

    The row's other columns ride along through the 3-way unpivot and are folded
    back by the same aggregate that pivots the measures, so no join is needed.
    """
    measures = ("pct_detractores", "pct_pasivos", "pct_entusiastas")
    keep = [c for c in indexed.columns if c not in measures and c not in ("group_ord", "index")]
    long = indexed.select("group_ord", "index", F.struct(*keep).alias("__row"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("m_ord"),
                 F.bround(F.col(c) * F.lit(100.0), 0).cast("bigint").alias("h")) for m, c in enumerate(measures)])))
    app = apportion(long, ["group_ord"], "h", 100, ["index", "m_ord"], "v")
    wide = app.groupBy("group_ord", "index").agg(
        F.first("__row").alias("__row"),
        *[F.coalesce(F.max(F.when(F.col("m_ord") == m, F.col("v"))), F.lit(0.0)).alias(c)
          for m, c in enumerate(measures)])
    return wide.select("group_ord", "index", "__row.*", *measures)


def display_label(label_mode: str = "raw") -> Column:
    """C13."""
    if label_mode == "prefixed":
        return F.col("label")
    if label_mode == "no-prefix":
        return strip_numeric_prefix(F.col("label"))
    if label_mode == "raw":
        return F.coalesce(F.col("display_raw"), strip_numeric_prefix(F.col("label")))
    raise ValueError(f"unknown label mode {label_mode!r}")


def demographic_report(respondents: DataFrame, groups: Sequence[DemographicGroup], nps_col: str = "nps_raw",
                       ids: Iterable | None = None, label_mode: str = "raw") -> DataFrame:
    labels = with_index(nps_shares(label_table(respondents, groups, nps_col, ids)))
    out = apportion_nps(apportion_share(labels))
    return out.select("index", display_label(label_mode).alias("variable"),
                      F.col("general").cast("bigint").alias("general"), "pct",
                      *[F.col(c).cast("bigint").alias(c) for c in ("detractores", "pasivos", "entusiastas")],
                      "pct_detractores", "pct_pasivos", "pct_entusiastas", "grupo")
