"""Hierarchical rollup of Likert columns.

The tree is configuration (a mapping file of a few dozen nodes); its shape
(roots, heights, depth-first visit order) is resolved when the plan is built.
The data work is one aggregate of the answers per column; every level above
is a join + group-by over at most (#nodes x #children) rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.numeric import TEN_OVER_THREE, likert_score, zero_as_null
from ..sources.dims import HierarchyNode


def roots(nodes: Sequence[HierarchyNode]) -> list[str]:
    """Labels that are nobody's child, in mapping order."""
    children = {c for n in nodes for c in n.children}
    return [n.label for n in nodes if n.label not in children]


def visit_order(nodes: Sequence[HierarchyNode]) -> list[str]:
    """O3: depth-first pre-order from each root; a node under two parents is visited twice."""
    index = {n.label: n for n in nodes}
    out: list[str] = []

    def visit(label: str, path: tuple[str, ...]) -> None:
        if label in path:
            raise ValueError(f"cycle in hierarchy at {label!r}")
        node = index[label]
        out.append(label)
        if node.kind == "group":
            for ch in node.children:
                visit(ch, path + (label,))

    for r in roots(nodes):
        visit(r, ())
    return out


def heights(nodes: Sequence[HierarchyNode], default_agg: str = "unweighted") -> dict[str, int]:
    """Height of each node among the edges that are actually rolled up; a cycle or a child without a row is an error."""
    index = {n.label: n for n in nodes}
    height: dict[str, int] = {}
    for n in nodes:
        todo, open_ = [n.label], set()
        while todo:
            label = todo[-1]
            if label not in index:
                raise ValueError(f"hierarchy has no row for the child {label!r}")
            kids = _rolled_children(index[label], default_agg)
            waiting = [c for c in kids if c not in height]
            if waiting and label not in height:
                if label in open_:
                    raise ValueError(f"cycle in hierarchy at {label!r}")
                open_.add(label)
                todo += waiting
                continue
            height[label] = 1 + max(height[c] for c in kids) if kids else 0
            open_.discard(label)
            todo.pop()
    return height


def _rolled_children(n: HierarchyNode, default_agg: str) -> tuple[str, ...]:
    agg = (n.group_aggregation or default_agg or "unweighted").lower()
    if n.kind == "group" and n.children and agg == "unweighted":
        return n.children
    return ()


def column_means(answers: DataFrame, score_col: str = "score_raw", column_col: str = "question_id") -> DataFrame:
    """Per source column: mean of the clipped 1..4 values (columns without data are absent)."""
    if "s_sum" in answers.columns:      # added up already, as by ``cuboid.sheet_cuboid``
        mean = exact.likert_mean(F.sum("s_sum"), F.sum("s_cnt"))
        return answers.groupBy(F.col(column_col).alias("column")).agg(mean.alias("col_mean")).filter(F.col("col_mean").isNotNull())
    s = likert_score(F.col(score_col))
    return (answers.groupBy(F.col(column_col).alias("column"))
            .agg(exact.likert_mean(exact.likert_sum(s), F.count(s)).alias("col_mean"))
            .filter(F.col("col_mean").isNotNull()))


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _mean_nonzero_sql(values: list[str]) -> str:
    """Mean of the values that are non-NULL and != 0 (in child order); NULL if none."""
    total = " + ".join(f"(CASE WHEN {v} != 0 THEN {v} ELSE 0.0D END)" for v in values)
    count = " + ".join(f"(CASE WHEN {v} != 0 THEN 1 ELSE 0 END)" for v in values)
    return f"(CASE WHEN ({count}) > 0 THEN ({total}) / ({count}) END)"


def _conv10_sql(e4: str) -> str:
    return f"bround((bround({e4}, 1) - 1.0D) * {TEN_OVER_THREE!r}D, 1)"


def _rollup_row(col_means: DataFrame, nodes: Sequence[HierarchyNode], default_agg: str) -> DataFrame:
    """One row with columns r{i}, e4_{i}, e10_{i} per node i; 0.0 means "no data".

    value node: real = mean of its columns' means, scale4 = round(real, 1),
    scale10 = C8(scale4). group node (unweighted, with children): each measure
    is the mean of the children's values > 0 (scale4/scale10 re-rounded to 1
    dp, real unrounded); if no child is valid in any measure, or the group is
    not rolled up, the group's own columns are used as for a value node.

    The tree is configuration, so every node becomes three columns of a single
    row: one conditional aggregate over the (configured) column means gives
    each node's own-column mean, and each level of the tree is a projection
    over its children's columns - no joins and no per-level shuffles. The
    expressions are SQL text, parsed once per projection on the JVM side.
    """
    idx = {n.label: i for i, n in enumerate(nodes)}
    wanted = sorted({c.lower() for n in nodes for c in n.columns})
    cm = (col_means.select(F.lower(F.col("column")).alias("column"), "col_mean")
          .filter(F.col("column").isin(wanted or [""])))

    def in_list(cols) -> str:
        return ", ".join(_sql_str(c.lower()) for c in cols) or "''"

    row = cm.agg(*[F.expr(f"avg(CASE WHEN column IN ({in_list(n.columns)}) THEN col_mean END)").alias(f"o{i}")
                   for i, n in enumerate(nodes)])
    # Own-column scores; no column with data -> (0, 0, 0), not C8(0).
    exprs = []
    for i in range(len(nodes)):
        exprs += [f"coalesce(o{i}, 0.0D) AS r{i}", f"coalesce(bround(o{i}, 1), 0.0D) AS e4_{i}",
                  f"coalesce({_conv10_sql(f'bround(o{i}, 1)')}, 0.0D) AS e10_{i}"]
    row = row.selectExpr(*exprs)
    h = heights(nodes, default_agg)
    for level in range(1, max(h.values(), default=0) + 1):
        changed = {}
        for lab in [lab for lab, v in h.items() if v == level]:
            i = idx[lab]
            kids = [idx[c] for c in _rolled_children(nodes[i], default_agg)]
            cr = _mean_nonzero_sql([f"r{k}" for k in kids])
            c4 = _mean_nonzero_sql([f"e4_{k}" for k in kids])
            c10 = _mean_nonzero_sql([f"e10_{k}" for k in kids])
            valid = f"({cr} IS NOT NULL OR {c4} IS NOT NULL OR {c10} IS NOT NULL)"
            changed[f"r{i}"] = f"CASE WHEN {valid} THEN coalesce({cr}, 0.0D) ELSE r{i} END"
            changed[f"e4_{i}"] = f"CASE WHEN {valid} THEN coalesce(bround({c4}, 1), 0.0D) ELSE e4_{i} END"
            changed[f"e10_{i}"] = f"CASE WHEN {valid} THEN coalesce(bround({c10}, 1), 0.0D) ELSE e10_{i} END"
        row = row.selectExpr(*[f"{changed[c]} AS {c}" if c in changed else c for c in row.columns])
    return row


def _inline_nodes(row: DataFrame, items: list[tuple[dict, int]]) -> DataFrame:
    """Unpivot the one-row table into one row per (fixed fields, node index)."""
    structs = []
    for fields, i in items:
        head = ", ".join(f"{_sql_str(k)}, {v if isinstance(v, int) else _sql_str(v)}" for k, v in fields.items())
        structs.append(f"named_struct({head}, 'real', r{i}, 'scale4', e4_{i}, 'scale10', e10_{i})")
    return row.selectExpr(f"inline(array({', '.join(structs)}))")


def hierarchy_report(answers: DataFrame, nodes: Sequence[HierarchyNode], default_agg: str = "unweighted",
                     score_col: str = "score_raw", column_col: str = "question_id") -> DataFrame:
    """node_ord (depth-first visit), node, real (6 dp), scale4, scale10; 0 -> NULL (C17)."""
    wanted = sorted({c.lower() for n in nodes for c in n.columns})
    # Only configured columns are aggregated (the filter is applied before the shuffle).
    sel = answers.filter(F.lower(F.col(column_col)).isin(wanted or [""]))
    row = _rollup_row(column_means(sel, score_col, column_col), nodes, default_agg)
    idx = {n.label: i for i, n in enumerate(nodes)}
    # One output row per visit (a node under two parents appears twice), in depth-first order.
    out = _inline_nodes(row, [({"node_ord": k, "node": lab}, idx[lab]) for k, lab in enumerate(visit_order(nodes))])
    return out.select("node_ord", "node", F.bround(zero_as_null("real"), 6).alias("real"),
                      zero_as_null("scale4").alias("scale4"), zero_as_null("scale10").alias("scale10"))
