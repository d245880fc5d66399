"""All five reports from one letter-addressed survey sheet (the classic layout).

The sheet is split into canonical respondents (``layout.split_sheet``) and the answers' sums by question and spelling of cohort and
NPS answer (``cuboid.sheet_cuboid``); every report then reads one of those two DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cuboid import sheet_cuboid
from ..operators.hierarchy import hierarchy_report
from ..operators.segments import filter_ids
from ..sources import layout
from ..sources.dims import DemographicGroup, HierarchyNode
from ..sources.letters import by_position, index_to_letter, position_name, select_letters
from ..sources.sheets import Sheet
from .demographics import demographic_report
from .kpis import survey_kpis
from .question_matrix import question_matrix


def sheet_reports(sheet: DataFrame | Sheet, hierarchy: Sequence[HierarchyNode] = (),
                  demographics: Sequence[DemographicGroup] = (), universe: DataFrame | float | None = None,
                  template: DataFrame | None = None, ids: Iterable | None = None, row_ord_col: str | None = None,
                  label_mode: str = "raw", default_agg: str = "unweighted") -> dict[str, DataFrame]:
    """{"consolidado", "por_pregunta", "indice_clima", "demografia", "comentarios"} -> DataFrame.

    Columns are addressed by position alone, so labels may hold anything and repeat. An ID filter cuts the sheet
    itself, before it is unpivoted. The demographic report orders categories by their first row: ``row_ord_col`` names
    the ordinal; a ``Sheet`` read with ``ordinal=True`` has its own.
    """
    if isinstance(sheet, Sheet):
        sheet, row_ord_col = sheet.rows, row_ord_col or ("row_ord" if "row_ord" in sheet.rows.columns else None)
    if row_ord_col:     # behind the cells, where it takes no letter
        at = sheet.columns.index(row_ord_col)
        sheet = by_position(sheet)
        sheet = sheet.select(*sheet.columns, F.col(f"c{at}").alias("row_ord"))
        sheet, row_ord_col = (sheet.drop(f"c{at}") if at == len(sheet.columns) - 2 else sheet), "row_ord"
    else:
        sheet = by_position(sheet)
    if ids:
        sheet = filter_ids(sheet, ids, position_name(sheet, layout.ROLE_LETTERS["id"]))
    demo_groups = layout.resolve_groups(sheet, list(demographics))
    # Demographic columns are kept in the respondents table under their position's name.
    roles = {g.column: index_to_letter(int(g.column[1:])) for g in demo_groups if g.column in sheet.columns}
    respondents, _ = layout.split_sheet(sheet, row_ord_col, roles)
    # The answers are only ever added up: per column of the sheet, before they become rows. The reports below share the small table.
    place = {q: position_name(sheet, letter) for q, letter in layout.answer_letters().items()}
    answers = sheet_cuboid(sheet, {q: c for q, c in place.items() if c}, position_name(sheet, layout.ROLE_LETTERS["cohort_raw"]),
                           position_name(sheet, layout.ROLE_LETTERS["nps_raw"]))
    questions, members = layout.kpi_questions()
    out = {
        "consolidado": survey_kpis(respondents, answers, questions, universe=universe,
                                   conditions_col="conditions_raw", axis_members=members),
        "por_pregunta": question_matrix(answers, None, layout.matrix_questions(), template=template),
        "comentarios": select_letters(sheet, layout.COMMENT_LETTERS, missing=""),
    }
    if hierarchy:
        out["indice_clima"] = hierarchy_report(answers, list(hierarchy), default_agg)
    if demo_groups:
        if not row_ord_col:
            raise ValueError("the demographic report needs row_ord_col, or a sheet read with ordinal=True: categories are ordered by their first row")
        out["demografia"] = demographic_report(respondents, demo_groups, "nps_raw", None, label_mode)
    return out
