"""pulso: survey analytics reports as Spark DataFrame plans.

Main entry points:

* ``pulso.plans.kpis.survey_kpis`` - consolidated KPI row
* ``pulso.plans.question_matrix.question_matrix`` - question x segment scores
* ``pulso.operators.hierarchy.hierarchy_report`` - hierarchical climate index
* ``pulso.plans.demographics.demographic_report`` - demographic x NPS table
* ``pulso.plans.comments.comments_projection`` - comment extract
* ``pulso.plans.sheet.sheet_reports`` - all of the above from one letter-addressed sheet
"""

__version__ = "0.1.0"
