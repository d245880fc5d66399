"""Preset for the classic survey worksheet layout (columns addressed by letter).

A worksheet exported to Parquet/CSV keeps its column positions; these fixed
letters say where each role lives, so the five reports run on such a sheet
without any per-survey configuration. Everything here is plan-time data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .dims import DemographicGroup, Question
from .letters import letter_range, position_name, wide_to_canonical

# Column letters of the respondent roles.
ROLE_LETTERS = {
    "id": "A",
    "satisfaction_raw": "E",
    "conditions_raw": "G",
    "comment_raw": "H",
    "cohort_raw": "GU",
    "nps_raw": "GV",
}

# The five axes (own column, sub-component columns) and the
# question blocks displayed under each axis in the KPI row.
AXES = (
    ("IB", ("IC", "ID", "IE", "IF"), ("AL", "AS")),
    ("IG", ("IH", "II", "IJ", "IK"), ("AU", "BB")),
    ("IL", ("IM", "IN", "IO", "IP"), ("BD", "BK")),
    ("IQ", ("IR", "IS", "IT", "IU"), ("BM", "BT")),
    ("IV", ("IW", "IX", "IY", "IZ"), ("BV", "CC")),
)

# Letters of the comment extract, in output order.
COMMENT_LETTERS = {
    "id": "A",
    "variable_1": "CM",
    "variable_2": "CL",
    "variable_3": "GS",
    "tipo_nps": "GV",
    "generacion": "GU",
    "antiguedad": "CI",
    "tipo_contrato": "CJ",
    "comentarios": "H",
}

# Question labels of the question-matrix report and the column
# letter each one reads (template rows are matched against these labels).
QUESTION_LABELS = [
    ("IB", "¿Cómo es trabajar en la organización?"),
    ("AL", "Me siento orgulloso(a) cuando le cuento a otros que estoy trabajando en esta Organización."),
    ("AM", "Recomendaría a otros trabajar en esta Organización."),
    ("AN", "Me parece inspiradora la misión de la Organización y estoy comprometido (a) con ella."),
    ("AO", "Comprendo los objetivos de la organización y sé cómo puedo aportar a conseguirlos desde mi cargo."),
    ("AP", "Se reciben beneficios no monetarios que hacen más agradable la experiencia en la Organización."),
    ("AQ", "Se realizan actividades de bienestar que brindan espacios de esparcimiento para el empleado y su familia."),
    ("AR", "Las características de mi trabajo me permiten tener un adecuado balance entre mi trabajo y mi vida personal."),
    ("AS", "La empresa demuestra sensibilidad con las particularidades de la vida personal de sus empleados."),
    ("IG", "¿Cómo lo soporta para lograr los resultados de su cargo?"),
    ("IL", "¿Cómo es la dinámica del trabajo conjunto para lograr resultados?"),
    ("AU", "Cuento con los recursos mínimos que requiero para realizar de forma adecuada mi trabajo."),
    ("AV", "Puedo acceder a toda la información que necesito para hacer bien mi trabajo."),
    ("AW", "Siento que mi cargo me brinda la oportunidad de progresar y desarrollarme."),
    ("AX", "Todos en la organización tienen claro su cargo y comprenden bien el alcance de sus responsabilidades."),
    ("AY", "La formación que brinda la Organización realmente me ayuda a realizar mejor mi trabajo."),
    ("AZ", "El entrenamiento que recibo en mi cargo me ayuda a progresar a nivel personal y profesional."),
    ("BA", "Me evalúan por mi desempeño y tengo opciones de recibir reconocimiento si he realizado un esfuerzo por hacer mi trabajo de manera sobresaliente."),
    ("BB", "En esta Organización celebramos los éxitos y nos felicitamos por los logros obtenidos."),
    ("BD", "La comunicación entre áreas fluye de manera adecuada."),
    ("BE", "Mi jefe se comunica de forma clara y verifica que yo haya comprendido lo que me dice."),
    ("BF", "Conozco personas de diferentes áreas a la mía y se puede trabajar en un entorno agradable, de camaradería y cooperación."),
    ("BG", "En mi área se facilita y promueve el trabajo en equipo, la integración y la colaboración entre compañeros."),
    ("BH", "En la Organización las decisiones se toman de forma oportuna y no se aplazan decisiones importantes."),
    ("BI", "Las decisiones que se toman en la organización se hacen con base en análisis completos y sistemáticos."),
    ("BJ", "Los líderes en la organización inspiran, motivan a los equipos y dan ejemplo con su comportamiento."),
    ("BK", "Los jefes forman a sus colaboradores y les dan una adecuada y oportuna retroalimentación sobre su desempeño."),
    ("IQ", "¿Cómo es la cultura?"),
    ("BM", "Los jefes y directivos son cordiales y respetuosos en el trato con personas de todos los niveles en la Organización."),
    ("BN", "Puedo dar mi punto de vista y sugerencias a la organización sabiendo que de ser posible se van a tener en cuenta."),
    ("BO", "Siento que las relaciones en esta Organización se establecen sobre la base de la confianza en las personas."),
    ("BP", "Puedo determinar formas propias de hacer mis labores mientras cumpla con las políticas de la Organización."),
    ("BQ", "En esta Organización el trato es justo y equitativo, sin discriminaciones por género, edad, raza u orientación sexual."),
    ("BR", "En esta Organización se evita que se utilice la intimidación y el hostigamiento para inducir la renuncia de algún empleado."),
    ("BS", "Yo quiero a la Organización y me siento comprometido con mi trabajo."),
    ("BT", "Me gusta mi trabajo y siento que estoy haciendo algo de valor para la Organización."),
    ("IV", "¿Cómo genera un ambiente sano, limpio y seguro?"),
    ("BV", "Puedo desempeñar mi trabajo de forma segura y cómoda en cuanto a temperatura, sonido, espacio e iluminación."),
    ("BW", "Puedo manejar el estrés que se genera en mi trabajo para evitar que se afecte mi salud."),
    ("BX", "Los procesos de la organización cuentan con controles efectivos de calidad."),
    ("BY", "Se revisa de forma constante la calidad de los procesos y servicios en busca de un mejoramiento continuo."),
    ("BZ", "Se nota una sensibilidad en la Organización por cuidar el impacto que su operación pueda generar en el medio ambiente."),
    ("CA", "La Organización implementa políticas y/o procedimientos para que los empleados cuidemos el medio ambiente."),
    ("CB", "La Organización contrata empleados y proveedores cumpliendo con todas los requisitos legales y pagando oportunamente."),
    ("CC", "La Organización cuida el impacto que puede tener en la comunidad en donde opera y busca aportar a la misma."),
]


def kpi_questions() -> tuple[list[Question], dict[str, list[str]]]:
    """(40 displayed questions grouped by axis, axis -> sub-component letters)."""
    questions, members = [], {}
    for axis, subs, (first, last) in AXES:
        members[axis] = list(subs)
        questions += [Question(letter, letter, axis) for letter in letter_range(first, last)]
    return questions, members


def matrix_questions() -> list[Question]:
    """The 45 labelled rows of the question matrix (question id = column letter)."""
    return [Question(letter, label) for letter, label in QUESTION_LABELS]


def answer_letters() -> dict[str, str]:
    """Every Likert column a report reads: questions, axis columns, sub-components."""
    letters = {}
    for axis, subs, (first, last) in AXES:
        for lt in [axis, *subs, *letter_range(first, last)]:
            letters[lt] = lt
    return letters


def split_sheet(sheet: DataFrame, row_ord_col: str | None = None,
                extra_roles: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(respondents, answers) of a letter-addressed sheet; question ids are the letters."""
    roles = dict(ROLE_LETTERS)
    roles.update(extra_roles or {})
    return wide_to_canonical(sheet, answer_letters(), roles, row_ord_col)


def resolve_groups(sheet: DataFrame, groups: list[DemographicGroup]) -> list[DemographicGroup]:
    """Demographic groups with their letters replaced by positions of the sheet, ``by_position``
    (unresolvable letters such as '?' stay as they are and are skipped later)."""
    out = []
    for g in groups:
        name = position_name(sheet, g.column) if g.column and g.column != "?" else None
        out.append(DemographicGroup(g.group, name or g.column, g.order, g.normalize))
    return out
