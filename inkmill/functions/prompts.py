"""Prompt templates and their rendering as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REWRITE = "Convierte el contenido en prosa continua en español. Describe las tablas con frases y no omitas ninguna cifra. Empieza directamente, sin presentación.\n\nContenido:\n{text}\n"
SUMMARIZE = "Resume el contenido como lista Markdown. Si es una tabla, enumera lo que relacionan sus celdas y salta las vacías.\n\nContenido:\n{text}\n"
QUESTIONS_AND_ANSWERS = "Escribe de una a tres preguntas distintas sobre el párrafo, cada una con su respuesta completa en español. Usa únicamente lo que dice el párrafo.\n\nPárrafo:\n{text}"
REASONING = "Resuelve el problema. Escribe primero tu razonamiento detallado entre <think> y </think>, y después solo la respuesta final.\n\nProblema: {question}\nSolución esperada: {answer}\nFuente: {source}"
RETRIEVAL_QUESTIONS = "Escribe exactamente {count} preguntas en español que alguien haría a un buscador y que el fragmento responde por sí solo. No repitas ninguna.\n\nFragmento:\n{text}"
VARIANTS = "Escribe {count} reformulaciones en español de la pregunta, con el mismo sentido y otro vocabulario u orden.\n\nPregunta:\n{question}"

TEMPLATES = {"rewrite": REWRITE, "summarize": SUMMARIZE, "qa": QUESTIONS_AND_ANSWERS, "reasoning": REASONING, "questions": RETRIEVAL_QUESTIONS, "variants": VARIANTS}


def _cut(template: str) -> list[tuple[bool, str]]:
    """(is a placeholder, text) parts of a template."""
    parts, rest = [], template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        parts += [(False, before), (True, name)]
    return [p for p in [*parts, (False, rest)] if p[1]]


def render(template: str, **values: Column | str | int) -> Column:
    """The template with each {name} replaced by its value; braces in values stay as they are."""
    column = lambda v: v if isinstance(v, Column) else F.lit(str(v))
    return F.concat(*(F.coalesce(column(values[p]).cast("string"), F.lit("")) if slot else F.lit(p) for slot, p in _cut(template)))


def render_text(template: str, **values: object) -> str:
    return "".join(str(values[p]) if slot else p for slot, p in _cut(template))
