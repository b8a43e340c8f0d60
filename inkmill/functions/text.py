"""Column functions over Markdown text. All are built-in expressions; `(?U)` gives Java's classes their Unicode meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and marks that define the cleaning.
FIGURE_CAPTION = r"(?Ud)Figura\s+\d+[.|\s*]\s+.*\s+<!-- image -->\s*(?!\s*\|)"
LABEL = r"(?U)(Tabla\s+\d+[.|\s+])|(Figura\s+\d+[.|\s+])"
IMAGE_MARK = "<!-- image -->"
TABLE_LABEL = "Tabla: "
TOPIC_MARK, TABLE_START, CAPTION_MARKERS = "##", "|", ("Table",)
THINKING = r"(?s)<think>.*?</think>\n*"
QUESTION_LINE, ANSWER_LINE = r"\**Q:*\**\s+.+", r"\**A:*\**\s+.+"
# Characters with the property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
MARKDOWN, YAML, CSV = ".md", ".yaml", ".csv"
DOCUMENTS = (".pdf", ".docx")


def normalize_newlines(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def strip(text: Column) -> Column:
    """Unicode white space off both ends, looking at these only."""
    return F.trim(text, F.lit(WHITE_SPACE))


def remove_figure_captions(text: Column) -> Column:
    """Captions followed by an image mark go, unless a table comes next."""
    return F.regexp_replace(text, FIGURE_CAPTION, "")


def normalize_labels(text: Column) -> Column:
    return strip(F.regexp_replace(text, LABEL, TABLE_LABEL))


def collapse_spaces(text: Column) -> Column:
    return strip(F.regexp_replace(text, " +", " "))


def drop_image_marks(text: Column) -> Column:
    return strip(F.replace(text, F.lit(IMAGE_MARK), F.lit("")))


def clean(text: Column) -> Column:
    """The four steps in their order; image marks go after spaces collapse, so double spaces may come back."""
    return drop_image_marks(collapse_spaces(normalize_labels(remove_figure_captions(text))))


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n\n"), lambda p: p != "")


def is_trigger(paragraph: Column, markers: tuple[str, ...] = CAPTION_MARKERS) -> Column:
    found = F.contains(paragraph, F.lit(TOPIC_MARK))
    for marker in markers:
        found = found | F.contains(paragraph, F.lit(marker))
    return found


def is_table(paragraph: Column) -> Column:
    return F.startswith(paragraph, F.lit(TABLE_START))


def relabel_topics(body: Column) -> Column:
    return strip(F.replace(body, F.lit(TOPIC_MARK), F.lit(TABLE_LABEL)))


def header_level(text: Column) -> Column:
    """The highest header level (1 to 6) with a line of its own; 1 where there is none."""
    level = F.when(text.rlike("(?md)^# "), F.lit(1))
    for k in range(2, 7):
        level = level.when(text.rlike(f"(?md)^{'#' * k} "), F.lit(k))
    return level.otherwise(F.lit(1))


def sections(text: Column, level: Column) -> Column:
    """Sections that begin at a header of the level; what stands before the first goes."""
    mark = F.concat(F.repeat(F.lit("#"), level), F.lit(" "))
    starts = F.concat(F.lit("(?md)(?=^"), mark, F.lit("(?!#))"))
    begins = F.concat(F.lit("^"), mark, F.lit("(?!#)"))
    return F.filter(F.split(text, starts), lambda s: F.regexp_like(s, begins))


def header_text(section: Column) -> Column:
    return strip(F.ltrim(F.get(F.split(section, "\n"), F.lit(0)), F.lit("# ")))


def content_id(content: Column) -> Column:
    return F.substring(F.sha2(content, 256), 1, 12)


def summary_headers(summary: Column) -> Column:
    return F.regexp_replace(summary, "#+", "###")


def strip_reasoning(text: Column) -> Column:
    return strip(F.regexp_replace(text, THINKING, ""))


def question_lines(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(QUESTION_LINE), F.lit(0))


def answer_lines(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANSWER_LINE), F.lit(0))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]+)$", 1)


def stem(path: Column) -> Column:
    """The base name without its last extension; a leading dot is no extension."""
    return F.regexp_replace(base_name(path), r"(?<=[^.])\.[^.]*$", "")


def extension(path: Column) -> Column:
    return F.regexp_extract(base_name(path), r"[^.](\.[^.]*)$", 1)
