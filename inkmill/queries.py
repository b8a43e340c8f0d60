"""One query per operator over the driver's tables, each with DuckDB SQL for the same rows.

Markdown is derived from `documents`, one file a document: paragraphs come from its lines, headings and table marks from its
id. Every query takes the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkmill.functions import prompts
from inkmill.functions import text as T
from inkmill.operators import chunks, merge, paragraphs, rag, reasoning, summarize, taxonomy
from inkmill.operators.generate import StubGenerator

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

NL = "chr(10)"
WS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
DOC_PATH = "'/corpus/' || lang || '/doc_' || cast(doc_id as varchar(20)) || '.md'"

#: Markdown with headings, captions and tables; valid in Spark and DuckDB.
MD = f"""(case when doc_id % 5 = 0 then 'Table ' || cast(doc_id as varchar(20)) || ' intro' || {NL} || {NL} else '' end)
 || '## Sec ' || cast(doc_id as varchar(20)) || {NL} || {NL} || (case when doc_id % 3 = 0 then '| ' else '' end)
 || replace(text, {NL}, {NL} || {NL} || (case when doc_id % 4 = 0 then '## Part' || {NL} || {NL} || '| ' else '' end))"""

#: Markdown with a top header level of 1 or 2, and lower headers in every third document.
HASH = "(case when doc_id % 2 = 0 then '#' else '##' end)"
MD_CHUNKS = f"""'before' || {NL} || {HASH} || ' Sec ' || cast(doc_id as varchar(20)) || {NL} || {NL}
 || replace(text, {NL}, {NL} || {NL} || {HASH} || (case when doc_id % 3 = 0 then '# Sub' else ' Part' end) || {NL} || {NL})"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def corpus(spark: SparkSession, sf_dir: str, body: str = MD) -> DataFrame:
    """path, text."""
    return documents(spark, sf_dir).selectExpr(f"{DOC_PATH} as path", f"{body} as text")


def altered(spark: SparkSession, sf_dir: str, body: str, result: Callable[[Column], Column]) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", result(F.expr(body)).alias("text"))


# text functions


@query("select doc_id, text from documents")
def normalize_newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return altered(spark, sf_dir, f"replace(text, {NL}, case when doc_id % 2 = 0 then chr(13) || {NL} else chr(13) end)", T.normalize_newlines)


@query(f"select doc_id, trim(text, {WS}) as text from documents")
def strip_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return altered(spark, sf_dir, f"'\\u00a0 ' || {NL} || text || '\\u2003' || chr(9) || ' '", T.strip)


_CAPTIONS = f"""text || case doc_id % 3 when 0 then {NL} || 'Figura 12. Mapa' || {NL} || {NL} || '<!-- image -->' || {NL} || {NL} || 'fin'
 when 1 then {NL} || 'Figura 3. X' || {NL} || {NL} || '<!-- image -->' || {NL} || {NL} || '| a |' else '' end"""


@query(f"""select doc_id, text || case doc_id % 3 when 0 then {NL} || 'fin'
 when 1 then {NL} || 'Figura 3. X' || {NL} || {NL} || '<!-- image -->' || {NL} || {NL} || '| a |' else '' end as text from documents""")
def remove_figure_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return altered(spark, sf_dir, _CAPTIONS, T.remove_figure_captions)


_LABELS = f"'Tabla 4. Uno ' || text || {NL} || 'Figura 12' || {NL} || 'Tabla 3: no ' || 'Figura 7| b'"


@query(f"""select doc_id, trim(regexp_replace({_LABELS}, '(Tabla\\s+\\d+[.|\\s+])|(Figura\\s+\\d+[.|\\s+])', 'Tabla: ', 'g'), {WS}) as text from documents""")
def normalize_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return altered(spark, sf_dir, _LABELS, T.normalize_labels)


@query(f"select doc_id, trim(regexp_replace('  ' || replace(text, ' ', '   '), ' +', ' ', 'g'), {WS}) as text from documents")
def collapse_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return altered(spark, sf_dir, "'  ' || replace(text, ' ', '   ')", T.collapse_spaces)


@query(f"select doc_id, trim(replace(replace(text, ' the ', ' <!-- image --> '), '<!-- image -->', ''), {WS}) as text from documents")
def drop_image_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return altered(spark, sf_dir, "replace(text, ' the ', ' <!-- image --> ')", T.drop_image_marks)


_THINK = f"'<think>plan' || {NL} || text || '</think>' || {NL} || {NL} || 'answer ' || text || '<think>again</think>'"


@query(f"select doc_id, trim(regexp_replace({_THINK}, '<think>.*?</think>\\n*', '', 'gs'), {WS}) as text from documents")
def strip_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return altered(spark, sf_dir, _THINK, T.strip_reasoning)


@query(f"select doc_id, regexp_replace('# ' || replace(text, '.', ' ## '), '#+', '###', 'g') as text from documents")
def normalize_summary_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return altered(spark, sf_dir, "'# ' || replace(text, '.', ' ## ')", T.summary_headers)


_QA = f"'**Q:** What is ' || cast(doc_id as varchar(20)) || '?' || {NL} || '**A:** ' || text || {NL} || 'Q: more' || {NL} || 'A: less'"


@query(f"""select doc_id, array_to_string(regexp_extract_all({_QA}, '\\**Q:*\\**\\s+.+'), '~') as questions,
 array_to_string(regexp_extract_all({_QA}, '\\**A:*\\**\\s+.+'), '~') as answers from documents""")
def extract_qa_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.expr(_QA)
    return documents(spark, sf_dir).select("doc_id", F.array_join(T.question_lines(lines), "~").alias("questions"), F.array_join(T.answer_lines(lines), "~").alias("answers"))


_PATH = "case doc_id % 4 when 0 then '/in/a.b/doc' || cast(doc_id as varchar(20)) || '.md' when 1 then '/in/DOC' || cast(doc_id as varchar(20)) || '.PDF' when 2 then '/in/x.tar.docx' else '/in/noext' end"


@query(f"""select doc_id, regexp_extract(p, '([^/]+)$', 1) as documento, regexp_replace(regexp_extract(p, '([^/]+)$', 1), '\\.[^.]*$', '') as stem,
 regexp_extract(regexp_extract(p, '([^/]+)$', 1), '(\\.[^.]*)$', 1) as ext from (select doc_id, {_PATH} as p from documents)""")
def file_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.expr(_PATH)
    return documents(spark, sf_dir).select("doc_id", T.base_name(path).alias("documento"), T.stem(path).alias("stem"), T.extension(path).alias("ext"))


@query(f"""select doc_id, p as path, p like '%.md' as markdown, lower(p) like '%.pdf' or lower(p) like '%.docx' as convertible
 from (select doc_id, {_PATH} as p from documents) where p like '%.md' or lower(p) like '%.pdf' or lower(p) like '%.docx'""")
def filter_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", F.expr(_PATH).alias("path"))
    ext = T.extension(F.col("path"))
    rows = rows.select("doc_id", "path", (ext == T.MARKDOWN).alias("markdown"), F.lower(ext).isin(*T.DOCUMENTS).alias("convertible"))
    return rows.filter(F.col("markdown") | F.col("convertible"))


@query("""select doc_id, 'Pregunta: ' || lang || chr(10) || text || chr(10) || 'n=' || '3' as prompt from documents""")
def render_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = "Pregunta: {question}\n{text}\nn={count}"
    return documents(spark, sf_dir).select("doc_id", prompts.render(template, question=F.col("lang"), text=F.col("text"), count=3).alias("prompt"))


# paragraphs

_PARTS = "select path, generate_subscripts(l, 1) - 1 as para_idx, unnest(l) as text from (select path, list_filter(string_split(text, chr(10) || chr(10)), lambda x: x <> '') as l from md)"
_MD = f"md as (select {DOC_PATH} as path, {MD} as text from documents)"
_MD_CLEAN = f"""md as (select path, trim(replace(trim(regexp_replace(trim(regexp_replace(text, '(Tabla\\s+\\d+[.|\\s+])|(Figura\\s+\\d+[.|\\s+])', 'Tabla: ', 'g'), {WS}), ' +', ' ', 'g'), {WS}),
 '<!-- image -->', ''), {WS}) as text from (select {DOC_PATH} as path, {MD} as text from documents))"""
_HELD = """run as (select *, text like '%Table%' or text like '%##%' as trg, sum(case when text like '%Table%' or text like '%##%' then 0 else 1 end) over (partition by path order by para_idx) as r from parts),
 flags as (select *, trg and row_number() over (partition by path, r, trg order by para_idx) % 2 = 1 as held from run),
 joined as (select *, coalesce(lag(held) over w, false) and text like '|%' as is_table, lag(text) over w as ctx from flags window w as (partition by path order by para_idx)),
 attached as (select path, para_idx, is_table, case when is_table then ctx || chr(10) || text else text end as body from joined where not held)"""
_CLEANED = f"""with {_MD_CLEAN}, parts as ({_PARTS}), {_HELD}, cleaned as (select path, para_idx, is_table, case when is_table then trim(replace(body, '##', 'Tabla: '), {WS}) else body end as text
 from attached where length(body) > 200)"""


@query(f"with {_MD} {_PARTS}")
def split_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.split_paragraphs(corpus(spark, sf_dir))


@query(f"with {_MD}, parts as ({_PARTS}), {_HELD} select path, para_idx, is_table, body from attached")
def attach_table_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.attach_table_context(corpus(spark, sf_dir))


@query(f"{_CLEANED} select * from cleaned")
def clean_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.clean_paragraphs(corpus(spark, sf_dir))


@query(f"{_CLEANED} select md.path, count(cleaned.para_idx) as n_paragraphs from md left join cleaned on md.path = cleaned.path group by md.path")
def paragraph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.paragraph_counts(corpus(spark, sf_dir))


# chunks

_LINES = f"""md as (select {DOC_PATH} as path, {MD_CHUNKS} as text from documents),
 lines as (select path, generate_subscripts(l, 1) as i, unnest(l) as line from (select path, string_split(text, chr(10)) as l from md)),
 leveled as (select path, coalesce(min(length(regexp_extract(line, '^(#{{1,6}}) ', 1))) filter (regexp_matches(line, '^#{{1,6}} ')), 1) as level from lines group by path)"""
_CHUNKS = f"""with {_LINES}, marked as (select lines.path, i, line, starts_with(line, repeat('#', level::int) || ' ') and substr(line, level::int + 2, 1) <> '#' as is_head from lines join leveled on lines.path = leveled.path),
 grouped as (select *, sum(is_head::int) over (partition by path order by i) as g from marked),
 chunks as (select path, g::bigint - 1 as chunk_idx, trim(ltrim(arg_min(line, i), '# '), {WS}) as header, trim(string_agg(line, chr(10) order by i), {WS}) as content from grouped where g > 0 group by path, g)"""


@query(f"with {_LINES} select path, level::bigint as level from leveled")
def detect_header_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.header_levels(corpus(spark, sf_dir, MD_CHUNKS))


@query(f"{_CHUNKS} select path, chunk_idx, header, content from chunks")
def chunk_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_by_header(corpus(spark, sf_dir, MD_CHUNKS)).select("path", "chunk_idx", "header", "content")


@query(f"{_CHUNKS} select path, chunk_idx, substr(sha256(content), 1, 12) as chunk_id from chunks")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_by_header(corpus(spark, sf_dir, MD_CHUNKS)).select("path", "chunk_idx", "chunk_id")


@query(f"{_CHUNKS} select path, chunk_idx, header, substr(sha256(content), 1, 12) as chunk_id from chunks where length(content) >= 50")
def filter_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_by_header(corpus(spark, sf_dir, MD_CHUNKS), min_chars=chunks.MIN_CHARS).select("path", "chunk_idx", "header", "chunk_id")


# generation, with the stub backend

_QA_ROWS = f"""{_CLEANED}, ctx as (select path, para_idx, replace(text, chr(10), ' ') as context from cleaned),
 good as (select *, length(context) as n from ctx where length(context) % 11 <> 0 and length(context) % 13 <> 0),
 qa as (select path, para_idx, context, k - 1 as pair_idx, 'Q' || k || ' ' || substr(sha256(context), 1, 8) as instruction, substr(context, (1 + (k - 1) * 100)::bigint, 100) as answer
 from good, lateral (select unnest(generate_series(1, 1 + n % 3)) as k))"""


def _generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.generate_qa(paragraphs.clean_paragraphs(corpus(spark, sf_dir)), StubGenerator)


@query(f"{_QA_ROWS} select path, para_idx, pair_idx, instruction, answer from qa")
def generate_qa_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.qa_rows(_generated(spark, sf_dir))


@query(f"""{_QA_ROWS}, per as (select path, para_idx, any_value(context) as context, string_agg(instruction || '|' || answer, '^' order by pair_idx) as pairs from qa group by path, para_idx)
 select md.path, 'inkmill' as created_by, 3 as version, 'Documentos' as domain, 'A description' as document_outline, regexp_extract(md.path, '([^/]+)$', 1) as pattern, count(per.para_idx) as n_examples,
 coalesce(string_agg(per.context || '~' || per.pairs, '`' order by per.para_idx), '') as examples from md left join per on md.path = per.path group by md.path""")
def build_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = corpus(spark, sf_dir)
    pairs = lambda e: F.array_join(F.transform(e["questions_and_answers"], lambda q: F.concat(q["question"], F.lit("|"), q["answer"])), "^")
    examples = F.array_join(F.transform("seed_examples", lambda e: F.concat(e["context"], F.lit("~"), pairs(e))), "`")
    return taxonomy.build_taxonomy(_generated(spark, sf_dir), files).select(
        "path", "created_by", "version", "domain", "document_outline", F.get("document.patterns", F.lit(0)).alias("pattern"), F.size("seed_examples").cast("long").alias("n_examples"), examples.alias("examples")
    )


_EXAMPLE_IDX = "dense_rank() over (partition by path order by para_idx) - 1 as example_idx"


@query(f"{_QA_ROWS} select path, {_EXAMPLE_IDX}, pair_idx, instruction, answer from qa")
def taxonomy_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.to_table(taxonomy.build_taxonomy(_generated(spark, sf_dir)))


@query(f"{_QA_ROWS} select path, {_EXAMPLE_IDX}, pair_idx, instruction as prompt, answer as completion from qa")
def taxonomy_to_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.to_completions(taxonomy.build_taxonomy(_generated(spark, sf_dir)))


@query("""select conv_id, turn, next_text as expected_answer, text as problem, '<think>' || text || '</think>' || chr(10) || next_text as generated_solution
 from (select *, lead(role) over w as next_role, lead(text) over w as next_text from conversations window w as (partition by conv_id order by turn))
 where role = 'user' and next_role = 'assistant' and length(text) % 7 <> 0""")
def reasoning_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = Window.partitionBy("conv_id").orderBy("turn")
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet").withColumns({"next_role": F.lead("role").over(turns), "answer": F.lead("text").over(turns)})
    rows = talk.filter("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("instruction"), "answer", F.lit("conversations").alias("source"))
    return reasoning.reasoning_rows(rows, StubGenerator, keep=("conv_id", "turn"))


@query("""select doc_id, text as instruction, lang as answer, null::varchar as source, null::integer as quality from documents
 union all by name select doc_id, quality, 'labels' as source from labels
 union all by name select page_id as doc_id, url as instruction from pages""")
def merge_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs = read("documents").select("doc_id", F.col("text").alias("instruction"), F.col("lang").alias("answer"))
    labels = read("labels").select("doc_id", F.lit("labels").alias("source"), "quality")
    pages = read("pages").select(F.col("page_id").alias("doc_id"), F.col("url").alias("instruction"))
    return merge.merge_frames([docs, labels, pages])


@query(f"""{_CHUNKS}, kept as (select *, substr(sha256(content), 1, 12) as chunk_id from chunks where length(content) >= 50 and length(content) % 11 <> 0),
 asked as (select path, chunk_idx, chunk_id, content, q, 'P' || q || ' ' || substr(sha256(content), 1, 8) as question from kept, lateral (select unnest([1, 2, 3]) as q)),
 spread as (select *, unnest(case when ascii(right(question, 1)) % 5 = 0 then [0] else [0, 1, 2] end) as v from asked)
 select row_number() over (order by path, chunk_idx, q, v) as id, case when v = 0 then question else question || ' v' || v end as pregunta, chunk_id, content as chunk_content,
 regexp_extract(path, '([^/]+)$', 1) as documento from spread""")
def rag_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rag.rag_dataset(chunks.chunk_by_header(corpus(spark, sf_dir, MD_CHUNKS), min_chars=chunks.MIN_CHARS), StubGenerator)


# summaries

_H2 = f"""with md as (select {DOC_PATH} as path, {MD} as text from documents),
 lines as (select path, generate_subscripts(l, 1) as i, unnest(l) as line from (select path, string_split(text, chr(10)) as l from md)),
 marked as (select path, i, trim(line, {WS}) as line, regexp_matches(line, '^\\s*##([^#]|$)') as is_head from lines),
 grouped as (select *, sum(is_head::int) over (partition by path order by i) as g from marked),
 every as (select path, g, nullif(trim(regexp_replace(max(line) filter (is_head), '^##', ''), {WS}), '') as title, coalesce(string_agg(line, '  ' || chr(10) order by i) filter (not is_head and line <> ''), '') as body from grouped group by path, g),
 sections as (select path, row_number() over (partition by path order by g) - 1 as section_idx, title, body from every where body <> '')"""


@query(f"{_H2} select path, section_idx, title, body from sections")
def split_h2_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.split_h2_sections(corpus(spark, sf_dir))


@query(f"""{_H2.replace("with md as", "with base as").replace("from md)", "from base)")}, titled as (select path, arg_min(title, section_idx) filter (title is not null) as title, string_agg(chr(10) || chr(10) || body, '' order by section_idx) as text from sections group by path),
 {_MD_CLEAN.replace(f"(select {DOC_PATH} as path, {MD} as text from documents)", "titled")},
 parts as ({_PARTS}), {_HELD}, cleaned as (select path, para_idx, case when is_table then trim(replace(body, '##', 'Tabla: '), {WS}) else body end as text from attached where length(body) > 200),
 said as (select path, para_idx, regexp_replace('# ' || substr(text, 1, 80), '#+', '###', 'g') || chr(10) || chr(10) as s from cleaned),
 whole as (select path, string_agg(s, '' order by para_idx) as s from said group by path)
 select base.path, coalesce('## ' || titled.title || chr(10) || chr(10), '') || coalesce(whole.s, '') as summary from base left join titled on base.path = titled.path left join whole on base.path = whole.path""")
def assemble_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.summarize(corpus(spark, sf_dir), StubGenerator)
