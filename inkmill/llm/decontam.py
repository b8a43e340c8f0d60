"""Benchmark decontamination by template canonicalisation.

Words are stripped of punctuation and lower-cased; numbers, names (capitalised words inside a sentence) and units after a
number become typed placeholders. All windows of three template words (two where an item's length asks for it) of the documents
are hash-joined with windows of the benchmark items. An alignment with as many agreeing words as a leak needs shares at least
a number of windows with its item that follows from the item's length; alignments with fewer are none, so no leak is missed.
Windows that are common in the benchmark are left out of the index as long as that number, lowered by one for each, stays
above none, so a benchmark's stock phrases make no hot keys. Each candidate alignment is then compared word by word: the document leaks the item if enough template
words agree and the placeholders' values map one to one, so that a question with other numbers or names in it is found, and an
accidental agreement of placeholders is not.

A leak has `RUN` agreeing words in a row, or `SHARE` of the item's words, and `LEAST_PLAIN` of them are no placeholders; an item
with fewer plain words than that must agree in all of them. Items with fewer than `LEAST_ITEM` plain words say too little to be
told from chance and are not looked for.

Main path: SQL expressions and joins only. The benchmark's windows are broadcast only below `BROADCAST_BYTES` of text, and
candidate alignments only below a counted number; beyond, both are joined by sort-merge, whose skewed partitions Spark splits.

Defined results: null or short texts match nothing; very long ones are searched whole; rows with a null doc_id are judged like
others; repeated rows give equal rows once; of several places of an item in a document the best agreement counts, the first
among equals; an empty table on either side gives an empty result; other columns are ignored by `find_leaks` and kept by
`drop_leaks`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkmill.llm.common import let, measure, saved, sized_for_join, table

#: Words of a window, the first width for which every leak of an item has to share a window with it.
WIDTHS = (3, 2)
#: A leak: a run of so many agreeing words, or such a share of the item's; and so many agreeing words that are no placeholders.
RUN, SHARE, LEAST_PLAIN = 13, 0.7, 7
#: Plain words without which an item isn't looked for.
LEAST_ITEM = 4
#: A window found so often in the benchmark is common.
COMMON = 64
BROADCAST_BYTES = 16 << 20

NUM, NAME, UNIT = "\ue000", "\ue001", "\ue002"
# Units that count as such right after a number.
UNITS = ("kg", "g", "mg", "km", "m", "cm", "mm", "ml", "l", "s", "ms", "min", "h", "hours", "minutes", "seconds", "days", "miles", "feet", "inches", "pounds", "dollars", "euros", "percent", "mph", "kmh", "hz", "kb", "mb", "gb")


def marked(text: Column) -> Column:
    """Text without punctuation, each name preceded by its mark; words keep their case and place."""
    named = F.regexp_replace(text, r" (?<=[\p{Ll},;] )(?=\p{Lu}\p{L})", f" {NAME}")  # what is rare stands first
    return F.regexp_replace(named, rf"[^a-zA-Z0-9\x20\x09-\x0D\p{{L}}\p{{N}}{NAME}]+", "")


def template(plain: Column) -> Column:
    """Placeholders for names, numbers and units in a marked text; lower case."""
    out = F.regexp_replace(plain, rf"{NAME}\p{{L}}+", NAME)
    out = F.lower(F.regexp_replace(out, "[0-9]+", NUM))
    return F.regexp_replace(out, rf"({NUM} ?)(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", f"$1{UNIT}")


def _list(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _windows(words: Column, width: int) -> Column:
    """(position, hash) of all windows, from 0."""
    last = F.size(words) - width
    hashed = lambda i: F.struct(i.alias("pos"), F.xxhash64(*(F.get(words, i + k) for k in range(width))).alias("h"))
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), hashed)).otherwise(F.array())


def _shared(length: Column, plain: Column, width: int) -> Column:
    """Windows that an alignment with enough agreeing words shares with its item at least, by the item's length.

    So many words that agree, the others between them, form at most one stretch more than there are others, and a stretch has
    `width` - 1 windows fewer than words.
    """
    agree = F.greatest(F.ceil(SHARE * length), F.least(F.lit(LEAST_PLAIN), plain))
    return agree - (width - 1) * (length - agree + 1)


def _is_slot(word: Column) -> Column:
    return word.rlike(f"[{NUM}{NAME}{UNIT}]")


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_hash"))


def _items(benchmark: DataFrame) -> DataFrame:
    body = marked(F.coalesce(F.col("text"), F.lit("")))
    items = benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), _list(body).alias("item_raw"), _list(template(body)).alias("item_words"))
    # one item_id may name several texts
    items = items.withColumn("variant", F.xxhash64("item_raw")).distinct()
    return items.withColumn("plain", F.size(F.filter("item_words", lambda w: ~_is_slot(w)))).filter(F.col("plain") >= LEAST_ITEM)


def _index(items: DataFrame, widths: list[int]) -> DataFrame:
    """item_id, variant, need, item_pos, h: of each item, its windows but the common ones that may be left out, and how many of the rest a leak shares."""
    of_width = lambda then: F.coalesce(*(F.when(F.col("width") == w, then(w)) for w in widths or WIDTHS))
    # a run that makes a leak by itself may lie in an item of which the rest differs; an item has windows of its own width only
    need = of_width(lambda w: F.least(_shared(F.size("item_words"), F.col("plain"), w), F.lit(RUN - w + 1)))
    rows = items.select("item_id", "variant", need.alias("need"), F.posexplode(of_width(lambda w: _windows(F.col("item_words"), w))).alias("n", "w"))
    rows = rows.select("item_id", "variant", "need", F.col("w.pos").alias("item_pos"), F.col("w.h").alias("h"))
    common = rows.groupBy("h").agg(F.count(F.lit(1)).alias("often"))
    item = Window.partitionBy("item_id", "variant")
    ranked = rows.join(common, "h").withColumn("rank", F.row_number().over(item.orderBy(F.desc("often"), "h", "item_pos")))
    ranked = ranked.withColumn("out", F.least(F.col("need") - 1, F.count_if(F.col("often") >= COMMON).over(item)))
    return ranked.filter("rank > out").select("item_id", "variant", (F.col("need") - F.col("out")).alias("need"), "item_pos", "h")


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """One row for each document and item that it leaks: where, how many words agree, the slots, and whether all are equal."""
    return _leaks(docs, benchmark, text).select("doc_id", "item_id", "doc_word", "matched", "longest_run", "item_len", "n_slots", "verbatim")


def _leaks(docs: DataFrame, benchmark: DataFrame, text: str) -> DataFrame:
    few = measure(benchmark)[1] <= BROADCAST_BYTES
    small = F.broadcast if few else (lambda df: df)
    length = F.size("item_words")
    width = F.coalesce(*(F.when(_shared(length, F.col("plain"), w) >= 1, F.lit(w)) for w in WIDTHS))
    items = _items(benchmark).withColumn("width", width)
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())
    index = saved(_index(items, widths))
    keyed = _keyed(docs, text)
    every = let(_list(template(marked(F.col("text")))), lambda words: F.concat(*(_windows(words, w) for w in widths or WIDTHS)))
    probes = keyed.select("doc_id", "text_hash", F.explode(every).alias("w"))
    hits = probes.select("doc_id", "text_hash", F.col("w.pos").alias("pos"), F.col("w.h").alias("h")).join(small(index), "h")
    # repeated rows count more, which only adds candidates
    aligned = hits.groupBy("doc_id", "text_hash", "item_id", "variant", "need", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(F.count(F.lit(1)).alias("hits"))
    aligned = saved(aligned.filter("hits >= need").select("doc_id", "text_hash", "item_id", "variant", "shift"))
    found = keyed.alias("d").join(sized_for_join(aligned).alias("a"), F.expr("d.doc_id <=> a.doc_id AND d.text_hash = a.text_hash")).select("d.doc_id", "d.text_hash", "d.text", "a.item_id", "a.variant", "a.shift")
    found = found.withColumn("marked", marked(F.col("text"))).select("doc_id", "text_hash", "item_id", "variant", "shift", _list(F.col("marked")).alias("raw"), _list(template(F.col("marked"))).alias("words"))
    judged = _compare(found.join(small(items), ["item_id", "variant"]))
    agreeing = (F.col("longest_run") >= RUN) | (F.col("matched") >= SHARE * F.col("item_len"))
    leaks = judged.filter(agreeing & (F.col("matched") - F.col("n_slots") >= F.least(F.lit(LEAST_PLAIN), F.col("plain"))) & F.col("one_to_one"))
    best = F.max(F.struct("matched", "longest_run", "verbatim", (-F.col("doc_word")).alias("at"), "item_len", "n_slots")).alias("b")
    leaks = leaks.groupBy("doc_id", "text_hash", "item_id").agg(best)
    return leaks.select("doc_id", "text_hash", "item_id", (-F.col("b.at")).cast("long").alias("doc_word"), *(F.col(f"b.{c}").cast("long").alias(c) for c in ("matched", "longest_run", "item_len", "n_slots")), F.col("b.verbatim").alias("verbatim"))


def _compare(rows: DataFrame) -> DataFrame:
    """Agreement of an item with a document's words at one alignment."""
    from_doc = lambda column, i: F.get(F.col(column), F.col("shift") + i)
    pairs = F.transform(
        "item_words",
        lambda w, i: F.when((F.col("shift") + i >= 0) & (w == from_doc("words", i)), F.struct(F.lit(True).alias("same"), _is_slot(w).alias("slot"), F.lower(F.get("item_raw", i)).alias("a"), F.lower(from_doc("raw", i)).alias("b"))),
    )
    rows = rows.withColumn("pairs", pairs)
    run = F.aggregate(
        "pairs",
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda acc, p: let(F.when(p.isNotNull(), acc["now"] + 1).otherwise(F.lit(0)), lambda n: F.struct(n.alias("now"), F.greatest(acc["most"], n).alias("most"))),
        lambda acc: acc["most"],
    )
    rows = rows.withColumn("longest_run", run).withColumn("agreed", F.filter("pairs", lambda p: p.isNotNull()))
    rows = rows.withColumn("slots", F.filter("agreed", lambda p: p["slot"]))
    values = lambda field: F.size(F.array_distinct(F.transform("slots", lambda p: p[field])))
    both = F.size(F.array_distinct(F.transform("slots", lambda p: F.struct(p["a"], p["b"]))))
    return rows.select(
        "doc_id", "text_hash", "item_id", "longest_run", "plain",
        F.greatest(F.col("shift"), F.lit(0)).alias("doc_word"),
        F.size("agreed").alias("matched"),
        F.size("item_words").alias("item_len"),
        F.size("slots").alias("n_slots"),
        ((values("a") == both) & (values("b") == both)).alias("one_to_one"),
        F.forall("agreed", lambda p: p["a"] == p["b"]).alias("verbatim"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows without a leak, with all their columns."""
    leaks = sized_for_join(saved(_leaks(docs, benchmark, text).select("doc_id", "text_hash").distinct()))
    body = F.coalesce(docs[text], F.lit(""))
    return docs.join(leaks, docs["doc_id"].cast("long").eqNullSafe(leaks["doc_id"]) & (F.xxhash64(body) == leaks["text_hash"]), "left_anti")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
