"""K-d tree partitioning of documents into shards of near-equal bytes.

A document is a point in three metadata dimensions: the size of its text, its source and its language. All three are put on
one scale, the share of the corpus's bytes that lies before a value (sizes in their order, sources and languages in the order
of a hash), so that widths compare: every dimension is as wide as the corpus at the root, and a split halves the one it cuts.
Each node splits along its widest dimension at the weighted median (at the share of its left leaves, where leaves don't halve).
Equal texts are at one point, that of the first of their sources and languages. Rows at the same coordinate are ordered by a
hash of their text, and only then by one of doc_id: equal texts stay in one shard unless cutting beside them would put a shard
off by more than `SLACK` of its size.

The tree is built level by level over a narrow table (no text). All of a level's nodes are cut by a few aggregations: bytes by
node, dimension and grid cell give the widest dimension and the median's cell; bytes by 11 bits of the text's hash give the
place in that cell, and further digits follow only where that is off by more than the slack and several rows share it. Groups are numbers of bounded
size whatever the rows, so neither a sort of rows nor a hot value in one task is needed. A level's cuts are a table of one row
a node that rows are joined with; nothing that grows with the leaves reaches the driver or becomes an expression.

Defined results: a null or empty text has size 8, a very long one its bytes plus 8, which may exceed a shard's share; null
source and language count as one value each, as does a column that isn't there; repeated rows and ties get slots of their own;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkmill.llm.common import BROADCAST_ROWS, saved, sized_for_join, split_count, table

SHARDS = 24
#: Cells of a dimension, and slots that values are dealt to before their bytes are known.
GRID, SLOTS = 2048, 1 << 12
#: Share of a shard's bytes that a cut may be off by to keep equal texts together.
SLACK = 1 / 64
#: Rows of a shard that are numbered in one group.
SLOT_ROWS = 20_000
OVERHEAD = 8
DIMS = ("size", "source", "lang")
#: Bits of the text's hash in a row's place, and of each digit that a cut is searched by.
TEXT_BITS, DIGIT = 33, 11


def _slot(docs: DataFrame, name: str) -> Column:
    value = F.col(name).cast("string") if name in docs.columns else F.lit(None).cast("string")
    return F.pmod(F.xxhash64(F.coalesce(value, F.lit("\x00null"))), F.lit(SLOTS)).cast("int")


def narrow(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """doc_id, size, text_crc32, the slot of each dimension, the text's hash, its first bits and some of doc_id's hash."""
    body = F.coalesce(F.col(text), F.lit(""))
    size = F.octet_length(body).cast("long") + OVERHEAD
    hashed = F.xxhash64(F.lit(11), body)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.least(F.floor(F.log2(size.cast("double")) * 128), F.lit(SLOTS - 1)).cast("int").alias("s0"),
        _slot(docs, source).alias("s1"),
        _slot(docs, lang).alias("s2"),
        hashed.alias("text_hash"),
        F.shiftrightunsigned(hashed, 64 - TEXT_BITS).alias("text_bits"),
        F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(1 << DIGIT)).alias("doc_bits"),
    )


def together(rows: DataFrame) -> DataFrame:
    """Rows of equal texts with the same source and language slots, the smallest of each."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("s1", "s2") for f in (F.min, F.max)]
    apart = rows.groupBy("text_hash").agg(*ends).filter("min_s1 < max_s1 OR min_s2 < max_s2").select("text_hash", "min_s1", "min_s2")
    met = rows.join(sized_for_join(saved(apart)), "text_hash", "left")
    return met.withColumns({c: F.coalesce(f"min_{c}", c) for c in ("s1", "s2")}).drop("min_s1", "min_s2")


def placed(rows: DataFrame) -> DataFrame:
    """Slots replaced by cells c0, c1, c2: the share of all bytes before a slot's middle, on a grid."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), F.col(f"s{i}").alias("slot")) for i in range(len(DIMS))))).alias("p")
    mass = rows.select("size", each).groupBy("p.dim", "p.slot").agg(F.sum("size").alias("w"))
    upto = F.sum("w").over(Window.partitionBy("dim").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    share = (upto - F.col("w") / 2) / F.sum("w").over(Window.partitionBy("dim"))
    cells = saved(mass.select("dim", "slot", F.floor(share * GRID).cast("int").alias("cell")))  # at most SLOTS rows a dimension
    for i in range(len(DIMS)):
        one = F.broadcast(cells.filter(F.col("dim") == i).select(F.col("slot").alias(f"s{i}"), F.col("cell").alias(f"c{i}")))
        rows = rows.join(one, f"s{i}").drop(f"s{i}")
    return rows


def _cell() -> Column:
    """A row's cell in its node's dimension."""
    return F.element_at(F.array(*(F.col(f"c{i}") for i in range(len(DIMS)))), F.col("dim") + 1)


def _medians(rows: DataFrame) -> DataFrame:
    """first, dim, cell, goal: of each node, its widest dimension, the median's cell, and the bytes of that cell that go left."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), F.col(f"c{i}").alias("cell")) for i in range(len(DIMS))))).alias("p")
    cells = rows.select("first", "leaves", "size", each).groupBy("first", "leaves", "p.dim", "p.cell").agg(F.sum("size").alias("w"))
    one = Window.partitionBy("first", "dim")
    cells = cells.withColumn("width", F.max("cell").over(one) - F.min("cell").over(one)).withColumn("total", F.sum("w").over(one))
    widest = F.min_by("dim", F.struct(-F.col("width"), F.col("dim"))).over(Window.partitionBy("first"))
    cells = cells.withColumn("widest", widest).filter("dim = widest")
    cells = cells.withColumn("below", F.sum("w").over(one.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("w"))
    goal = F.col("total") * F.floor(F.col("leaves") / 2) / F.col("leaves")
    return cells.filter((F.col("below") <= goal) & (goal < F.col("below") + F.col("w"))).select("first", "dim", "cell", (goal - F.col("below")).alias("goal"))


def _by_node(rows: DataFrame, nodes: DataFrame, shards: int, how: str = "inner") -> DataFrame:
    """Rows with what a table of at most `shards` nodes says of theirs."""
    return rows.join(F.broadcast(nodes) if shards <= BROADCAST_ROWS else nodes.hint("merge"), "first", how)


def _cuts(rows: DataFrame, medians: DataFrame, shards: int, slack: float) -> DataFrame:
    """first, dim, key, doc: rows of a node whose place is below key, or at key with doc_bits below doc, go left."""
    medians = saved(medians)
    key = F.shiftleft(F.col("cell").cast("long"), TEXT_BITS)
    # the open interval of places that the cut is in, as its lower end and the bits below it
    open_ = medians.select("first", "dim", key.alias("key"), F.lit(0).alias("doc"), "goal", F.lit(True).alias("pending"))
    done = None
    for low, digit in (*((low, "place") for low in range(TEXT_BITS - DIGIT, -1, -DIGIT)), (0, "doc_bits")):
        if digit == "place":
            inside = F.shiftright("place", low + DIGIT) == F.shiftright("key", low + DIGIT)
            at = F.shiftright("place", low).bitwiseAND(F.lit((1 << DIGIT) - 1))
        else:
            inside, at = F.col("place") == F.col("key"), F.col("doc_bits")
        met = _by_node(rows, open_.drop("pending"), shards).withColumn("place", F.shiftleft(_cell().cast("long"), TEXT_BITS) + F.col("text_bits"))
        weights = met.filter(inside).groupBy("first", "dim", "key", "goal", at.alias("at")).agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"))
        below = F.sum("w").over(Window.partitionBy("first").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")
        hit = weights.withColumn("below", below).filter((F.col("below") <= F.col("goal")) & (F.col("goal") < F.col("below") + F.col("w")))
        behind = F.col("below") + F.col("w") - F.col("goal") < F.col("goal") - F.col("below")
        off = F.least(F.col("below") + F.col("w") - F.col("goal"), F.col("goal") - F.col("below"))
        step = F.col("at") + behind.cast("int")
        found = F.struct(*((F.col("key") + F.shiftleft(step.cast("long"), low)).alias("key"), F.lit(0).alias("doc")) if digit == "place" else (F.col("key"), step.cast("int").alias("doc")))
        inner = (F.col("key") + F.shiftleft(F.col("at").cast("long"), low)) if digit == "place" else F.col("key")
        level = saved(hit.select("first", "dim", found.alias("cut"), inner.alias("inner"), (F.col("goal") - F.col("below")).alias("goal"), ((off > slack) & (F.col("n") > 1)).alias("pending")))
        closed = level if digit == "doc_bits" else level.filter("NOT pending")
        closed = closed.select("first", "dim", F.col("cut.key").alias("key"), F.col("cut.doc").alias("doc"))
        done = closed if done is None else done.union(closed)
        open_ = level.filter("pending").select("first", "dim", F.col("inner").alias("key"), F.lit(0).alias("doc"), "goal", "pending")
        if digit == "doc_bits" or open_.isEmpty():
            return done
    return done


def _descended(rows: DataFrame, cuts: DataFrame, shards: int) -> DataFrame:
    """Rows with the node they fall into at the next level."""
    met = _by_node(rows, cuts, shards, "left")
    place = F.shiftleft(_cell().cast("long"), TEXT_BITS) + F.col("text_bits")
    right = (place > F.col("key")) | ((place == F.col("key")) & (F.col("doc_bits") >= F.col("doc")))
    left = F.floor(F.col("leaves") / 2)
    first = F.when(F.col("key").isNull() | ~right, F.col("first")).otherwise(F.col("first") + left)
    leaves = F.when(F.col("key").isNull(), F.col("leaves")).when(right, F.col("leaves") - left).otherwise(left)
    return met.withColumns({"first": first.cast("int"), "leaves": leaves.cast("int")}).drop("dim", "key", "doc")


def grow(rows: DataFrame, shards: int, slack: float) -> tuple[DataFrame, list[DataFrame]]:
    """Rows with their shard, and each level's cuts."""
    rows, levels = saved(rows.withColumns({"first": F.lit(0), "leaves": F.lit(shards)})), []
    for _ in range((shards - 1).bit_length()):
        live = rows.filter("leaves > 1")
        cuts = _cuts(live, _medians(live), shards, slack)
        levels.append(cuts)
        rows = _descended(rows, cuts, shards)
    return rows.withColumnRenamed("first", "shard").drop("leaves"), levels


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot: sizes near equal, slots gapless from 0 within a shard.

    With target_bytes, nodes split until leaves have about that many bytes; else there are `shards` leaves.
    """
    rows = saved(narrow(docs, text))
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first()
    total, size = int(sums["n"]), int(sums["b"])
    if target_bytes:
        shards = split_count(size, target_bytes)
    dealt, _ = grow(placed(saved(together(rows))), shards, SLACK * size / shards)
    groups = split_count(total, shards * SLOT_ROWS)
    dealt = dealt.select("doc_id", "size", "text_crc32", "text_hash", "shard", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(groups)).cast("int").alias("part"))
    counts = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("base"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_hash")) - 1
    return dealt.withColumn("within", within).join(before, ["shard", "part"]).select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("within")).cast("long").alias("slot"))


def op9_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
