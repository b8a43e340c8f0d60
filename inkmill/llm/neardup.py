"""Near-duplicate documents by chosen-path set similarity join over word shingles.

Sets of hashed shingles that are equal collapse to one representative first, so copies cost one narrow row each. Then
independent trees branch the representatives: a node's path names the next minwise token to branch on (out of a pool that
every document computes once), and documents with the same token value fall into the same child. The nodes after three steps
are leaves, whatever their size. Leaves are chained into candidate groups, and each group is compared exhaustively on full
sets: pairs already in one component are skipped, pairs whose minwise agreement rules them out too, all others are confirmed by
exact intersection. Every leaf has three steps, so with the default pool and 16 trees a pair at similarity 0.85 shares a leaf
with probability above 0.9999, one at 0.8 above 0.999, however many documents are like them; a test measures both on texts
that share most of a template.

A group is compared in blocks of bounded size: one if it has at most `BLOCK` representatives and `BLOCK_SHINGLES` shingles, else
it is dealt to chunks of half that and every pair of chunks is a block, so that no task holds a large group. Groups beyond
`GROUP_MAX` or `GROUP_SHINGLES`, which only chains of many leaves make, are compared leaf by leaf in such blocks. Confirmed
links of blocks are joined to components; nothing is left out for its size.

Components of few links are found in one task, behind a count of them; more links go through rounds of alternating stars, whose
hubs are aggregated and whose joins Spark splits where they are skewed, until few are left.

Defined results: a null or blank text has an empty set and is linked with nothing; with fewer words than a shingle the whole
sequence is the one shingle; very long texts are compared whole; rows of one doc_id are one document; a null doc_id has a null component and is kept; an empty
table gives an empty result; other columns are ignored by `components` and kept by `drop_near_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm.common import dropped, saved, sized_for_join, table
from inkmill.llm.hashing import Rolling, U, Words, give_back, mix, sliced, window_starts

SHINGLE, SIMILARITY = 5, 0.8
POOL, TREES, FIRST_TREES, STEPS = 32, 16, 4, 3
#: Bytes of text whose shingles are hashed in one step.
SLICE = 1 << 20
#: What is compared in one block, and in one group before it is taken leaf by leaf.
BLOCK, BLOCK_SHINGLES = 2000, 2 << 20
GROUP_MAX, GROUP_SHINGLES = 20_000, 16 << 20
#: Links whose components one task finds: 16 bytes each.
FEW_LINKS = 1 << 20
#: Minwise agreement below which a pair isn't confirmed; over 64 tokens six standard deviations under the least threshold in use.
AGREE, TOKENS = 0.5, 64
#: Sets that one set is intersected with at a time.
TOGETHER = 64
_FACTORS = mix(np.arange(1, 65, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


class Sets:
    """Distinct shingle hashes of each text of a column, as one sorted run per text."""

    def __init__(self, texts: pa.Array, size: int) -> None:
        found = [self._of(part.column(0), size) for part in sliced(pa.record_batch([texts], ["text"]), 0, SLICE)]
        self.keys = np.concatenate([np.zeros(0, U), *(keys for keys, _ in found)])
        self.count = np.concatenate([np.zeros(0, np.int64), *(count for _, count in found)])
        self.first = np.cumsum(self.count) - self.count
        self.filled = np.flatnonzero(self.count)

    @staticmethod
    def _of(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
        words = Words(texts)
        data = np.where((words.data >= 65) & (words.data <= 90), words.data + 32, words.data).astype(np.uint8)
        roll = Rolling(words.hashes(data))
        at = window_starts(words, size)
        owner, keys = [words.text[at]], [roll.at(at, size)]
        for few in range(1, size):
            short = np.flatnonzero(words.count == few)
            if len(short):
                owner.append(short)
                keys.append(roll.at(words.first[short], few))
        owner, keys = np.concatenate(owner), np.concatenate(keys)
        order = np.lexsort((keys, owner))
        owner, keys = owner[order], keys[order]
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]))) if len(keys) else np.zeros(0, bool)
        return keys[new], np.bincount(owner[new], minlength=len(texts))

    def minwise(self, tokens: int) -> np.ndarray:
        """Minwise tokens of the non-empty sets, one row each."""
        out = np.zeros((len(self.filled), tokens), U)
        if len(self.filled):
            for k in range(tokens):
                out[:, k] = np.minimum.reduceat(self.keys * _FACTORS[k], self.first[self.filled])
        return out

    def total(self, salt: int) -> np.ndarray:
        """An order-free fingerprint of each non-empty set."""
        return np.add.reduceat(mix(self.keys ^ U(salt)), self.first[self.filled]) if len(self.filled) else np.zeros(0, U)


def paths(minwise: np.ndarray, trees: int = TREES) -> np.ndarray:
    """Leaf of each set in each tree: sets x trees. The path so far picks the next token."""
    out = np.zeros((len(minwise), trees), U)
    rows = np.arange(len(minwise))
    for t in range(trees):
        node = np.full(len(minwise), (t + 1) * 0x9E3779B97F4A7C15 & ((1 << 64) - 1), U)
        for _ in range(STEPS):
            token = (mix(node) % U(minwise.shape[1])).astype(np.int64)
            node = mix(node * U(0xD6E8FEB86659FD93) + minwise[rows, token])
        out[:, t] = node
    return out


def signatures(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """doc_id, n (distinct shingles), a 128-bit fingerprint of the set, and its leaf in each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in sliced(b, 1)):
            sets = Sets(batch.column(1), shingle)
            whole = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            for w, salt in zip(whole, (0, 0xA0761D6478BD642F)):
                w[sets.filled] = sets.total(salt).view(np.int64)
            nodes = paths(sets.minwise(POOL)).view(np.int64)
            sizes = np.zeros(batch.num_rows + 1, np.int64)
            sizes[1 + sets.filled] = nodes.shape[1] if len(nodes) else 0
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(nodes.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets.count, pa.int64()), pa.array(whole[0]), pa.array(whole[1]), lists], ["doc_id", "n", "fp1", "fp2", "nodes"])
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, fp1 long, fp2 long, nodes array<long>")


def leaf_links(leaves: DataFrame) -> DataFrame:
    """(a, b): b shares a leaf with the leaf's first member a. `leaves` has a member b and its leaf.

    Extremes are aggregated, never a leaf's members; leaves with one member only, however many rows, go at once.
    """
    first = leaves.groupBy("leaf").agg(F.min("b").alias("a"), F.max("b").alias("z")).filter("a < z").drop("z")
    return leaves.join(first, "leaf").filter("a < b").select("a", "b").distinct()


def _leaves(reps: DataFrame, member: Column, trees: range) -> DataFrame:
    return reps.select(member.alias("b"), F.explode(F.slice("nodes", trees.start + 1, len(trees))).alias("leaf"))


def candidate_groups(reps: DataFrame) -> DataFrame:
    """(rep, root) of all representatives that share a leaf with another, root the smallest of the group.

    The first trees group most copies; the rest run over groups instead of documents, so that a large group of copies meets
    itself no more.
    """
    first = saved(connected(leaf_links(_leaves(reps, F.col("rep"), range(FIRST_TREES)))).select(F.col("node").alias("rep"), F.col("root").alias("near")))
    grouped = reps.join(first, "rep", "left").withColumn("near", F.coalesce("near", "rep"))
    more = connected(leaf_links(_leaves(grouped, F.col("near"), range(FIRST_TREES, TREES))))
    merged = grouped.select("rep", "near").join(more, F.col("near") == F.col("node"), "left").select("rep", F.coalesce("root", "near").alias("root"))
    roots = merged.filter("rep <> root").select("root").distinct()
    return merged.join(roots, "root").select("rep", "root")


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a < b), root the smallest node reachable: alternating stars until few links or only stars are left."""
    edges = saved(links.select("a", "b").distinct())
    while True:
        if edges.count() <= FEW_LINKS:
            return edges.coalesce(1).mapInArrow(_spanned, "node long, root long")
        if _stars(edges):
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a AND m < b").select(F.col("m").alias("a"), "b")
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(low, "b")
        small = joined.filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b")).union(low.select(F.col("m").alias("a"), "b"))
        less = saved(small.filter("a < b").distinct())
        dropped(edges)
        edges = less
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("a").alias("root")))
    return roots.groupBy("node").agg(F.min("root").alias("root"))


def _spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of a bounded number of links, by taking the smaller root over each link until none differ."""
    rows = pa.Table.from_batches(list(batches), schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    nodes, at = np.unique(np.concatenate([rows.column(c).to_numpy() for c in "ab"]), return_inverse=True)
    a, b = at[: rows.num_rows], at[rows.num_rows :]
    root = np.arange(len(nodes))
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(root[root], root):
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(nodes[root], pa.int64())], ["node", "root"])


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end, and no node is both."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("up")).union(edges.select(F.col("b").alias("node"), F.lit(1).alias("up")))
    return ends.groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.sum("up").alias("times")).filter("low < high OR times > 1").isEmpty()


def _confirm(ids: np.ndarray, texts: pa.Array, shingle: int, percent: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The component (smallest id) of each text, and a spanning set of confirmed links."""
    order = np.argsort(ids, kind="stable")
    sets = Sets(texts.take(pa.array(order)), shingle)
    ids = ids[order]
    m = len(ids)
    tokens = np.zeros((m, TOKENS), U)
    tokens[sets.filled] = sets.minwise(TOKENS)
    tokens = (tokens >> U(32)).astype(np.uint32)  # 32 bits tell minima apart well enough to rule pairs out
    root, links = np.arange(m), []
    names, codes = np.unique(sets.keys, return_inverse=True)
    held = np.zeros(len(names), bool)
    for i in range(1, m):
        agree = (tokens[:i] == tokens[i]).mean(axis=1)
        small, large = np.minimum(sets.count[:i], sets.count[i]), np.maximum(sets.count[:i], sets.count[i])
        near = np.flatnonzero((agree >= AGREE) & (100 * small >= percent * large) & (small > 0))
        mine = slice(sets.first[i], sets.first[i] + sets.count[i])
        held[codes[mine]] = True
        near = near[np.argsort(-agree[near], kind="stable")]
        while len(near := near[root[near] != root[i]]):
            some, near = near[:TOGETHER], near[TOGETHER:]
            size = sets.count[some]
            theirs = np.concatenate([codes[sets.first[j] : sets.first[j] + sets.count[j]] for j in some])
            common = np.add.reduceat(held[theirs].astype(np.int64), np.cumsum(size) - size)
            for j in some[100 * common >= percent * (sets.count[i] + size - common)].tolist():
                if root[j] != root[i]:
                    low, high = sorted((root[i], root[j]))
                    root[: i + 1][root[: i + 1] == high] = low
                    links.append((int(ids[j]), int(ids[i])))
        held[codes[mine]] = False
    out = np.empty(m, np.int64)
    out[order] = ids[root]
    return out, links


def components(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, text: str = "text", block: int = BLOCK, group_max: int = GROUP_MAX) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, one row per row of docs."""
    percent = round(100 * similarity)
    sigs = saved(signatures(docs, shingle, text))
    live = sigs.filter("n > 0 AND doc_id IS NOT NULL")
    reps = saved(live.groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("rep"), F.first("nodes").alias("nodes")))
    sized = saved(candidate_groups(reps).join(reps.select("rep", "n"), "rep"))
    sizes = sized.groupBy("root").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    fits = lambda docs, shingles: (F.col("docs") <= docs) & (F.col("shingles") <= shingles)
    kind = F.when(fits(block, BLOCK_SHINGLES), "block").when(fits(group_max, GROUP_SHINGLES), "group").otherwise("leaves")
    kinds = saved(sizes.select("root", kind.alias("kind")))
    marked = sized.join(sized_for_join(kinds), "root").select("rep", "n", "root", "kind")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def confirm(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        body = rows.column("text")
        found, _ = _confirm(rows.column("rep").to_numpy(), body.chunk(0), shingle, percent)
        give_back()
        return pa.table({"rep": rows.column("rep"), "component": pa.array(found)})

    members = texts.join(sized_for_join(marked.filter("kind = 'block'").select("rep", "root")), "rep")
    found = members.groupBy("root").applyInArrow(confirm, "rep long, component long")
    if not kinds.filter("kind <> 'block'").isEmpty():
        whole = marked.filter("kind = 'group'").select("rep", "n", F.lit(-1).alias("at"), F.col("root").alias("node"))
        leaves = reps.join(marked.filter("kind = 'leaves'").select("rep"), "rep").select("rep", "n", F.posexplode("nodes").alias("at", "node"))
        found = found.union(_in_blocks(whole.union(leaves), texts, shingle, percent, block))
    found = found.groupBy("rep").agg(F.min("component").alias("component"))
    by_set = reps.select("fp1", "fp2", "n", "rep").join(found, "rep", "left").select("fp1", "fp2", "n", F.coalesce("component", "rep").alias("component"))
    out = sigs.select("doc_id", "n", "fp1", "fp2").join(by_set, ["fp1", "fp2", "n"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id")).cast("long")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _in_blocks(cells: DataFrame, texts: DataFrame, shingle: int, percent: int, block: int) -> DataFrame:
    """Components of the members (rep, n) of cells (at, node): every pair of a cell's chunks is a block, every pair of a cell meets in one.

    The work on a cell grows with the square of its chunks.
    """
    sizes = cells.groupBy("at", "node").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")).filter("c > 1")
    parts = F.greatest(F.ceil(F.col("c") / F.lit(max(2, block // 2))), F.ceil(F.col("s") / F.lit(BLOCK_SHINGLES // 2))).cast("int")
    met = cells.join(sizes, ["at", "node"]).select("at", "node", "rep", parts.alias("parts"), F.pmod(F.xxhash64("rep", "at"), parts).cast("int").alias("mine"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: (x != F.col("mine")) | (F.col("parts") == 1))
    blocks = met.select("at", "node", "rep", "mine", F.explode(others).alias("other"))
    blocks = saved(blocks.select("at", "node", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "rep"))
    dealt = texts.join(sized_for_join(blocks), "rep")

    def confirm(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        _, links = _confirm(rows.column("rep").to_numpy(), rows.column("text").chunk(0), shingle, percent)
        give_back()
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    links = dealt.groupBy("at", "node", "low", "high").applyInArrow(confirm, "a long, b long").filter("a < b")
    return connected(links).select(F.col("node").alias("rep"), F.col("root").alias("component"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """The rows kept, one document of each component, with all their columns."""
    gone = saved(components(docs, shingle, similarity, text).filter("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct())
    gone = sized_for_join(gone)
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents"), shingle=3, similarity=0.85)
