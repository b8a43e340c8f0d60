from __future__ import annotations

import random

from helpers import ODD, WORDS, documents, frame, save

from inkmill.llm import neardup
from inkmill.llm.neardup import components, connected, drop_near_duplicates, op5_near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(text, n):
    words = WORDS.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(texts, n=3, percent=85):
    sets = {i: sets_of(t, n) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in sets.items():
        seen = {}
        for g in s:
            for j in where[g]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        for j, both in seen.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in texts}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_equals_brute_force(spark, sf):
    docs = documents(sf)
    assert got(op5_near_duplicates(spark, sf)) == brute(dict(zip(docs.doc_id, docs.text)))


def edited(rng, words, share):
    return " ".join(rng.choice("xyz") + str(rng.randrange(99)) if rng.random() < share else w for w in words)


def families(rng, count=12, size=12):
    out = []
    for _ in range(count):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(30, 200))]
        out += [edited(rng, words, rng.choice([0, 0.005, 0.02, 0.03, 0.05])) for _ in range(size)]
    rng.shuffle(out)
    return out


def test_borderline_families_and_giant_groups(spark):
    texts = families(random.Random(11))
    want = brute(dict(enumerate(texts)))
    df = frame(spark, texts)
    assert got(components(df, 3, 0.85)) == want
    assert got(components(df, 3, 0.85, block=4)) == want
    assert got(components(df, 3, 0.85, block=4, group_max=5)) == want


def test_odd_texts(spark, tmp_path):
    texts = [*ODD, "ONE", "A b C", "a B c", "a b c d"]
    df = frame(spark, texts)
    assert got(op5_near_duplicates(spark, save(df, tmp_path))) == brute(dict(enumerate(texts)))
    assert op5_near_duplicates(spark, save(df.limit(0), tmp_path)).count() == 0


def test_drop_keeps_one_of_each_group_and_all_columns(spark):
    base = " ".join(f"w{i}" for i in range(100))
    df = frame(spark, [base, base + " tail", "another text that is quite different from it", base, None, None])
    out = drop_near_duplicates(df)
    assert sorted(r.doc_id for r in out.collect()) == [0, 2, 4, 5] and out.columns == df.columns


def test_border_member_of_a_large_core_is_found(spark):
    """Families of near copies of one text, each with a document just similar enough to be linked with that text."""
    rng = random.Random(3)
    texts, families = [], 60
    for f in range(families):
        base = [f"f{f}w{i}" for i in range(700)]
        changed = lambda at, count, i: " ".join([*base[:at], *(f"f{f}n{i}x{k}" for k in range(count)), *base[at + count :]])
        texts += [changed(0, 0, 0), *(changed(rng.randrange(700), 1, i) for i in range(80)), changed(rng.randrange(20, 600), 54, 100)]
    kept = {i for i, (_, _, k) in got(components(frame(spark, texts), 3, 0.85)).items() if k}
    assert kept == {f * 82 for f in range(families)}


def test_every_pair_of_a_large_leaf_is_compared(spark):
    """Variants of one template, similar in pairs only; what a pair shares, most others share, so all its leaves are large."""
    texts = []
    for i, at in enumerate(a + d for a in range(0, 365, 13) for d in (0, 4)):
        texts.append(" ".join("d%dx%d" % (i, k) if at <= k < at + 22 else f"w{k}" for k in range(400)))
    for group_max in (8, 1000):
        assert got(components(frame(spark, texts), 3, 0.85, block=8, group_max=group_max)) == brute(dict(enumerate(texts)))


def template_pairs(rng, pairs, size, similarity):
    """Distinct texts that share most of one template, and pairs among them just at the similarity: its words differ in runs."""
    template = [f"t{i}" for i in range(900)]
    out = []
    for p in range(pairs):
        body = list(template)
        for at in range(0, 900, 30):  # unlike the template, and so unlike any other pair, at a third of the shingles
            body[at : at + 8] = [f"p{p}x{at + k}" for k in range(8)]
        n = 900 - size + 1
        differ = int(n * (1 - similarity) / (1 + similarity))  # shingles that either of the two lacks
        twin = list(body)
        at = rng.randrange(100)
        run = differ - size + 1
        twin[at : at + run] = [f"q{p}y{k}" for k in range(run)]
        out += [" ".join(body), " ".join(twin)]
    return out


def test_recall_on_a_template_heavy_corpus(spark):
    """Pairs at a similarity just over the threshold, none linked to others: at least 0.99 of them are found, for both thresholds in use."""
    rng = random.Random(29)
    for size, similarity in ((3, 0.85), (5, 0.8)):
        texts = template_pairs(rng, 400, size, similarity)
        want = brute(dict(enumerate(texts)), size, round(100 * similarity))
        linked = [i for i, (_, root, _) in want.items() if root != i]
        rows = got(components(frame(spark, texts), size, similarity))
        assert len(linked) == 400 and sum(rows[i][1] == want[i][1] for i in linked) >= 0.99 * len(linked)
        assert all(rows[i][2] for i in want if want[i][2])


def test_components_of_many_links(spark, monkeypatch):
    """Stars, chains and hubs, found in one task or in rounds of stars alike."""
    rng = random.Random(31)
    links = {(0, i) for i in range(1, 300)} | {(1000 + i, 1001 + i) for i in range(200)} | {tuple(sorted(rng.sample(range(5000, 6000), 2))) for _ in range(900)}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    want = {n: find(n) for n in list(root)}
    df = spark.createDataFrame(sorted(links), "a long, b long")
    for few in (1 << 20, 0, 400):
        monkeypatch.setattr(neardup, "FEW_LINKS", few)
        assert {r.node: r.root for r in connected(df).collect()} == want
    assert connected(df.limit(0)).count() == 0
