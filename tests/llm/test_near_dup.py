import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from docloom.llm.components import components
from docloom.llm.near_dup import near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_force(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, s), (b, t) in combinations(sets, 2):
        if s and t and 100 * len(s & t) >= 75 * len(s | t):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {(d, len(s), root(d), root(d) == d) for d, s in sets}


def corpus(seed, n):
    r = random.Random(seed)
    word = lambda: f"w{r.randint(0, 5000)}"
    passage = [word() for _ in range(80)]
    base = [[word() for _ in range(r.choice([3, 8, 30, 120, 400]))] for _ in range(12)]
    texts = []
    for _ in range(n):
        b = list(r.choice(base))
        kind = r.random()
        if kind < 0.6:  # copies with some edits; chains of copies arise
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                b[r.randrange(len(b))] = word()
            if r.random() < 0.3:
                base.append(b)
        elif kind < 0.8:
            b = [word() for _ in range(r.randint(20, 200))] + passage
        else:
            b = [word() for _ in range(r.randint(1, 60))]
        texts.append(r.choice([" ", "\n", " \t "]).join(w.upper() if r.random() < 0.05 else w for w in b))
    return texts


def test_matches_brute_force(spark):
    rows = [(i * 3 % 1009, t) for i, t in enumerate(corpus(3, 350))] + [(2000, None), (2001, ""), (2002, "  \n"), (2003, "One two"), (2004, "one TWO"), (2005, "É a b c d"), (2006, "é a b c d")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, component_id int").repartition(5)
    got = {tuple(r) for r in near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()}
    assert got == brute_force(rows)


def test_large_group_of_near_copies(spark):
    r = random.Random(5)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(300):
        b = list(base)
        for _ in range(2):
            b[r.randrange(100)] = f"x{r.randint(0, 10**9)}"
        rows.append((i, " ".join(b)))
    got = {tuple(x) for x in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_force(rows)


def test_null_ids_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f")], "doc_id int, text string")
    got = sorted(map(tuple, near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (5, 2, 5, True), (5, 2, 5, True), (9, 2, 5, False)], key=str)
    assert near_duplicates(docs.where(F.lit(False))).count() == 0


def test_components_of_a_long_chain(spark, tmp_path):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 150), (150, 170)], "a long, b long")
    got = dict(map(tuple, components(edges, str(tmp_path)).collect()))
    assert got == {**{i: 0 for i in range(61)}, 150: 150, 170: 150, 200: 150}


def test_recall_at_the_threshold_and_clashing_columns(spark):
    """1,500 pairs of similarity 0.75 to 0.78, of long and short texts; one text of 200,000 words with a near copy."""
    r = random.Random(9)
    rows, linked = [], 0
    for i in range(1500):
        n = r.choice([40, 90, 300])
        a = [f"a{i}x{k}" for k in range(n + 4)]
        cut = round(n * r.uniform(0.236, 0.25))  # of n shingles the copy lacks so many
        b = a[: n + 4 - cut]
        linked += 100 * (n - cut) >= 75 * n
        rows += [(2 * i, " ".join(a), 1, 2, 3), (2 * i + 1, " ".join(b), 1, 2, 3)]
    long = [f"l{r.random()}" for _ in range(200_000)]
    rows += [(9000, " ".join(long), 1, 2, 3), (9001, " ".join(long[:180_000]), 1, 2, 3)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, node int, value int, copies int").repartition(4)).where("not kept").collect()
    assert all(x.component_id == x.doc_id - 1 for x in got) and any(x.doc_id == 9001 for x in got)
    assert linked + 1 >= len(got) >= 0.999 * (linked + 1) and linked > 1000
