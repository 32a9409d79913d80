import random
import re
from itertools import combinations

import numpy as np
import pytest

from docloom.llm import group_join
from docloom.llm.group_join import SPARE, bands, jaccard_join, part_values

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def brute_force(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, s), (b, t) in combinations(sets, 2):
        if s and t and 100 * len(s & t) >= 90 * len(s | t):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {(d, len(s), root(d)) for d, s in sets}


def corpus(seed, n):
    r = random.Random(seed)
    word = lambda: f"w{r.randint(0, 5000)}"
    passage = [word() for _ in range(50)]
    base = [[word() for _ in range(r.choice([9, 12, 30, 60, 120, 400]))] for _ in range(10)]
    texts = []
    for _ in range(n):
        b = list(r.choice(base))
        kind = r.random()
        if kind < 0.7:  # copies with some edits; chains arise
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                b[r.randrange(len(b))] = word()
            if r.random() < 0.2:
                b += [word()]
            if r.random() < 0.3:
                base.append(b)
        elif kind < 0.85:
            b = [word() for _ in range(r.randint(1, 40))] + passage
        else:
            b = [word() for _ in range(r.randint(1, 60))]
        texts.append(r.choice([" ", "\n", " \t "]).join(w.upper() if r.random() < 0.05 else w for w in b))
    return texts


@pytest.mark.parametrize(("group", "rounds"), [(64, 4), (3, 0)])
def test_matches_brute_force(spark, monkeypatch, group, rounds):
    monkeypatch.setattr(group_join, "GROUP", group)
    monkeypatch.setattr(group_join, "ROUNDS", rounds)
    rows = [(i * 3 % 1009, t) for i, t in enumerate(corpus(7, 330))] + [(2000, None), (2001, ""), (2002, "  \n"), (2003, "One two"), (2004, "one TWO"), (2005, "É a b c"), (2006, "é a b c")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, component_id int, value string").repartition(5)
    got = {tuple(r) for r in jaccard_join(docs).select("doc_id", "n_shingles", "component_id").collect()}
    assert got == brute_force(rows)


def test_near_the_threshold(spark):
    """Chains of sets at and just under the similarity, of every size from 8 on, and a family that no pivot links."""
    r = random.Random(2)
    rows, doc = [], 0
    for n in [*range(10, 60), 200, 500]:
        words = [f"a{n}_{i}" for i in range(n + 2)]
        for cut in (0, 1, n // 10, n // 10 + 1):  # shorter by so many shingles: similarity (n - cut) / n
            rows.append((doc, " ".join(words[: n + 2 - cut])))
            doc += 1
    common = [f"c{i}" for i in range(300)]
    for _ in range(40):
        b = list(common)
        for k in r.sample(range(300), r.choice([5, 8, 12])):
            b[k] = f"x{r.randint(0, 10**9)}"
        rows.append((doc, " ".join(b)))
        doc += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {tuple(x) for x in jaccard_join(docs).collect()} == brute_force(rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (5, "a b c d"), (6, "w " * 200_000)], "doc_id int, text string")
    assert sorted((tuple(x) for x in jaccard_join(docs).collect()), key=str) == sorted([(None, 2, None), (1, 2, 1), (1, 2, 1), (5, 2, 1), (6, 1, 6)], key=str)
    assert jaccard_join(docs.where("doc_id = 77")).collect() == []


def test_similar_sets_always_meet():
    """More parts are equal than may be empty and left out, for pairs at the similarity."""
    r = np.random.default_rng(3)
    starts = bands(90, 5000)
    assert all(starts[i + 1] > starts[i] * 100 // 90 for i in range(len(starts) - 1))
    for n in [*range(9, 40), 100, 1000, 4000]:
        for _ in range(40):
            pool = np.unique(r.integers(0, 1 << 63, 2 * n + 10).astype(np.uint64))
            m = int(r.integers(n, n * 10 // 9 + 1))  # the larger one's size
            both = -(-90 * (n + m) // 190)
            if both > n:
                continue
            s, t = np.sort(pool[:n]), np.sort(np.append(pool[:both], pool[n : n + m - both]))
            assert len(np.intersect1d(s, t)) * 100 >= 90 * len(np.union1d(s, t))
            x, y = (int(np.searchsorted(starts, k, "right")) - 1 for k in (n, m))
            assert y - x in (0, 1)
            assert np.intersect1d(part_values(s, y, starts), part_values(t, y, starts)).size >= 1, (n, m, SPARE)
