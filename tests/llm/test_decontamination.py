import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm._common import NO_LETTER, Words, text_buffer
from docloom.llm.decontamination import LEAST, Sieve, Walks, contaminated, edits, item_keys, semiglobal, size_class, window_keys, without_matches


def words(t):
    return re.findall(r"[a-z0-9]+", (t or "").lower())


def nearest(item, text):
    """Plain dynamic programme: fewest edits between the item and any run of the text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, v in enumerate(text):
            new.append(min(row[j] + (w != v), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(r, item, k, word):
    w = list(item)
    for _ in range(k):
        p = r.randrange(len(w))
        kind = r.random()
        if kind < 0.34:
            w[p] = word()
        elif kind < 0.67:
            del w[p]
        else:
            w.insert(p, word())
    return w


def corpus(seed, n_items, n_docs):
    r = random.Random(seed)
    word = lambda: f"v{r.randint(0, 800)}"
    items = [[word() for _ in range(r.choice([3, 6, 9, 15, 22, 40, 60]))] for _ in range(n_items)]
    docs = []
    for _ in range(n_docs):
        body = [word() for _ in range(r.randint(0, 150))]
        if r.random() < 0.6:
            it = r.choice(items)
            k = r.randint(0, int(edits(len(it))) + 2)
            at = r.randint(0, len(body))
            body[at:at] = edited(r, it, k, word)
        docs.append(r.choice([" ", ", ", "\n"]).join(w.upper() if r.random() < 0.2 else w for w in body))
    return items, docs


def test_semiglobal():
    r = random.Random(4)
    for _ in range(300):
        a, b = [r.randint(0, 4) for _ in range(r.randint(1, 8))], [r.randint(0, 4) for _ in range(r.randint(0, 14))]
        cost, s, e = semiglobal(np.array(a), np.array(b))
        assert cost == nearest(a, b)
        full = np.add.outer(np.arange(len(a) + 1), np.zeros(e - s + 1, int)) + np.arange(e - s + 1) * 0
        d = list(range(e - s + 1))
        for i, w in enumerate(a):
            new = [i + 1]
            for j, v in enumerate(b[s:e]):
                new.append(min(d[j] + (w != v), d[j + 1] + 1, new[j] + 1))
            d = new
        assert d[-1] == cost and full is not None


def of(texts):
    raw, offsets = text_buffer(pa.array(texts))
    return Words(raw, offsets, lower=True, separators=NO_LETTER)


def test_cgk_keeps_near_near():
    r = random.Random(1)
    word = lambda: f"v{r.randint(0, 10**9)}"
    one = [word() for _ in range(40)]
    two = one[:20] + [word()] + one[21:]
    for backwards in (False, True):
        way = Walks(of([" ".join(one), " ".join(two), " ".join(word() for _ in range(40))]), backwards)
        at = way.slot[[0, 40, 80]]
        end = way.end[[0, 40, 80]]
        same = np.zeros((2, 5))
        for walk in range(5):
            here = at
            for t in range(80):
                same[:, walk] += way.word[here[0]] == way.word[here[1:]]
                here = way.go(here, end, walk, t, t + 1)
        assert same[0].mean() > 40 and same[1].mean() < 5


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    items, docs = corpus(seed, 25, 160)
    rows = [(i, t, 3, 4) for i, t in enumerate(docs)] + [(900, None, 1, 4), (901, "", 1, 4), (None, " ".join(items[0]), 1, 4), (5000, "x " * 15_000 + " ".join(items[2]) + " y" * 15_000, 1, 4)]
    bench = [(100 + i, " ".join(it)) for i, it in enumerate(items)] + [(999, None), (998, "..."), (100, " ".join(items[0]))]
    d = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, item_id int, row int").repartition(3)
    b = spark.createDataFrame(bench, "item_id long, text string")
    found = contaminated(d, b).collect()
    got = {(r.doc_id, r.item_id): r.edits for r in found}
    want = {(i, 100 + k): c for i, t, *_ in rows for k, it in enumerate(items) if (c := nearest(it, words(t))) <= edits(len(it))}
    assert got.items() <= want.items() and len(want) > 40
    assert len(got) >= 0.95 * len(want) and any(len(items[k - 100]) < LEAST for _, k in got)
    assert {k for k, c in want.items() if c == 0} <= set(got)
    assert len(found) == len(got) + sum(k[0] == 3 for k in got)  # the repeated row matches again
    texts = {i: words(t) for i, t, *_ in rows}
    assert all(nearest(items[r.item_id - 100], texts[r.doc_id][r.first_word : r.first_word + r.n_words]) == r.edits for r in found)
    kept = without_matches(d, b)
    assert kept.columns == d.columns and sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(str(r) for r in [*rows, rows[3]] if r[0] not in {k[0] for k in got})


def test_empty(spark):
    d = spark.createDataFrame([(1, "a b c d e f g")], "doc_id int, text string")
    b = spark.createDataFrame([], "item_id int, text string")
    assert contaminated(d, b).count() == 0 and contaminated(d.where(F.lit(False)), b).count() == 0
    assert without_matches(d, b).count() == 1


@pytest.mark.parametrize("n", [8, 15, 26, 40, 59, 120, 250])
def test_recall_at_full_edits(n):
    """Every candidate comes from an equal key; of items with as many edits as are allowed nearly all are found, of unchanged ones all."""
    r = random.Random(n)
    word = lambda: f"v{r.randint(0, 10**6)}"
    items = [[word() for _ in range(n)] for _ in range(150)]
    known = list(item_keys(of([" ".join(i) for i in items])))
    sieve = Sieve([size_class(n)], [], np.concatenate([k[4] for k in known])).opened()
    owner = {}
    for i, _, _, keys, _ in known:
        for key in keys.tolist():
            owner.setdefault(key, set()).add(i)
    for k, least in ((int(edits(n)), 0.95 if n < 100 else 0.92), (0, 1.0)):
        texts = [" ".join([word() for _ in range(20)] + edited(r, it, k, word) + [word() for _ in range(20)]) for it in items]
        hits, block, own = set(), of(texts), of([" ".join(i) for i in items])
        for text, first, last, key in window_keys(block, sieve):
            for t, a, b, x in zip(text.tolist(), first.tolist(), last.tolist(), key.tolist()):
                if t in owner.get(x, ()) and t not in hits:
                    item, window = own.hash[own.first[t] : own.first[t + 1]], block.hash[block.first[t] + a : block.first[t] + b]
                    if semiglobal(item, window)[0] <= edits(n):
                        hits.add(t)
        assert len(hits) >= least * len(items), (n, k, len(hits))
