import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from docloom.llm.substring_dedup import FingerprintIndex, cut_documents, dedup_report


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute_force(rows):
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - 49):
            k = tuple(w[i : i + 50])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone[i : i + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def corpus(seed, n):
    r = random.Random(seed)
    word = lambda: r.choice(["é", "The", "the", ""]) + f"w{r.randint(0, 3000)}"
    passages = [[word() for _ in range(k)] for k in (49, 50, 51, 60, 120, 300)]
    line = [word() for _ in range(7)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(r.randint(0, 4)):
            kind = r.random()
            if kind < 0.4:
                parts += [word() for _ in range(r.randint(1, 90))]
            elif kind < 0.8:
                p = r.choice(passages)
                a = r.randint(0, len(p) // 3)
                p = list(p[a : a + r.randint(20, 300)])
                if r.random() < 0.3:
                    p[r.randrange(len(p))] = word()
                parts += p * r.choice([1, 1, 2])
            else:
                parts += line * r.choice([3, 12, 40])
        texts.append(r.choice([" ", "\n", "\t\x0b "]).join(parts))
    return texts + texts[: n // 8]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    texts = corpus(seed, 120)
    random.Random(seed).shuffle(texts)
    rows = [*enumerate(texts), (500, None), (501, ""), (502, " \n")]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, n_words int, at int").repartition(5)
    got = sorted(tuple(r) for r in dedup_report(docs).collect())
    want = brute_force(rows)
    assert got == sorted(w[:4] for w in want)
    assert sum(w[2] > 0 for w in want) > 30
    cut = {r.doc_id: r.text for r in cut_documents(docs).collect()}
    for (d, t), w in zip(rows, want):
        assert cut.get(d, "gone") == (t if not w[2] else w[4] or "gone")


def test_ids_repeated_or_null_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(70))
    docs = spark.createDataFrame([(5, text), (5, text), (None, text), (9, text)], "doc_id int, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in dedup_report(docs).collect()), key=str)
    assert got == sorted([(5, 70, 0), (5, 70, 0), (9, 70, 70), (None, 70, 0)], key=str)
    assert dedup_report(docs.where(F.lit(False))).count() == 0


def test_runs_are_merged_without_moving_them(spark):
    index = FingerprintIndex(spark, buckets=4, tier=2)
    rows = lambda d: spark.createDataFrame([(a, a + 1, a + 2, d, 0, 0, 1) for a in range(d, d + 20)], "anchor long, seg_a long, seg_b long, doc_id long, text_key long, at int, windows int")
    assert index.add(rows(0)).count() == 0
    assert sorted(r.anchor for r in index.add(rows(10)).collect()) == list(range(10, 20))
    index.close()
    index = FingerprintIndex(spark, index.at)  # opened again: the same runs and buckets
    assert len(index.runs) == 2 and index.buckets == 4
    plan = index._anchors(index.runs[0]).join(index._anchors(index.runs[1]).hint("merge"), "anchor")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert sorted(r.anchor for r in index.add(rows(25)).collect()) == list(range(25, 30))
    segments, anchors = index.rows()
    assert len(index.runs) == 1 and segments.count() == anchors.count() == 45
    assert {r["first"].doc_id for r in segments.where("anchor between 10 and 19").collect()} == {0}
    index.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("anchors_")]


def test_clashing_columns_and_long_texts(spark):
    """Columns named like the operator's own come through; a text of 300,000 words is cut whole."""
    passage, r = " ".join(f"p{i}" for i in range(80)), random.Random(4)
    long = " ".join(f"u{r.random()}" for _ in range(100_000)) + " " + passage + " " + " ".join(f"v{r.random()}" for _ in range(200_000))
    docs = spark.createDataFrame([(1, passage, 80, 1, 2, 3, 4), (2, long, 5, 1, 2, 3, 4), (3, passage, 6, 1, 2, 3, 4), (4, None, None, 1, 2, 3, 4)], "doc_id long, text string, n_chars long, __id int, __key int, ranges int, row int")
    got = {r.doc_id: r for r in cut_documents(docs).collect()}
    assert sorted(got) == [1, 2, 4] and all(r[3:] == (1, 2, 3, 4) for r in got.values())
    want = " ".join(w for w in long.split() if w[0] != "p")
    assert got[2].text == want and got[2].n_chars == len(want) and (got[1].text, got[1].n_chars, got[4].text, got[4].n_chars) == (passage, 80, None, None)
