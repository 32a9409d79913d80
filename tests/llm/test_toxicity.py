import math
import random
import zlib
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from docloom.llm.toxicity import Chain, Model, toxicity, word_features, train, without_toxic


def small_model():
    rng = np.random.default_rng(3)
    lexicon = {f: k for k, f in enumerate(["=bad", "^awfu", "=vile"])}
    return Model(lexicon=lexicon, weights=rng.normal(size=len(lexicon) + 3), trans=rng.normal(size=(2, 2)), start=-0.4, layer=np.array([0.0, 1.0, 1.0, 1.0]))


def brute_force(model, words):
    """All label sequences of a short text."""
    k = len(model.lexicon)
    feats = [[model.lexicon[f] for f in word_features(w) if f in model.lexicon] for w in words]
    emit = [
        model.weights[k + 2] + sum(model.weights[f] for f in feats[i]) + (model.weights[k] if i and feats[i - 1] else 0) + (model.weights[k + 1] if i + 1 < len(words) and feats[i + 1] else 0)
        for i in range(len(words))
    ]
    total, clean, toxic = 0.0, 0.0, np.zeros(len(words))
    for y in product((0, 1), repeat=len(words)):
        s = y[0] * model.start + sum(e for e, z in zip(emit, y) if z) + sum(model.trans[p, q] for p, q in zip(y, y[1:]))
        total += math.exp(s)
        clean += math.exp(s) * (not any(y))
        toxic += math.exp(s) * np.array(y)
    return clean / total, toxic / total


def test_forward_backward_is_exact():
    model, r = small_model(), random.Random(1)
    chain = Chain(model)
    for _ in range(60):
        words = [r.choice(["bad", "awful", "vile", "the", "a", "plain", "word"]) for _ in range(r.randint(1, 9))]
        clean, marginals = brute_force(model, words)
        got_clean, expected, near = chain.run(len(words), chain.marked(words))
        assert abs(math.exp(got_clean) - clean) < 1e-9 and abs(expected - marginals.sum()) < 1e-9
        assert all(abs(m - marginals[i]) < 1e-9 for i, m in near.items())


def test_learns_and_points_at_spans(spark):
    r = random.Random(2)
    plain = [f"{a}{b}" for a in "ka lo mi nu re sa".split() for b in "ba de fi go hu ja lom".split()]
    docs, labels = [], []
    for i in range(900):
        words = [r.choice(plain) for _ in range(r.randint(0, 60))]
        y = int(i % 5 == 0)
        if y:
            words.insert(r.randint(0, len(words)), r.choice(["Zorkling", "ZORKED", "vexbad"]))
        docs.append((i, " ".join(words), "en"))
        labels.append((i, 1, y))
    docs += [(1000, None, None), (1001, "", None), (1002, "İ zorkling", None), (None, "ka", None), (1003, "ka " * 30000, None), (1003, "ka " * 30000, None)]
    labels += [(5, None, None), (None, 1, 1)]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in toxicity(d, lab).collect()}
    assert len(rows) == 905
    truth = {i: y for i, _, y in labels[:900]}
    held = [r for i, r in rows.items() if i is not None and i < 900 and zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all(r.held_out for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98
    assert rows[1002].predicted == 1 and rows[1002].toxic_spans[0].start == 2
    assert rows[1000].score == rows[1001].score < 0.5 and not rows[1003].predicted
    texts = {i: t for i, t, _ in docs}
    assert all("zork" in texts[r.doc_id][s.start : s.start + s.length].lower() or "vex" in texts[r.doc_id] for r in held for s in r.toxic_spans)


def test_nothing_to_learn_from(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity(d, none).first().score == 0.0
    assert toxicity(d.where(F.lit(False)), none).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", 7, 8, 9), (2, None, 7, 8, 9)], "doc_id long, text string, toxic_score int, toxic_spans int, row int")
    model = train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in without_toxic(docs, model).collect()) == [(1, "a", 7, 8, 9), (2, None, 7, 8, 9)]


def test_long_texts_train_whole(spark):
    """Texts on both sides of the former bound of 20,000 characters: the toxic word of long texts stands behind it."""
    r = random.Random(5)
    docs, labels = [], []
    for i in range(240):
        words = ["".join(r.choices("abcdehilmnoprstu", k=6)) for _ in range(4000 if i % 4 == 0 else 50)]
        if i % 3 == 0:
            words.append("grubnik" if i % 4 == 0 else "vexbad")
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    model = train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any("grub" in f for f in model.lexicon) and any("vexb" in f for f in model.lexicon)
