import numpy as np
from pyspark.sql import functions as F

from docloom.llm.ann import encode, fit_books, search


def test_beam_is_no_worse_than_greedy():
    x = np.random.default_rng(0).normal(size=(1500, 16)).astype(np.float32)
    books = fit_books(x, 4, 32)
    error = lambda c: ((x - books[np.arange(4), c.astype(int)].sum(1)) ** 2).sum(1).mean()
    assert error(encode(x, books, 8)) < error(encode(x, books, 1)) < (x**2).sum(1).mean()


def test_recall_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    x[1000:1600] = x[7]  # many copies of one vector
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    odd = [(3000, None, 0), (3020, [0.0] * 32, 0), (3040, [1.0] * 31 + [None], 0), (3060, [float("nan")] + [1.0] * 31, 0), (3080, [float("inf")] + [1.0] * 31, 0), (3100, [1.0] * 5, 0), (None, [1.0] * 32, 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, rank int").repartition(4)
    got = {}
    for r in search(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 20))
    y, hits = x.astype(np.float64), 0
    for q, found in got.items():
        s = y @ y[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(3000), -s))[:20]
        assert len(found) == 20 and np.allclose([v for _, v in found], s[[i for i, _ in found]])
        assert [v for _, v in found] == sorted((v for _, v in found), reverse=True)
        hits += len({i for i, _ in found} & set(want.tolist()))
        if 1000 <= q < 1600:
            assert [i for i, _ in found] == want.tolist()
    assert hits >= 0.98 * 20 * len(got)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (20, [2.0, 1.0]), (3, [-1.0, 0.0])], "vec_id int, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in search(df, df.where("vec_id = 0")).collect()] == [(0, 1, 20, 4.0), (0, 2, 3, -1.0)]
    assert search(df.where(F.lit(False)), df).count() == 0


def test_recall_over_many_rows(spark):
    """Look-ups over 20,000 normal rows of 64 dimensions, the hardest case for codes; repeated ids and clashing names; no vector travels with the codes."""
    x = np.random.default_rng(5).normal(size=(20_000, 64))
    rows = [(i, v.tolist(), 0, 0) for i, v in enumerate(x)] + [(7, (-x[7]).tolist(), 0, 0), (7, x[7].tolist(), 0, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, entry int, score int").repartition(4)
    got = {}
    for r in search(df, df.where("vec_id % 200 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    x[7] = max(x[7].tolist(), (-x[7]).tolist())  # of one id the larger vector
    scores = x[::200] @ x.T
    scores[np.arange(len(scores)), np.arange(0, 20_000, 200)] = -np.inf
    want = {q * 200: set(row.tolist()) for q, row in enumerate(np.argsort(-scores, 1)[:, :20])}
    assert sorted(got) == sorted(want) and all(len(v) == 20 for v in got.values())
    assert sum(len(got[q] & want[q]) for q in want) >= 0.97 * 20 * len(want)
