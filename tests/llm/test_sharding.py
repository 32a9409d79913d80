import zlib

import numpy as np
from pyspark.sql import functions as F

from docloom.llm.sharding import communication_matrix, hypergeometric, shard_rows, shard_sizes


def test_matrix_margins_and_law():
    blocks, shards = [5, 0, 17, 30], shard_sizes(52, 5)
    draws = np.array([communication_matrix(blocks, shards, s) for s in range(2000)])
    assert (draws.sum(2) == blocks).all() and (draws.sum(1) == shards).all()
    assert np.allclose(draws.mean(0), np.outer(blocks, shards) / 52, atol=0.15)
    var = 30 * shards[0] / 52 * (1 - shards[0] / 52) * (52 - 30) / 51
    assert abs(draws[:, 3, 0].var() - var) < 0.2


def test_shards(spark):
    rows = [(i, f"text {i % 7}" if i % 11 else None, "x") for i in range(997)] + [(1, "text 1", "x")] * 300 + [(None, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(6)
    got = shard_rows(docs).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert sorted(slots) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert shard_rows(docs.where(F.lit(False))).count() == 0


def test_draw_is_exact_at_every_size():
    import math

    rng = np.random.default_rng(1)
    good, bad, drawn = 9, 14, 11
    law = {k: math.comb(good, k) * math.comb(bad, drawn - k) / math.comb(good + bad, drawn) for k in range(10)}
    got = np.bincount([hypergeometric(rng, good, bad, drawn) for _ in range(40_000)], minlength=10) / 40_000
    assert max(abs(got[k] - law[k]) for k in law) < 0.01
    for good, bad, drawn in ((10**6, 3 * 10**6, 5000), (5 * 10**10, 2 * 10**12, 3 * 10**6)):  # on both sides of 1e9 items
        x = np.array([hypergeometric(rng, good, bad, drawn) for _ in range(4000)], float)
        n, p = good + bad, good / (good + bad)
        sd = (drawn * p * (1 - p) * (n - drawn) / (n - 1)) ** 0.5
        assert abs(x.mean() - drawn * p) < 5 * sd / 4000**0.5 and abs(x.std() / sd - 1) < 0.06
    assert [hypergeometric(rng, *a) for a in ((0, 5, 3), (5, 0, 3), (5, 5, 10), (3, 4, 0))] == [0, 3, 5, 0]


def test_small_blocks_and_cells(spark):
    """Several cells a shard, clashing column names, a very long text: every row once, sizes exact, a permutation that is not the order of the ids."""
    rows = [(i, "x" * (300_000 if i == 5 else i % 9), 1, 2, 3, 4, 5) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, copy int, block int, cell int, slot int, upto int").repartition(5)
    got = sorted((r.shard, r.slot, r.doc_id, r.size) for r in shard_rows(docs, n_shards=4, block_rows=100).collect())
    assert [g[:2] for g in got] == [(s, k) for s in range(4) for k in range(750)]
    assert sorted(g[2] for g in got) == list(range(3000)) and all(g[3] == (300_000 if g[2] == 5 else g[2] % 9) + 16 for g in got)
    assert abs(np.corrcoef(range(3000), [g[2] for g in got])[0, 1]) < 0.08
