"""Registered queries on small tables of their own."""

import random

from docloom.operators import blocks
from docloom.plans import queries


def frames(spark, tmp_path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return lambda query: queries.QUERIES[query](spark, str(tmp_path))


def test_narrower_widths_find_pages(spark, tmp_path):
    r = random.Random(3)
    text = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    page, other = text(300), text(300)
    items = [(1, page[40:120]), (2, page[40:72]), (3, other[10:30]), (4, page[8:28] + text(60)), (5, text(90)), (6, page[:10]), (7, other[0:60] + page[0:40])]
    run = frames(spark, tmp_path, benchmark=(items, "item_id int, text string"), documents=([(10, page), (11, other), (12, page[20:90])], "doc_id int, text string"))
    keys = {10: page, 11: other, 12: page[20:90]}
    want = {}
    for item, n in items:
        for tier, width in enumerate((50, 30, 18)):
            starts = range(0, len(n) - width + 1, 8)
            hits = {d: h for d, k in keys.items() if (h := [s for s in starts if n[s : s + width] in k])}
            if hits:
                want |= {(item, tier, d): (len(h), h[0]) for d, h in hits.items()}
                break
    assert {(x.item_id, x.tier, x.doc_id): (x.hits, x.first_start) for x in run("snippet_vote_tiers").collect()} == want
    best = {x.item_id: (x.tier, x.doc_id) for x in run("locate_best_tiers").collect()}
    assert best == {1: (0, 10), 2: (1, 10), 3: (2, 11), 4: (2, 10), 7: (0, 11)}


def test_block_texts_stay_small(spark, tmp_path):
    parts = [(i, f"name {i}", "Brand#1", "SMALL", i % 50) for i in range(4000)]
    run = frames(spark, tmp_path, part=(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int"))
    texts = queries.part_blocks(lambda name: queries.table(spark, str(tmp_path), name))
    assert max(r.text.count("### row") for r in texts.collect()) <= 100
    out = run("block_roundtrip")
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.chunk_id, r.start_line, r.end_line, r.row_index, r.item_name, r.item_type, r.size) for r in out.collect()}
    assert out.count() == 4000 and got == {(f"part_{i}", i, i + i % 50, 1, f"name {i}", f"SMALL\nname {i}", str(i % 50)) for i in range(4000)}


def test_blocks_hold_blocks(spark):
    mark = lambda k: f"<!-- x v1 chunk: {k} hash: h lines: 1-2 -->"
    end = lambda k: f"<!-- end chunk: {k} -->"
    inner = f" b {mark('b')} c {end('b')} {end('a')} d "
    text = f"0 {end('z')}{mark('a')}{inner}{end('a')} e {mark('z')} f"
    got = {(r.n, r.chunk_id, r.body) for r in blocks.chunk_blocks(spark.createDataFrame([("k", text), ("l", ""), ("m", None)], "k string, t string"), "k", "t").collect()}
    assert got == {(0, "a", inner), (1, "b", " c ")}


def test_routes_count_languages_without_windows(spark, tmp_path):
    docs = [(1, "a 123456", "en"), (2, "license", "en"), (3, "plain", None), (4, "x", None), (5, "caf\u00e9", "fr")]
    out = frames(spark, tmp_path, documents=(docs, "doc_id int, text string, lang string"))("first_match_route")
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in out.collect()} == {(1, "numbers", 2), (2, "license", 2), (3, "plain", 2), (4, "plain", 2), (5, "accents", 1)}
