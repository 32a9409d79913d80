"""Page caches with their reader, rules as a table, summaries in one scan."""

import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators import claims, rule_table, summaries
from docloom.sources import page_cache


def pages(spark, **manuals):
    return spark.createDataFrame([(m, i + 1, x) for m, texts in manuals.items() for i, x in enumerate(texts)], "manual string, page int, text string")


def test_caches_follow_their_source(spark, tmp_path):
    at = f"{tmp_path}/caches"
    long = [f"p{i}" for i in range(700)]
    odd = {"a b": long, "b": ["one", None, "x\n\"é\""], "c/d=e": ["z"]}
    work = iter(f"{tmp_path}/w{k}" for k in range(9))
    assert page_cache.write_pages(pages(spark, **odd), at, next(work)) == 5
    read = lambda: {(r.manual, r.page): r.text for r in page_cache.read_pages(spark, at).collect()}
    want = {(m, i + 1): x or "" for m, texts in odd.items() for i, x in enumerate(texts)}
    assert read() == want
    held = sorted((tmp_path / "caches").rglob("part-*"))
    assert all(set(json.loads(p.read_text())) == {"pages"} for p in held)
    assert page_cache.write_pages(pages(spark, **odd), at, next(work)) == 0
    changed = odd | {"a b": [*long[:300], "other", *long[301:]], "f": ["new"]}
    del changed["b"]
    assert page_cache.write_pages(pages(spark, **changed), at, next(work)) == 2
    assert read() == {(m, i + 1): x or "" for m, texts in changed.items() for i, x in enumerate(texts)}


def test_conditions_choose_files_and_ranges(spark, tmp_path):
    at = f"{tmp_path}/caches"
    page_cache.write_pages(pages(spark, a=[f"p{i}" for i in range(600)], b=["x", "y"]), at, f"{tmp_path}/w")
    cut = page_cache.read_pages(spark, at, ["a"], 301, 310)
    assert [(r.manual, r.page, r.text) for r in cut.orderBy("page").collect()] == [("a", i + 1, f"p{i}") for i in range(300, 310)]
    parts = lambda **options: [(p.manual, p.least, p.most) for p in page_cache.PageCacheReader({"path": at} | options).partitions()]
    assert parts(least="301", manuals='["a", "z"]') == [("a", 301, 320), ("a", 321, 384), ("a", 385, 448), ("a", 449, 512), ("a", 513, 576), ("a", 577, 600)]
    assert parts(most="1") == [("a", 1, 1), ("b", 1, 1)] and len(parts()) == 11
    assert page_cache.read_pages(spark, at, ["none"]).collect() == []
    whole = page_cache.read_pages(spark, at)  # conditions of one use of a frame leave the others alone
    assert [whole.count(), whole.where("page > 300").count(), whole.count(), whole.where("page <= 2").unionByName(whole.where("page > 599")).count()] == [602, 300, 602, 5]


def test_whole_words_are_looked_up(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abAé1_") for _ in range(r.randint(1, 3)))
    rules = [(k, r.choice([3, 4, None]), r.choice(["x", "y", None]), w, p.format(re.escape(w))) for k, (w, p) in enumerate((word(), p) for p in (r"\b{}\b", "(?<![abA]){}(?![abA])", "(?<![ab]){}(?![abA])", "(?<![^ ]){}(?![^ ])", "(?<!a){}(?!a)") for _ in range(25))]
    rules.append((900, 1, "z", "", r"^\S+$"))
    lines = [(n, "".join(r.choice("abAé1_  -") for _ in range(r.randint(0, 9)))) for n in range(300)] + [(500, None)]
    assert rule_table.word_class("ab", "(?<![a-z])ab(?![a-z])") == "[a-z]" and rule_table.word_class("ab", r"\bab\b") == r"\w"
    for literal, pattern in (("a-b", r"\ba\-b\b"), ("a", r"\ba+\b"), ("ab", "(?<![a])ab(?![a])"), ("ab", "(?<![ab])ab(?![abc])"), ("", r"\b\b")):
        assert rule_table.word_class(literal, pattern) is None
    matcher = rule_table.Matcher([(k, w, p) for k, _, _, w, p in rules])
    for _, x in lines:
        assert x is None or sorted(matcher.matches(x)) == [k for k, _, _, _, p in rules if re.search(p, x)]
    table = spark.createDataFrame(rules, "rule long, priority int, label string, literal string, pattern string")
    given = spark.createDataFrame(lines, "n int, line string").repartition(3)
    found = rule_table.routed_lines(given, table, ["n"])
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    hits = rule_table.rule_hits(given, table, ["n"])
    want = {x.n: (x.first, x.label, x.labels) for x in rule_table.routed(hits, ["n"]).collect()}
    assert {x.n: (x.first, x.label, x.labels) for x in found.collect()} == want and len(want) > 100
    assert {x.n: x.n_rules for x in found.collect()} == {x.n: x["count"] for x in hits.groupBy("n").count().collect()}
    assert rule_table.routed_lines(given, table.limit(0), ["n"]).collect() == []


def test_rules_as_a_table(spark):
    r = random.Random(9)
    rules = [(i, r.randint(0, 40), r.choice("xyz"), w, rf"\b{w}\b") for i, w in enumerate(f"w{k}" for k in range(300))]
    rules += [(900, 50, "digits", "", r"\d{4,}"), (901, 7, "kor", "비자", r"비자\s*(발급|연장)"), (902, 7, "twice", "w1", r"w1.*w1")]
    lines = [(i, " ".join(r.choice([f"w{r.randint(0, 500)}", "비자 발급", "12345", "비자"]) for _ in range(r.randint(0, 6)))) for i in range(200)] + [(500, None), (501, "")]
    table = spark.createDataFrame(rules, "rule long, priority int, label string, literal string, pattern string")
    given = spark.createDataFrame(lines, "n int, line string").repartition(3)
    want = {(n, i) for n, x in lines for i, _, _, _, p in rules if x is not None and re.search(p, x)}
    hits = rule_table.rule_hits(given, table, ["n"])
    assert {(h.n, h.rule) for h in hits.collect()} == want and hits.count() == len(want) > 200
    by_line = {}
    for n, i in want:
        by_line.setdefault(n, []).append(min((p, k, lab) for k, p, lab, _, _ in rules if k == i))
    got = {x.n: (x.first, x.label, x.labels) for x in rule_table.routed(hits, ["n"]).collect()}
    assert got == {n: (min(v)[1], min(v)[2], list(dict.fromkeys(lab for _, _, lab in sorted(v)))) for n, v in by_line.items()}
    assert rule_table.rule_hits(given, table.limit(0), ["n"]).collect() == []


def test_too_many_rules(spark, monkeypatch):
    monkeypatch.setattr(rule_table, "RULE_BYTES", 50)
    rules = spark.createDataFrame([(1, 1, "a", "abc", "abc" * 20)], "rule long, priority int, label string, literal string, pattern string")
    with pytest.raises(ValueError, match="more than 50"):
        rule_table.rule_hits(spark.createDataFrame([(1, "x")], "n int, line string"), rules, ["n"])


def test_summaries_merge_partial_heaps(spark, monkeypatch):
    monkeypatch.setattr(summaries, "HELD", 2)
    r = random.Random(4)
    rows = [(r.choice(["a", "b", "c", None]), f"c{i:03d}", r.choice([5, 9, 9, 30, 31]), r.randint(0, 3), [f"k{j}" for j in range(r.randint(0, 9))], i % 3 == 0, r.randint(1, 4)) for i in range(300)] + [("d", "d1", 1, 0, None, False, 1)]
    chunks = spark.createDataFrame(rows, "m string, chunk_id string, char_count int, table_count int, codes array<string>, oversized boolean, place int").repartition(7)
    got = {(x.m, x.all_manuals): x for x in summaries.summaries(chunks, "m", "place").collect()}
    assert set(got) == {("a", False), ("b", False), ("c", False), ("d", False), (None, False), (None, True)}
    for (m, whole), x in got.items():
        mine = [q for q in rows if whole or q[0] == m]
        sizes, tables, codes = [q[2] for q in mine], [q[3] for q in mine], [len(q[4] or []) for q in mine]
        assert (x.chunks, x.oversized, x.min_char_count, x.max_char_count, x.avg_char_count) == (len(mine), sum(q[5] for q in mine), min(sizes), max(sizes), sum(sizes) // len(sizes))
        assert (x.min_table_count, x.max_table_count, x.avg_table_count, x.min_codes, x.max_codes, x.avg_codes) == (min(tables), max(tables), sum(tables) // len(mine), min(codes), max(codes), sum(codes) // len(mine))
        top = sorted((q for q in mine if q[5]), key=lambda q: (-q[2], q[6], q[1]))[:5]
        assert [(e.chunk_id, e.char_count, e.codes) for e in x.largest] == [(q[1], q[2], q[4][:6]) for q in top]
    plan = summaries.summaries(chunks, "m", "place")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    assert summaries.summaries(chunks.limit(0), "m", "place").collect() == []


@pytest.mark.parametrize(("size", "hot"), [(1 << 20, 1000), (64, 1000), (1 << 20, 5)])
def test_claims_against_a_source(spark, tmp_path, monkeypatch, size, hot):
    monkeypatch.setattr(claims, "HOT", hot)
    r = random.Random(3)
    source = [f"s{i}" for i in range(2000)] + ["the", None, "the"]
    rows = [(i % 300, r.choice(["the", "gone", f"s{r.randint(0, 2500)}", f"x{r.randint(0, 900)}", None])) for i in range(3000)] + [(None, "the"), (None, "lost")]
    given = spark.createDataFrame(rows, "d int, w string").repartition(4)
    got = claims.checked(given, ["d"], "w", spark.createDataFrame([(s,) for s in source], "v string"), "v", f"{tmp_path}/a", size)
    want = sorted(((d, w, w is not None and w in set(source)) for d, w in rows), key=str)
    assert sorted((tuple(x) for x in got.collect()), key=str) == want
    none = spark.createDataFrame([], "v string")
    assert {x.known for x in claims.checked(given, ["d"], "w", none, "v", f"{tmp_path}/b", size).collect()} == {False}
    assert claims.checked(given.limit(0), ["d"], "w", none, "v", f"{tmp_path}/c", size).collect() == []


def test_filter_holds_its_values(spark):
    values = spark.range(5000).select(F.concat(F.lit("v"), "id").alias("v"))
    held = claims.value_filter(values, "v")
    places = lambda c: claims.bit_places(np.array([x.h for x in spark.range(5000).select(F.xxhash64(F.concat(F.lit(c), "id")).alias("h")).collect()]), len(held) * 8)
    hit = lambda at: (held[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(0)
    assert hit(places("v")).all() and hit(places("w")).mean() < 0.02
    assert claims.value_filter(values, "v", 64) is None
