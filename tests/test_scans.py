"""Scans over parts against plain folds: spans, cuts, the carried page, numbers, hints; line ranges."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.operators import blocks, carried, chunk, intervals, line_blocks, locate, long_documents, scan


def random_lines(r, n, drift):
    return [" ".join(r.choice(["<t>", "</t>", "x", "yy", ""]) if r.random() < drift else r.choice(["x", "", "<t> </t>"]) for _ in range(r.randint(0, 4))) for _ in range(n)]


@pytest.mark.parametrize(("parts", "fan"), [(1, 64), (7, 2), (13, 3)])
def test_long_documents_equal_the_fold(spark, tmp_path, monkeypatch, parts, fan):
    monkeypatch.setattr(scan.prefix_states, "__defaults__", (fan,))
    r = random.Random(parts)
    docs = {k: random_lines(r, n, d) for k, n, d in (("a", 400, 0.9), ("b", 1, 0.9), ("c", 150, 0.3), ("d", 90, 1.0), ("e", 60, 0.1), ("f", 3, 0.0))}
    docs["g"] = ["</t>", "<t> <t>", "</t>", "<t>", "</t>", "</t>", "<t> </t>"]
    docs["h"] = ["", " ", "\t"]
    rows = [(k, i, x) for k, lines in docs.items() for i, x in enumerate(lines)]
    r.shuffle(rows)
    lines = spark.createDataFrame(rows, "k string, i int, line string")
    arrays = spark.createDataFrame(list(docs.items()), "k string, lines array<string>")
    want = {(x.k, x.s.start + 1, x.s.end + 1) for x in arrays.select("k", F.explode(chunk.spans(F.col("lines"), "<t>", "</t>")).alias("s")).collect()}
    got = [tuple(x) for x in long_documents.long_spans(lines, "k", ["i"], "line", f"{tmp_path}/s", "<t>", "</t>", parts).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
    for target in (1, 12, 60, 10**6):
        made = chunk.chunk_documents(arrays, "k", "lines", target=target, opening="<t>", closing="</t>")
        want = sorted(tuple(x) for x in made.select("k", "start_line", "end_line", "char_count", "table_count").collect())
        assert sorted(tuple(x) for x in long_documents.long_chunks(lines, "k", ["i"], "line", f"{tmp_path}/c{target}", target, "<t>", "</t>", parts).collect()) == want, target


def test_effects_compose():
    """The summary of two blocks is that of both together, for every state that comes in."""
    r = random.Random(8)
    for _ in range(300):
        marks = [(r.randint(0, 2), r.randint(0, 2)) for _ in range(r.randint(2, 14))]
        cut = r.randint(1, len(marks) - 1)
        whole = {"lines": 1, "chars": 2, "full": 1}
        sums = lambda m: {c: v * len(m) for c, v in whole.items()}
        effect = lambda m: sums(m) | long_documents.span_effect([o for o, _ in m], [c for _, c in m])
        both, joined = effect(marks), long_documents.both_parts(effect(marks[:cut]), effect(marks[cut:]))
        for opened, depth in [(False, d) for d in range(-6, 7)] + [(True, d) for d in range(1, 9)]:
            state = {"lines": 5, "chars": 9, "full": 2, "open": opened, "depth": depth, "start": 3 if opened else None, "spans": 4}
            now, spans, start = depth, 4, 3 if opened else None
            for i, (o, c) in enumerate(marks):
                if start is None and now == 0 and o > 0:
                    start = 5 + i + 1
                now += o - c
                if start is not None and now <= 0:
                    now, spans, start = 0, spans + 1, None
            want = (start is not None, now, start, spans)
            for e in (both, joined):
                got = long_documents.after_part(state, e)
                assert (got["open"], got["depth"], got["start"], got["spans"]) == want


def test_long_documents_of_no_lines(spark, tmp_path):
    none = spark.createDataFrame([], "k string, i int, line string")
    assert long_documents.long_spans(none, "k", ["i"], "line", f"{tmp_path}/s").collect() == []
    assert long_documents.long_chunks(none, "k", ["i"], "line", f"{tmp_path}/c").collect() == []
    one = spark.createDataFrame([(None, 1, None), (None, 2, "<table></table>")], "k string, i int, line string")
    assert [tuple(x) for x in long_documents.long_spans(one, "k", ["i"], "line", f"{tmp_path}/o").collect()] == [(None, 2, 2)]


@pytest.mark.parametrize(("parts", "fan"), [(1, 64), (9, 2)])
def test_carried_equals_the_loop(spark, monkeypatch, parts, fan):
    monkeypatch.setattr(scan.prefix_states, "__defaults__", (fan,))
    r = random.Random(parts)
    rows = []
    for m, n, share in (("a", 300, 0.5), ("b", 1, 1), ("c", 80, 0.1), ("d", 80, 0.95)):
        for i in range(n):
            cands = [(r.choice([0, 5, 9, 40, 90, 200]), r.randint(1, 3), r.randint(0, 3)) for _ in range(r.choice([1, 2, 3]) if r.random() < share else 0)]
            rows.append((m, i, r.random() < 0.05, r.choice([None, 0, 7]), r.choice([None, None, 0, 30]), cands))
    table = spark.createDataFrame(rows, f"m string, i int, has_page boolean, kept long, hint long, candidates {carried.CANDIDATES}").repartition(3)
    want, previous = [], {}
    for m, i, has, kept, hint, cands in rows:
        p = previous.get(m)
        h = p or hint
        if has:
            page, by = kept, "kept"
        elif cands:
            weight = lambda c: 1.0 if h is None else 2.5 if abs(c[0] - h) <= 8 else 0.15 if abs(c[0] - h) > 60 else 1.0  # noqa: B023, E731
            page, by = min(cands, key=lambda c: (-c[1] * weight(c), abs(c[0] - (h or 0)), c[2], c[0]))[0], "text"  # noqa: B023
        else:
            page, by = h, "hint" if h is not None else "none"
        want.append((m, i, page, p, by))
        previous[m] = p if page is None else page
    got = carried.carried(table, "m", "i", parts=parts).collect()
    assert sorted((tuple(x) for x in got), key=str) == sorted(want, key=str)


def test_a_mark_without_number_goes_before_candidates():
    cand = [{"page": 5, "hits": 1, "first_start": 0}, {"page": 90, "hits": 1, "first_start": 1}]
    row = lambda has, kept, c=(): {"has": has, "kept": kept, "hint": None, "c": list(c)}
    for rows in ([row(True, None, cand)], [row(True, None, cand), row(False, None, cand)], [row(True, None, cand), row(True, 3, cand)]):
        for page in (None, 0, 7, 88):
            now = page
            for r in rows:
                now = carried.on(now, r)
            assert carried.after_part({"page": page}, carried.page_effect(rows)) == {"page": now}


def test_hints_from_rows_near_by(spark, monkeypatch):
    monkeypatch.setattr(carried, "BIN", 64)
    r = random.Random(5)
    rows = [(m, i, r.choice("ab"), r.choice([None] * 12 + [0, 5, 8])) for m, n in (("x", 400), ("y", 3), (None, 50)) for i in range(n)]
    table = spark.createDataFrame(rows, "m string, i int, parent string, page int").repartition(4)
    got = carried.near_hints(table, "m", ["i"], "parent", "page", parts=5)
    want = locate.nearest_hint(table, ["m"], ["i"], "parent", "page")
    assert sorted((tuple(x) for x in got.select("m", "i", "hint").collect()), key=str) == sorted((tuple(x) for x in want.select("m", "i", "hint").collect()), key=str)


def test_range_texts(spark):
    r = random.Random(1)
    docs = {"a": 300, "b": 5, "c": 64}
    lines = spark.createDataFrame([(k, i + 1, None if i == 4 else f"{k}{i + 1}") for k, n in docs.items() for i in range(n)], "k string, line_no int, line string")
    ranges = [(j, k, a, a + r.choice([0, 3, 64, 200])) for j, (k, a) in enumerate((r.choice("abc"), r.randint(-5, 320)) for _ in range(200))]
    ranges += [(900, "a", 9, 3), (901, "z", 1, 2), (902, None, 1, 2), (903, "a", None, 2), (904, "b", 1, 10**15), (None, "b", 2, 3)]
    given = spark.createDataFrame(ranges, "j int, k string, a long, b long")
    got = {x.j: (x.n_lines, x.text) for x in intervals.range_texts(given, lines, "k", ["j"], "a", "b", size=16).collect()}
    want = {}
    for j, k, a, b in ranges:
        inside = [i for i in range(1, docs.get(k, 0) + 1) if a is not None and a <= i <= b]
        want[j] = (len(inside), "\n".join("" if i == 5 else f"{k}{i}" for i in inside))
    assert got == want


def test_line_blocks_equal_blocks_of_whole_texts(spark):
    r = random.Random(6)
    rows = []
    for k in range(60):
        lines = []
        for _ in range(r.randint(0, 25)):
            x = r.choice("abcd")
            mark = r.choice([f"<!-- n v1 chunk: {x} hash: h{r.randint(0, 9)} lines: {r.randint(1, 9)}-99999999999 -->", f"<!-- end chunk: {x} -->"])
            lines.append("".join(r.choice(["", "text ", mark, mark, "- name: é\n### row 1"]) for _ in range(r.randint(1, 3))))
        rows.append((k, "\n".join(lines)))
    texts = spark.createDataFrame(rows, "k int, t string")
    lines = texts.select("k", F.posexplode(F.split("t", "\n", -1)).alias("i", "line")).select("k", (F.col("i") + 1).alias("line_no"), "line")
    names = ["k", "chunk_id", "block_hash", "start_line", "end_line", "body"]
    want = sorted(tuple(x) for x in blocks.chunk_blocks(texts, "k", "t").select(*names).collect())
    found = line_blocks.line_blocks(lines, "k")
    assert sorted(tuple(x) for x in found.select(*names).collect()) == want and len(want) > 40
    assert all(x.end_line == 99999999999 for x in found.select("end_line").collect())


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_sums_before_go_through_parts(spark, tmp_path, parts):
    r = random.Random(parts)
    rows = [(r.choice(["a", "b", None]), n, r.randint(0, 5)) for n in range(120)]
    r.shuffle(rows)
    found = carried.summed_before(spark.createDataFrame(rows, "g string, n int, w long"), "g", ["n"], str(tmp_path), "w", "before", parts)
    want = {(g, n): sum(v for h, m, v in rows if h == g and m < n) for g, n, _ in rows}
    assert {(x.g, x.n): x.before for x in found.collect()} == want and found.count() == len(rows)
