import hashlib
import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from docloom.llm.fim import FANOUT, SQL, SkipList, digests, fill_in_middle, line_widths, restored


def want(doc, text, rate=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (doc, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return (doc, n, form, len(p), len(m), out)


def texts():
    r = random.Random(4)
    made = ["", None, "a", "\n", "\n\n\n", "a\nb", "a\nb\n", "x <P> y\nz", "<S", "a<\n<M\n>S>", "é日🙂\n" * 50, "\r\n\x0b\x0c\x85 one line", "end<"]
    return made + ["".join(r.choice(["é", "b", "\n", " ", "🙂", "<", "P>", "line "]) for _ in range(r.randint(0, 400))) for _ in range(150)] + ["\n".join(f"line {i} ü" for i in range(100_000))]


def test_matches_brute_force_and_restores(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "no id\nat all"), (3, "twice\nthe id"), (3, "twice\nthe id")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, output string, form int").repartition(3)
    made = fill_in_middle(docs)
    got = sorted((tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), key=str)
    assert got == sorted((want(*r) for r in rows), key=str)
    assert {r.form for r in made.select("form").collect()} == {"plain", "psm", "spm"}
    back = made.select("doc_id", restored().alias("t")).collect()
    assert sorted((r.doc_id, r.t) for r in back if r.doc_id is not None) == sorted((d, t or "") for d, t in rows if d is not None)
    some = fill_in_middle(docs, rate=30, spm_rate=0)
    assert sorted((tuple(r) for r in some.collect()), key=str) == sorted((want(*r, rate=30, spm=0) for r in rows), key=str)
    assert fill_in_middle(docs.where("doc_id = -1")).collect() == []


def test_equals_sql(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts()) if i < 120] + [(200, "a\nb"), (201, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/d")
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(tuple(r) for r in digests(docs).select(*columns).collect()) == sorted(db.execute(f"select {', '.join(columns)} from ({SQL})").fetchall())


def test_lanes_reach_every_rank():
    r = np.random.default_rng(1)
    for n in (0, 1, FANOUT, FANOUT + 1, 333):
        widths = np.stack([r.integers(1, 9, n), r.integers(1, 30, n)], 1)
        units = SkipList(widths)
        sums = np.vstack([np.zeros((1, 2), np.int64), np.cumsum(widths, 0)])
        assert all(units.reach(k) == (k, *sums[k].tolist()) for k in range(n + 1))
        assert len(units.lanes) <= 2 + np.log(max(n, 1)) / np.log(FANOUT)
    assert line_widths(np.frombuffer("é\n\nab".encode(), np.uint8)).tolist() == [[2, 3], [1, 1], [2, 2]]


def test_whole_table_restores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = digests(docs).join(docs.select("doc_id", F.sha2("text", 256).alias("own")), "doc_id")
    assert made.count() == docs.count() and made.where("own <> restored_sha256").count() == 0
