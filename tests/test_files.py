"""Readers and writers: round trips, incremental skips, submissions, the file stream."""

import pytest
from pyspark.sql import functions as F

from docloom.operators import forms
from docloom.sources import files, submissions
from docloom.streaming import incremental


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("1", 'a "q", b\nline', ""), ("2", "", " x ")], "a string, b string, c string")
    files.write_csv(rows.coalesce(1), f"{tmp_path}/t", {"a": "비자코드", "b": "절차", "c": "출처"})
    part = next(tmp_path.glob("t/part-*.csv")).read_bytes()
    assert part.startswith(b"\xef\xbb\xbf\xeb\xb9\x84")
    back = files.read_csv(spark, f"{tmp_path}/t")
    assert back.columns == ["비자코드", "절차", "출처"]
    assert [r[:] for r in back.orderBy("비자코드").collect()] == [("1", 'a "q", b\nline', ""), ("2", "", " x ")]


def test_jsonl_last_wins(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "a", "n": 1}\n\n{"id": "b", "n": 2}\n{"id": "a", "n": 0}\n')
    rows = files.read_jsonl(spark, f"{tmp_path}/x.jsonl", "id string, n int", "id")
    assert {r.id: r.n for r in rows.collect()} == {"a": 0, "b": 2}
    files.write_jsonl(spark.createDataFrame([("가", None)], "k string, v string"), f"{tmp_path}/out", single=True)
    assert next(tmp_path.glob("out/part-*")).read_text() == '{"k":"가","v":null}\n'


def test_lines_and_discovery(spark, tmp_path):
    (tmp_path / "b 사증 2026.md").write_bytes("하나\r\n둘\n".encode())
    (tmp_path / "a 체류.md").write_bytes(b"x")
    found = files.discover(spark, f"{tmp_path}/*.md").collect()
    assert [r.manual_key for r in found] == ["stay", "visa"]
    assert sorted(r.lines for r in files.read_lines(spark, f"{tmp_path}/*.md").collect()) == [["x"], ["하나", "둘"]]
    (tmp_path / "c 사증.md").write_bytes(b"x")
    with pytest.raises(ValueError):
        files.discover(spark, f"{tmp_path}/*.md")


def test_stale(spark):
    listed = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5)], "path string, modified int")
    done = spark.createDataFrame([("a", 5), ("b", 4)], "path string, modified int")
    assert sorted(r.path for r in files.stale(listed, done).collect()) == ["b", "c"]
    assert files.stale(listed, done, force=True).count() == 3


def test_submissions_and_forms(spark, tmp_path):
    bodies = [(1, '{"receivedAt": "2026-01-03T00:00:00Z", "intervieweeName": "n", "durationSeconds": 61, "answers": {"q1": "yes", "q2": ["a", "b"], "q3": ""}}'), (2, '{"receivedAt": "2026-01-02T00:00:00Z", "answers": {}}')]
    submissions.append(spark.createDataFrame(bodies, "n int, body string"), f"{tmp_path}/log", ["n"], F.current_timestamp())
    rows = submissions.read_range(spark, f"{tmp_path}/log")
    got = rows.collect()
    assert [r.receivedAt[:10] for r in got] == ["2026-01-02", "2026-01-03"]
    assert got[1].answers == {"q1": ["yes"], "q2": ["a", "b"], "q3": [""]} and got[1].durationSeconds == 61
    labels = F.create_map(F.lit("a"), F.lit("Apple"))
    shown = rows.select(
        forms.visible("answers", F.lit("q1"), F.array(F.lit("yes"))).alias("v"), forms.answered("answers", F.lit("q3"), F.lit("single"), F.lit(False)).alias("d"), forms.answered("answers", F.lit("q3"), F.lit("short"), F.lit(False)).alias("e"),
        forms.shown_answer("answers", F.lit("q2"), labels).alias("s"),
    ).collect()
    assert [r[:] for r in shown] == [(False, False, True, "(no answer)"), (True, False, True, "Apple, b")]


def test_chunk_stream(spark, tmp_path):
    schema = "doc_id bigint, text string"
    for k in range(2):
        spark.createDataFrame([(k, "<table>x</table>\n" * 3)], schema).write.mode("append").parquet(f"{tmp_path}/in")
        incremental.chunk_stream(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp", schema, "doc_id", "text", target=20).awaitTermination()
    back = spark.read.parquet(f"{tmp_path}/out")
    assert {(r.batch, r.doc_id, r.chunk_id) for r in back.collect()} == {(k, k, f"{k}_{i:03d}") for k in range(2) for i in (1, 2)}


def test_cached_pages_and_mirror(spark, tmp_path):
    made = []

    def build():
        made.append(1)
        return spark.createDataFrame([(len(made), "text")], "page int, text string")

    at = f"{tmp_path}/pages"
    assert [files.cached(spark, at, build, force).first().page for force in (False, False, True, False)] == [1, 1, 2, 2] and len(made) == 2
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        assert files.mirror_xlsx(build(), f"{tmp_path}/t.xlsx") is False
        with pytest.raises(ImportError):
            files.mirror_xlsx(build(), f"{tmp_path}/t.xlsx", strict=True)
