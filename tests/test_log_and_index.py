"""The ordered log of submissions and the chunk index that batches keep up to date."""

import pytest
from pyspark.sql import functions as F

from docloom.operators import chunk
from docloom.functions import text as T
from docloom.sources import chunk_index, commits, submissions

def received():
    return F.to_timestamp(F.lit("2026-03-01T10:00:00Z"))


def bodies(spark, start, n, parts=3):
    return spark.createDataFrame([(i, f'{{"intervieweeName": "n{i}"}}') for i in range(start, start + n)], "n int, body string").repartition(parts)


def test_ranges_of_the_log(spark, tmp_path):
    at = f"{tmp_path}/log"
    assert submissions.read_range(spark, at).collect() == []
    sizes = [(0, 7), (7, 1), (8, 12)]
    assert [submissions.append(bodies(spark, *s), at, ["n"], received()) for s in sizes] == [7, 8, 20]
    assert submissions.append(bodies(spark, 0, 3).where("n > 5"), at, ["n"], received()) == 20  # no bodies, no batch
    newest = [f"n{i}" for i in reversed(range(20))]
    for start, stop in ((0, -1), (0, 0), (3, 9), (-4, -1), (-4, -2), (5, 2), (18, 99), (-99, 2), (30, 40)):
        size = len(newest)
        a, b = (max(start + size, 0) if start < 0 else start), (stop + size if stop < 0 else stop)
        got = [(r.place, r.intervieweeName) for r in submissions.read_range(spark, at, start, stop).collect()]
        assert got == list(enumerate(newest))[a : b + 1], (start, stop)
    every, few = (len(submissions.files_of(spark, at, *x)[0]) for x in ((0, -1), (0, 1)))
    assert few < every  # a range opens the files that hold it


def test_values_of_the_log(spark, tmp_path):
    at = f"{tmp_path}/log"
    rows = [
        (1, '{"intervieweeName": "n",\n "answers": {"a": "x"}}'), (2, "{}"), (3, '{"receivedAt": "2026-04-01T00:00:00Z"}'), (4, '{"receivedAt": null, "answers": {"a": "[draft] my answer", "b": ["p", "q"], "c": "", "d": [], "e": "[1]"}}'),
        (5, '{"note": "receivedAt", "x": {"receivedAt": 1}}'),
    ]
    submissions.append(spark.createDataFrame(rows, "n int, body string"), at, ["n"], received())
    got = [(r.receivedAt, r.intervieweeName, r.answers) for r in submissions.read_range(spark, at).collect()]
    now = "2026-03-01T10:00:00.000Z"
    assert got == [(now, None, None), (None, None, {"a": ["[draft] my answer"], "b": ["p", "q"], "c": [""], "d": [], "e": ["[1]"]}), ("2026-04-01T00:00:00Z", None, None), (now, None, None), (now, "n", {"a": ["x"]})]
    for bad in ("[1]", "{", "text"):
        with pytest.raises(Exception, match="invalid body"):
            submissions.append(spark.createDataFrame([(1, bad)], "n int, body string"), at, ["n"], received())
    assert submissions.read_range(spark, at).count() == 5  # failed batches leave nothing behind


def test_two_writers(spark, tmp_path):
    commits.commit(spark, str(tmp_path), 1, {"a": 1})
    with pytest.raises(RuntimeError, match="another writer"):
        commits.commit(spark, str(tmp_path), 1, {"a": 2})
    assert commits.versions(spark, str(tmp_path)) == [1] and commits.manifest(spark, str(tmp_path), 1) == {"a": 1}


def build(made=None):
    def run(docs):
        if made is not None:
            made.append(sorted(r.k for r in docs.select("k").collect()))
        return chunk.chunk_documents(docs.select("k", T.split_lines("text").alias("lines")), "k", "lines", target=20)

    return run


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("k", "chunk_id", "start_line", "end_line", "content_hash", "text").collect())


def test_index_follows_batches(spark, tmp_path, monkeypatch):
    at = f"{tmp_path}/index"
    text = lambda i, word="x": "\n".join(f"<table>{word}{i}-{j}</table>" for j in range(i % 5))
    docs = lambda rows: spark.createDataFrame(rows, "k int, text string")
    one = [(i, text(i)) for i in range(40)] + [(40, None)]
    two = [(i, text(i, "y" if i == 3 else "x")) for i in range(40) if i != 7] + [(40, None), (41, text(4))]
    made = []
    assert chunk_index.update_index(docs(one), at, "k", "text", build(made), buckets=8) == 1
    assert chunk_index.update_index(docs(one), at, "k", "text", build(made)) == 1  # nothing changed
    whole = rows_of(build()(docs(one).where("text is not null")))
    assert rows_of(chunk_index.read_index(spark, at)) == whole

    with monkeypatch.context() as m:  # a writer that is lost before its commit
        m.setattr(chunk_index, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            chunk_index.update_index(docs(two), at, "k", "text", build())
    assert commits.versions(spark, at) == [1] and rows_of(chunk_index.read_index(spark, at)) == whole

    before = commits.manifest(spark, at, 1)
    assert chunk_index.update_index(docs(two), at, "k", "text", build(made)) == 2
    assert made == [list(range(41)), [3, 41]]
    assert rows_of(chunk_index.read_index(spark, at)) == rows_of(build()(docs(two).where("text is not null")))
    assert rows_of(chunk_index.read_index(spark, at, 1)) == whole  # the old version stays
    after = commits.manifest(spark, at, 2)
    moved = {b for b in after["chunks"] if after["chunks"][b] != before["chunks"].get(b)}
    assert 0 < len(moved) <= 3 and moved == {b for b in after["docs"] if after["docs"][b] != before["docs"].get(b)}
    assert chunk_index.update_index(docs([]), at, "k", "text", build()) == 3 and rows_of(chunk_index.read_index(spark, at)) == []
    with pytest.raises(ValueError):
        chunk_index.read_index(spark, f"{tmp_path}/none")
