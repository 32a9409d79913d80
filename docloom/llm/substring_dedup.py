"""Removal of passages that an earlier document already holds, by a log-structured fingerprint index.

A window is ``WINDOW`` consecutive words. Each window has an anchor, the least hash of the
``GRAM``-word runs inside it; neighbouring windows mostly share one, so a document is a list of
segments (anchor, position, number of windows) about a twentieth as many as its windows. Equal
windows have equal anchors.

* The index holds sorted immutable runs: per (anchor, segment hash) the earliest document, and per anchor
  a summary. Summaries are bucketed and sorted by anchor, so a new batch is merge-joined with each run without
  shuffling the run. Batches come in the order of ``doc_id``; more than ``TIER`` runs are compacted into one. The index
  can be opened again from its folder, and later batches go on from there.
* The merge join tells which anchors a batch shares with history or within itself. A segment that
  equals an earlier document's (two 64-bit hashes of all its words) is removed whole.
* Anchors that occur in different segments are verified window by window: the texts are read again, and only
  these segments' windows are hashed (128 bits) and compared.

Rows: null texts have no words; rows that repeat a ``doc_id`` are not "earlier" than one another; a null
``doc_id`` neither loses words nor takes any; other columns are left behind (``cut_documents``
keeps them, whatever their names). Very long texts are worked on whole, in blocks. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm._common import Words, by_bytes, discard, qualified, release, shared_dir, spread_join, text_buffer, versions, written

WINDOW = 50
GRAM = 8
BATCHES = 3
TIER = 2
BLOCK_BYTES = 1 << 20
NOTHING = hashlib.sha256(b"").hexdigest()
_SEGMENT = "anchor long, seg_a long, seg_b long, at int, windows int"


def _sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    have, out = 1, x
    while have * 2 <= size:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    extra = size - have
    return np.minimum(out[:-extra], out[extra:]) if extra else out


def _segments(words: Words) -> tuple[np.ndarray, ...]:
    """(text, anchor, seg_a, seg_b, at, windows) of all segments of a block."""
    m = len(words.hash) - WINDOW + 1
    if m <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    grams, _ = words.grams(GRAM)
    least = _sliding_min(grams, WINDOW - GRAM + 1)[:m]
    ok = words.whole(WINDOW)
    text = np.repeat(np.arange(len(words.first) - 1), words.counts())[:m]
    new = np.ones(m, bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~ok[:-1]
    first = np.flatnonzero(new & ok)
    ends = np.flatnonzero(np.append(new[1:] | ~ok[1:], True) & ok)
    last = ends + 1
    a, b = first, last + WINDOW - 1
    return text[first], least[first].view(np.int64), words.spans(a, b, 1).view(np.int64), words.spans(a, b, 2).view(np.int64), first - words.first[text[first]], last - first


def documents_segments(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_words, words_sha256, segments) per row."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            raw, offsets = text_buffer(part.column(2))
            for i, j in by_bytes(offsets, BLOCK_BYTES):
                base = offsets[i]
                block = raw[base : offsets[j]]
                offs = offsets[i : j + 1] - base
                words = Words(block, offs)
                text, anchor, a, b, at, n = _segments(words)
                data = block.tobytes()
                sha = [hashlib.sha256(b" ".join(data[x:y].split())).hexdigest() for x, y in zip(offs.tolist(), offs[1:].tolist())]
                cols = [pa.array(anchor), pa.array(a), pa.array(b), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))]
                ends = np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32)
                segments = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(cols, ["anchor", "seg_a", "seg_b", "at", "windows"]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(i, j - i), part.column(1).slice(i, j - i), pa.array(words.counts().astype(np.int64)), pa.array(sha), segments],
                    ["doc_id", "text_key", "n_words", "words_sha256", "segments"],
                )

    return _keyed(docs).mapInArrow(run, f"doc_id long, text_key long, n_words long, words_sha256 string, segments array<struct<{_SEGMENT.replace(' ', ':').replace(',:', ',')}>>")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


class FingerprintIndex:
    """Sorted immutable runs of segments below a folder; ``add`` merge-joins a batch with them and appends a run.

    A run is two tables. ``anchors`` has one row per anchor (least and greatest document, number of different segments) and is
    bucketed and sorted by anchor, so batches are merge-joined without shuffling history, and however many segments stand under one anchor
    it stays one row. ``segments`` has one row per (anchor, segment hash) with its earliest document. A manifest names the
    runs that count; opening the folder again goes on from there. ``close`` forgets the catalog's names and keeps the files.
    """

    def __init__(self, spark: SparkSession, at: str | None = None, buckets: int | None = None, tier: int = TIER):
        self.spark, self.tier, self.at = spark, tier, qualified(spark, at) if at else shared_dir(spark)
        self.name = f"anchors_{uuid.uuid4().hex[:12]}"
        self.buckets = buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.runs: list[int] = []
        self.made = 0
        self.version = 0
        old = versions(spark, f"{self.at}/manifest")
        if old:
            self.version = max(old)
            state = spark.read.parquet(f"{self.at}/manifest/{self.version}").collect()  # one row per run, TIER at most
            self.buckets = state[0].buckets
            for r in sorted(state, key=lambda r: r.run):
                self.runs.append(r.run)
                self._register(r.run)
            self.made = self.runs[-1]

    def _register(self, run: int) -> None:
        self.spark.sql(
            f"CREATE TABLE {self.name}_{run} (anchor BIGINT, low BIGINT, high BIGINT, last_first BIGINT, n BIGINT) USING parquet OPTIONS (path '{self.at}/anchors{run}') CLUSTERED BY (anchor) SORTED BY (anchor) INTO {self.buckets} BUCKETS"
        )

    def _commit(self) -> None:
        """The manifest is written as a whole under a new number, so a reader sees the old runs or the new ones."""
        rows = [(r, self.buckets) for r in self.runs]
        self.spark.createDataFrame(rows, "run int, buckets int").coalesce(1).write.parquet(f"{self.at}/manifest/{self.version + 1}")
        self.version += 1

    def _write(self, segments: DataFrame) -> int:
        self.made += 1
        run = self.made
        rows = written(segments.groupBy("anchor", "seg_a", "seg_b").agg(F.min("first").alias("first"), F.max("last_doc").alias("last_doc"), F.sum("docs").alias("docs")), f"{self.at}/segments{run}")
        release(self.spark)
        (
            rows.groupBy("anchor")
            .agg(F.min("first.doc_id").alias("low"), F.max("last_doc").alias("high"), F.max("first.doc_id").alias("last_first"), F.count("*").alias("n"))
            .repartition(self.buckets, "anchor")
            .sortWithinPartitions("anchor")
            .write.bucketBy(self.buckets, "anchor")
            .sortBy("anchor")
            .option("path", f"{self.at}/anchors{run}")
            .option("compression", "zstd")
            .saveAsTable(f"{self.name}_{run}")
        )
        return run

    def _anchors(self, run: int) -> DataFrame:
        return self.spark.table(f"{self.name}_{run}")

    def _segments(self, runs: list[int]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.at}/segments{r}" for r in runs])

    def add(self, segments: DataFrame) -> DataFrame:
        """segments (anchor, seg_a, seg_b, doc_id, text_key, at, windows) of a batch -> its anchors that another
        document shares, in the batch or in history. Then the batch is part of the index."""
        place = F.struct("doc_id", "text_key", "at", "windows")
        new = self._write(segments.select("anchor", "seg_a", "seg_b", place.alias("first"), F.col("doc_id").alias("last_doc"), F.lit(1).cast("long").alias("docs")))
        own = self._anchors(new)
        shared = written(own.where("low <> high").select("anchor"), f"{self.at}/shared{new}-0")
        for old in self.runs:
            past = self._anchors(old).select("anchor", F.col("low").alias("past_low"), F.col("high").alias("past_high"))
            both = own.join(past.hint("merge"), "anchor").where("least(low, past_low) <> greatest(high, past_high)").select("anchor")
            shared = shared.unionByName(written(both, f"{self.at}/shared{new}-{old}"))
        self.runs.append(new)
        if len(self.runs) > self.tier:
            self.compact()
        else:
            self._commit()
        return shared.distinct()

    def compact(self) -> None:
        """Merge all runs into one; the earliest document of each segment stays."""
        if len(self.runs) < 2:
            return
        gone, merged = self.runs, self._write(self._segments(self.runs))
        self.runs = [merged]
        self._commit()
        for run in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{run}")
            discard(self.spark, f"{self.at}/anchors{run}", f"{self.at}/segments{run}")
        release(self.spark)

    def rows(self) -> tuple[DataFrame, DataFrame]:
        """(segments, anchors), each key once."""
        self.compact()
        return self._segments(self.runs), self._anchors(self.runs[0])

    def close(self) -> None:
        for run in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{run}")


def window_hashes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, at, hash_a, hash_b) of the windows of ``wanted`` (doc_id, text_key, at, windows)."""
    per_doc = wanted.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "windows")).alias("ranges"))  # at most one per word of the document
    joined = _keyed(docs).join(per_doc, ["doc_id", "text_key"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            raw, offsets = text_buffer(part.column(2))
            ranges = part.column(3)
            lo, flat = ranges.offsets.to_numpy(), ranges.values
            at, n = flat.field("at").to_numpy(zero_copy_only=False), flat.field("windows").to_numpy(zero_copy_only=False)
            for i, j in by_bytes(offsets, BLOCK_BYTES):
                base = offsets[i]
                words = Words(raw[base : offsets[j]], offsets[i : j + 1] - base)
                k = slice(lo[i], lo[j])
                text = np.repeat(np.arange(j - i), np.diff(lo[i : j + 1]))
                count = n[k].astype(np.int64)
                each = np.repeat(np.arange(len(count)), count)
                pos = at[k].astype(np.int64)[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                start = words.first[text[each]] + pos
                row = pa.array(i + text[each])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(1).take(row), pa.array(pos.astype(np.int32)), pa.array(words.spans(start, start + WINDOW, 1).view(np.int64)), pa.array(words.spans(start, start + WINDOW, 2).view(np.int64))],
                    ["doc_id", "text_key", "at", "hash_a", "hash_b"],
                )

    return joined.select("doc_id", "text_key", "text", "ranges").mapInArrow(run, "doc_id long, text_key long, at int, hash_a long, hash_b long")


def repeated_ranges(docs: DataFrame, batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """(all rows' documents_segments table; (doc_id, text_key, ranges) of the windows to remove)."""
    spark = docs.sparkSession
    at = shared_dir(spark)
    table = written(documents_segments(docs), f"{at}/segments")
    segments = table.where("doc_id is not null").select("doc_id", "text_key", F.explode("segments").alias("s")).select("doc_id", "text_key", "s.*")
    cuts = sorted(set(table.where("doc_id is not null").approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01))) if batches > 1 else []
    index, shared = FingerprintIndex(spark, f"{at}/index"), None
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds, bounds[1:]):  # a fixed number of batches
        batch = segments
        if lo is not None:
            batch = batch.where(F.col("doc_id") > lo)
        if hi is not None:
            batch = batch.where(F.col("doc_id") <= hi)
        found = index.add(batch)
        shared = found if shared is None else shared.unionByName(found)
        release(spark)
    known, anchors = index.rows()
    # an anchor of several segments that do not all start in one document needs its windows compared
    facts = anchors.join(shared.distinct(), "anchor", "left_semi").select("anchor", "n", ((F.col("n") > 1) & (F.col("low") != F.col("last_first"))).alias("mixed"))
    facts = written(facts, f"{at}/facts")
    first = spread_join(known, facts, ["anchor"], "n", ["seg_a"]).select("anchor", "seg_a", "seg_b", F.col("first.doc_id").alias("first_doc"), "docs", "mixed")
    first = written(first, f"{at}/first")
    index.close()
    discard(spark, f"{at}/index", f"{at}/facts")
    release(spark)
    # a segment that equals an earlier document's goes whole; where its anchor also stands in other
    # segments, those of the earliest document itself are compared window by window
    hits = spread_join(segments, first, ["anchor", "seg_a", "seg_b"], "docs", ["doc_id", "at"]).where("doc_id > first_doc or mixed")
    hits = written(hits.select("doc_id", "text_key", "at", "windows", (F.col("doc_id") > F.col("first_doc")).alias("whole")), f"{at}/hits")
    discard(spark, f"{at}/first")
    release(spark)
    windows = written(window_hashes(docs, hits.where(~F.col("whole"))), f"{at}/windows")
    release(spark)
    before = windows.groupBy("hash_a", "hash_b").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.count("*").alias("n")).where("first_doc <> last_doc").drop("last_doc")
    before = written(before, f"{at}/before")
    single = spread_join(windows, before, ["hash_a", "hash_b"], "n", ["doc_id", "at"]).where("doc_id > first_doc").select("doc_id", "text_key", "at", F.lit(1).alias("windows"))
    ranges = hits.where("whole").drop("whole").unionByName(single).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "windows")).alias("ranges"))
    ranges = written(ranges, f"{at}/ranges")
    discard(spark, f"{at}/windows", f"{at}/before", f"{at}/hits")
    release(spark)
    return table, ranges


def _cut(parts_of: Iterator[pa.RecordBatch], text_at: int, ranges_at: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Per batch, (n_words, n_removed, kept words joined by a space as bytes) per row."""
    for part in parts_of:
        raw, offsets = text_buffer(part.column(text_at))
        data, out = raw.tobytes(), []
        for i, ranges in enumerate(part.column(ranges_at)):
            words = data[offsets[i] : offsets[i + 1]].split()
            if not ranges.is_valid:
                out.append((len(words), 0, None))
                continue
            edge = np.zeros(len(words) + 1, np.int32)
            a, n = (ranges.values.field(f).to_numpy(zero_copy_only=False) for f in ("at", "windows"))
            np.add.at(edge, a, 1)
            np.add.at(edge, a + n + WINDOW - 1, -1)
            keep = np.cumsum(edge)[:-1] == 0
            out.append((len(words), int((~keep).sum()), b" ".join(w for w, k in zip(words, keep.tolist()) if k)))
        yield part, out


def dedup_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row."""
    table, ranges = repeated_ranges(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _cut(parts, 1, 2):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    covered = F.aggregate("ranges", F.lit(0), lambda a, r: a + r.windows)  # windows are listed once each
    state = table.select("doc_id", "text_key", "n_words", "words_sha256").join(ranges.select("doc_id", "text_key", covered.alias("covered")), ["doc_id", "text_key"], "left")
    gone = (F.col("covered") == F.col("n_words") - WINDOW + 1)
    plain = state.where(F.col("covered").isNull() | gone).select(
        "doc_id", "n_words", F.when(gone, F.col("n_words")).otherwise(0).cast("long").alias("n_removed"), F.when(gone, F.lit(NOTHING)).otherwise(F.col("words_sha256")).alias("kept_sha256")
    )
    parts = state.where(~gone).select("doc_id", "text_key").distinct().join(ranges, ["doc_id", "text_key"])
    cut = _keyed(docs).join(parts, ["doc_id", "text_key"]).select("doc_id", "text", "ranges").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return plain.unionByName(cut).withColumn("doc_id", F.col("doc_id").cast(kind))


def cut_documents(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages removed: changed texts are their kept words joined by one
    space (with n_chars to match), documents of which nothing is left go, all others and all columns stay as they are."""
    _, ranges = repeated_ranges(docs)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), text.alias("text"), F.struct(*docs.columns).alias("row"))
    joined = rows.join(ranges, ["doc_id", "text_key"], "left").select("row", "text", "ranges")
    schema = T.StructType([T.StructField("row", docs.schema, False), T.StructField("new_text", T.StringType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, out in _cut(parts, 1, 2):
            keep = pa.array([r[2] is None or len(r[2]) > 0 for r in out], pa.bool_())
            new = pa.array([None if r[2] is None else r[2].decode() for r in out], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), new.filter(keep)], ["row", "new_text"])

    cut = joined.mapInArrow(run, schema)
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text")}
    value = lambda f: F.coalesce(new[f.name].cast(f.dataType), F.col("row")[f.name]) if f.name in new else F.col("row")[f.name]
    return cut.select(*(value(f).alias(f.name) for f in docs.schema.fields))
