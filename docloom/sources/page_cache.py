"""Page texts of manuals, kept as JSON caches of the form ``{"pages": [text, ...]}``: a writer that makes only what is missing, and a data source that reads them.

A cache file holds ``SPAN`` successive pages at most; its folder names the manual, the first page, the number of pages and the hash of the source, so
a file whose source has changed is made again and the rest is left alone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from docloom.sources.files import discard, filesystem, stored

SPAN = 256  # pages in a file
RANGE = 64  # pages in a task
SCHEMA = "manual string, page long, text string"


@dataclass(frozen=True)
class CacheFile:
    path: str
    manual: str
    first: int
    count: int


@dataclass
class PageRange(InputPartition):
    path: str
    manual: str
    first: int  # the file's first page
    least: int
    most: int


def cache_files(path: str) -> list[CacheFile]:
    """The cache files below a folder, from their folders' names alone."""
    fs, root = pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)
    out = []
    for info in fs.get_file_info(pa.fs.FileSelector(root, recursive=True, allow_not_found=True)):
        named = dict(p.split("=", 1) for p in info.path.split("/") if "=" in p)
        if info.is_file and info.base_name.startswith("part-") and {"manual", "first", "count"} <= named.keys():
            out.append(CacheFile(info.path, unquote(named["manual"]), int(named["first"]), int(named["count"])))
    return sorted(out, key=lambda f: (f.manual, f.first))


class PageCacheReader(DataSourceReader):
    """Partitions are files and page ranges; the asked manuals and pages choose them before any file is opened.

    They are options of the reading and not filters that Spark pushes down: Spark 4.1 keeps pushed filters in the frame's relation, so a frame that
    is read twice, once with a condition, would lack rows the other time."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.manuals = set(json.loads(options["manuals"])) if "manuals" in options else None
        self.least, self.most = (int(options[c]) if c in options else None for c in ("least", "most"))

    def partitions(self) -> list[InputPartition]:
        out = []
        for file in cache_files(self.path):
            if self.manuals is not None and file.manual not in self.manuals:
                continue
            end = file.first + file.count
            for a in range(file.first, end, RANGE):
                least = a if self.least is None else max(a, self.least)
                most = min(a + RANGE, end) - 1
                most = most if self.most is None else min(most, self.most)
                if least <= most:
                    out.append(PageRange(file.path, file.manual, file.first, least, most))
        return out or [PageRange("", "", 0, 0, -1)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        p = partition
        texts = []
        if p.path:
            fs = pa.fs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else pa.fs.LocalFileSystem()
            with fs.open_input_stream(p.path) as f:
                texts = json.loads(f.read().decode())["pages"][p.least - p.first : p.most - p.first + 1]
        n = len(texts)
        yield pa.RecordBatch.from_arrays([pa.array([p.manual] * n, pa.string()), pa.array(range(p.least, p.least + n), pa.int64()), pa.array(texts, pa.string())], ["manual", "page", "text"])


class PageCache(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_cache"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PageCacheReader(self.options)


def read_pages(spark: SparkSession, at: str, manuals: list[str] | None = None, least: int | None = None, most: int | None = None) -> DataFrame:
    """(manual, page, text) of all caches below a folder, or of some manuals and of pages ``least`` to ``most``, both included."""
    spark.dataSource.register(PageCache)
    fs, path = filesystem(spark, at)
    asked = {"least": least, "most": most, "manuals": None if manuals is None else json.dumps(manuals)}
    return spark.read.format("page_cache").options(**{k: str(v) for k, v in asked.items() if v is not None}).load(fs.makeQualified(path).toString())


def write_pages(pages: DataFrame, at: str, work: str) -> int:
    """Brings the caches to the state of ``pages`` (manual, page, text) and returns how many files were made.

    Pages are numbered from 1 without gaps in a manual; a null text is an empty one. ``work``: a fresh folder. Files of changed or vanished pages go."""
    spark = pages.sparkSession
    first = (F.floor((F.col("page") - 1) / SPAN) * SPAN + 1).alias("first")
    entry = F.struct("page", F.coalesce("text", F.lit("")).alias("text"))
    grouped = pages.groupBy("manual", first).agg(F.sort_array(F.collect_list(entry)).alias("held"), F.count("*").alias("count"))  # SPAN pages at most
    made = grouped.select("manual", "first", "count", F.to_json(F.struct(F.transform("held", lambda p: p.text).alias("pages"))).alias("value"))
    made = made.withColumn("hash", F.substring(F.sha2("value", 256), 1, 16))
    made = stored(made, f"{work}/made")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
    fs, path = filesystem(spark, at)
    part = lambda n: F.url_decode(F.regexp_extract("path", f"/{n}=([^/]*)/", 1))
    names = ["manual", "first", "count", "hash"]
    if fs.exists(path):
        there = found.load(at).select(*(part(n).alias(n) for n in names), F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"))
        there = stored(there.select("manual", F.col("first").cast("long").alias("first"), F.col("count").cast("long").alias("count"), "hash", "folder"), f"{work}/there")
        stale = [r.folder for r in there.join(made, names, "left_anti").collect()]  # what has changed since
        made = made.join(there.select(*names), names, "left_anti")
    else:
        stale = []
    made = stored(made, f"{work}/missing")
    made.write.mode("append").partitionBy(*names).text(at)
    n = made.count()
    discard(spark, *stale, work)
    return n
