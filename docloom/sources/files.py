"""Readers and writers of the formats that the document tables come in."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.operators.enrich import latest

KEYWORDS = {"사증": "visa", "체류": "stay"}  # fixed values: what a file's name says about its manual


def scratch(spark: SparkSession) -> str:
    """A fresh folder below the folder that driver and executors share; a local master may do without naming one."""
    named = spark.sparkContext._jsc.sc().getCheckpointDir()
    base = spark.conf.get("spark.checkpoint.dir", None) or (named.get() if named.isDefined() else None)
    if base is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{(base or '/tmp/docloom-shared').rstrip('/')}/files-{uuid.uuid4().hex}"


def stored(df: DataFrame, at: str) -> DataFrame:
    """The rows written as Parquet and read back: what several steps read is made once, and outlives executors."""
    df.write.mode("overwrite").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def filesystem(spark: SparkSession, at: str):
    """(file system, path) of Spark's own reading of a path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that no result reads any more."""
    for at in paths:
        fs, path = filesystem(spark, at)
        fs.delete(path, True)


def catalogue(spark: SparkSession, sections: list[dict]) -> DataFrame:
    """(section, place, id, kind, title, optional, options) of a questionnaire's sections, one row per question in order."""
    option = "struct<value:string,label:string>"
    schema = f"id string, questions array<struct<id:string,kind:string,title:string,optional:boolean,options:array<{option}>>>"
    given = spark.createDataFrame([(s["id"], [(q["id"], q["kind"], q["title"], q.get("optional", False), [(o["value"], o["label"]) for o in q.get("options", [])]) for q in s["questions"]]) for s in sections], schema)
    return given.select(F.col("id").alias("section"), F.posexplode("questions").alias("place", "q")).select("section", F.col("place") + 1, "q.*").withColumnRenamed("(place + 1)", "place")


def discover(spark: SparkSession, glob: str, keywords: dict[str, str] = KEYWORDS) -> DataFrame:
    """(path, modified, length, manual_key) by the first keyword in each file's name, ordered by path; contents are not read.

    Fails on a name without a keyword and on two files of one manual.
    """
    files = spark.read.format("binaryFile").load(glob).select("path", F.col("modificationTime").alias("modified"), "length")
    name = F.url_decode(F.substring_index("path", "/", -1))
    key = None
    for word, value in keywords.items():
        key = F.when(name.contains(word), value) if key is None else key.when(name.contains(word), value)
    out = files.withColumn("manual_key", F.coalesce(key, F.raise_error(F.concat(F.lit("no manual is named in "), name)).cast("string")))
    again = out.groupBy("manual_key").count().where("count > 1").first()
    if again:
        raise ValueError(f"several files for the manual {again.manual_key}")
    return out.orderBy("path")


def stale(files: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """The files (path, modified) whose result is missing or older than they are."""
    if force:
        return files
    done = manifest.select("path", F.col("modified").alias("__done"))
    return files.join(done, "path", "left").where("__done is null or __done < modified").drop("__done")


def changed(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose (id, content hash) pair was not processed before."""
    return rows.join(done.select(*keys), keys, "left_anti")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, lines): whole files as line arrays, split as Python's splitlines does."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), T.split_lines("value").alias("lines"))


def read_jsonl(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """One row per key, the last in the order of files, of blocks of a file and of lines; blank lines are skipped."""
    rows = spark.read.schema(schema).json(path)
    place = {"__file": F.col("_metadata.file_path"), "__block": F.col("_metadata.file_block_start"), "__at": F.monotonically_increasing_id()}
    return latest(rows.withColumns(place), key, list(place)).drop(*place)


def write_jsonl(rows: DataFrame, path: str, single: bool = False) -> None:
    """``single``: one file, for a small index in the order of its rows; else a file per task."""
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted cells may span lines, a byte order mark is skipped, empty cells are empty strings."""
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return rows.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c.removeprefix("﻿")) for c in rows.columns))


def write_csv(rows: DataFrame, path: str, columns: dict[str, str]) -> None:
    """RFC 4180 with the columns in order under their published names; the header of every part starts with a byte order mark."""
    names = list(columns.values())
    named = rows.select(*(F.col(c).alias(("﻿" if k == 0 else "") + n) for k, (c, n) in enumerate(zip(columns, names))))
    named.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_report(report: DataFrame, path: str) -> None:
    """One indented JSON object per row."""
    text = report.select(F.to_json(F.struct(*report.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("value"))
    text.write.mode("overwrite").text(path)


def cached(spark: SparkSession, at: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """A table such as page texts (page, text), whose making is dear: made once below ``at``, read from there ever after; ``force`` makes it anew."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
    if force or not done.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(done):
        build().write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)


SHEET_ROWS = 1_048_575  # fixed value: what a sheet holds below its header


def mirror_xlsx(rows: DataFrame, path: str, strict: bool = False) -> bool:
    """The table as one sheet, for readers of spreadsheets; no more rows than a sheet holds. Without a spreadsheet library it
    fails if ``strict``, else the mirror is left out (False)."""
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        if strict:
            raise
        return False
    if rows.limit(SHEET_ROWS + 1).count() > SHEET_ROWS:
        raise ValueError("more rows than a sheet holds")
    rows.toPandas().to_excel(path, index=False, engine="openpyxl")
    return True
