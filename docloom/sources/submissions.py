"""Questionnaire submissions as an ordered log: appended in batches, read newest inserted first, by ranges that open only the files they need.

A batch is written in order over files; the manifest says how many records each file holds and how many came before the batch. So a
record's number is the batch's first number, plus the files before its own, plus its place in the file: prefix sums, not a sort of the log.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.sources.commits import commit, versions

_MANIFEST = "folder string, first bigint, parts array<struct<part:bigint,count:bigint>>"


def record(body: Column, received: Column) -> Column:
    """A JSON object body with the time of receipt in front, unless it names ``receivedAt`` itself, be it with null; other bodies fail."""
    at = F.date_format(F.to_utc_timestamp(received, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    text = F.trim(F.regexp_replace(body, "[\\r\\n]", " "))
    ok = F.try_parse_json(text).isNotNull() & text.startswith("{")
    inner = F.trim(F.substring(text, F.lit(2), F.length(text) - 2))
    own = F.array_contains(F.json_object_keys(text), "receivedAt")
    stamp = F.when(own, F.lit("")).otherwise(F.concat(F.lit('"receivedAt":"'), at, F.lit('"'), F.when(inner == "", "").otherwise(",")))
    return F.when(ok, F.concat(F.lit("{"), stamp, inner, F.lit("}"))).otherwise(F.raise_error(F.lit("invalid body")).cast("string"))


def parsed(value: Column) -> list[Column]:
    """The fields of a record; a single answer, whatever it begins with, becomes an array of one."""
    v = F.parse_json(value)
    field = lambda p, t: F.try_variant_get(v, f"$.{p}", t).alias(p)
    answers = F.transform_values(F.try_variant_get(v, "$.answers", "map<string,variant>"), lambda k, x: F.coalesce(F.try_variant_get(x, "$", "array<string>"), F.array(F.try_variant_get(x, "$", "string"))))
    return [*(field(c, "string") for c in ("receivedAt", "intervieweeName", "submittedAt", "startedAt")), field("durationSeconds", "bigint"), answers.alias("answers")]


def append(bodies: DataFrame, at: str, order: list[str], received: Column, body: str = "body") -> int:
    """Adds bodies to the log in ``order`` (which should tell them apart) and returns the number of records in it.

    A batch that fails before its commit leaves the log as it was; of two writers at once one fails."""
    spark = bodies.sparkSession
    done = versions(spark, at)
    before = 0
    if done:
        last = _manifests(spark, at).where(F.col("version") == done[-1]).select(F.col("first") + F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["count"])).first()
        before = last[0]
    folder = uuid.uuid4().hex
    dealt = bodies.select(*order, record(F.col(body), received).alias("value")).repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()  # partition, then place in it
    rows = dealt.select(F.shiftright(number, 33).alias("part"), number.bitwiseAND(F.lit((1 << 33) - 1)).alias("nth"), "value")
    rows.write.partitionBy("part").parquet(f"{at}/data/{folder}")
    counts = spark.read.schema("nth long, value string, part long").parquet(f"{at}/data/{folder}").groupBy("part").count().orderBy("part").collect()  # a row per file
    if not counts:
        return before
    commit(spark, at, (done[-1] if done else 0) + 1, {"folder": folder, "first": before, "parts": [{"part": r.part, "count": r["count"]} for r in counts]})
    return before + sum(r["count"] for r in counts)


def _manifests(spark: SparkSession, at: str) -> DataFrame:
    rows = spark.read.schema(_MANIFEST).option("pathGlobFilter", "[0-9]*.json").json(f"{at}/commits")
    return rows.withColumn("version", F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).cast("long"))


def files_of(spark: SparkSession, at: str, start: int = 0, stop: int = -1) -> tuple[list[tuple[str, int]], int, int, int]:
    """([(path, number of its first record)], least, greatest number, records in the log): what a range of places needs, place 0 being the newest record."""
    if not versions(spark, at):
        return [], 0, -1, 0
    parts = _manifests(spark, at).select("version", "folder", "first", F.posexplode("parts").alias("k", "p")).select("folder", "first", "k", "p.part", "p.count")
    inside = Window.partitionBy("folder").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("first") + F.coalesce(F.sum("count").over(inside), F.lit(0))
    placed = parts.select("folder", "part", "count", first.alias("from"))
    total = placed.agg(F.coalesce(F.max(F.col("from") + F.col("count")), F.lit(0))).first()[0]
    a, b = (max(start + total, 0) if start < 0 else start), min(stop + total if stop < 0 else stop, total - 1)
    low, high = total - 1 - b, total - 1 - a
    if a > b:
        return [], 0, -1, total
    needed = placed.where((F.col("from") <= high) & (F.col("from") + F.col("count") > low)).collect()  # one row per file of the range
    return [(f"{at}/data/{r.folder}/part={r.part}", r["from"]) for r in needed], low, high, total


def read_range(spark: SparkSession, at: str, start: int = 0, stop: int = -1) -> DataFrame:
    """(place, fields of the submission) of the places ``start`` to ``stop``, both included, newest inserted first; negative places count from the oldest, -1."""
    paths, low, high, total = files_of(spark, at, start, stop)
    empty = spark.createDataFrame([], "nth long, value string, base long")
    rows = empty
    if paths:
        read = spark.read.schema("nth long, value string").parquet(*(p for p, _ in paths))
        known = spark.createDataFrame([("/".join(p.split("/")[-2:]), n) for p, n in paths], "of string, base long")
        of = F.concat_ws("/", F.slice(F.split(F.col("_metadata.file_path"), "/"), -3, 2))
        rows = read.withColumn("of", of).join(F.broadcast(known), "of").select("nth", "value", "base")  # one row per file of the range
    number = F.col("base") + F.col("nth")
    return rows.where(number.between(low, high)).select((F.lit(total - 1) - number).alias("place"), *parsed(F.col("value"))).orderBy("place")
