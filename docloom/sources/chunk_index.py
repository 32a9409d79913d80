"""A chunk index that is kept up to date by batches: versions of it are snapshots of buckets, and a batch rewrites only the buckets it changes.

A bucket holds documents by the hash of their key. The manifest of a version names the folder that holds each bucket; folders of earlier
versions stay readable. Documents are compared by the hash of their text on both sides: new and changed ones are chunked, vanished ones
go, all others of a touched bucket are copied without being chunked again, and other buckets are not read but for their documents' hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.sources.commits import commit, manifest, versions
from docloom.sources.files import discard, filesystem, stored

BUCKETS = 64


def bucket_of(key, buckets: int):
    """By the first 32 bits of the key's MD5, null as the empty string."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, at: str, table: str, places: dict[str, str], schema, buckets: list[int] | None = None) -> DataFrame:
    """A table of a version: the folders of its buckets, or of some of them."""
    paths = [f"{at}/{table}/{folder}/bucket={b}" for b, folder in places.items() if folder and (buckets is None or int(b) in buckets)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_index(spark: SparkSession, at: str, version: int | None = None) -> DataFrame:
    """The chunks of the newest version, or of a given one."""
    known = versions(spark, at)
    if not known:
        raise ValueError(f"no version of a chunk index in {at}")
    told = manifest(spark, at, version or known[-1])
    return _read(spark, at, "chunks", told["chunks"], told["chunk_schema"])


def changes(docs: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key, bucket, kind): documents (key, doc_hash, bucket) that are new, changed or vanished."""
    a = docs.select(F.col(key).alias("__a"), F.col("doc_hash").alias("hash_a"), F.col("bucket").alias("bucket_a"), F.lit(True).alias("in_a"))
    b = known.select(F.col(key).alias("__b"), F.col("doc_hash").alias("hash_b"), F.col("bucket").alias("bucket_b"), F.lit(True).alias("in_b"))
    both = a.join(b, F.col("__a").eqNullSafe(F.col("__b")), "full_outer")
    kind = F.when(F.col("in_b").isNull(), "new").when(F.col("in_a").isNull(), "vanished").when(F.col("hash_a") != F.col("hash_b"), "changed")
    return both.select(F.when(F.col("in_a").isNotNull(), F.col("__a")).otherwise(F.col("__b")).alias(key), F.coalesce("bucket_a", "bucket_b").alias("bucket"), kind.alias("kind")).where("kind is not null")


def update_index(docs: DataFrame, at: str, key: str, text: str, build: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> int:
    """Brings the index to the state of ``docs``, one row per key, and returns its version; without any change that is the old one.

    ``build`` makes the chunk rows of documents (key, text), keeping the key. A null text is a document without chunks. A write that ends before its commit
    leaves the old version as it was; its files are never read."""
    spark = docs.sparkSession
    done = versions(spark, at)
    old = manifest(spark, at, done[-1]) if done else {"chunks": {}, "docs": {}}
    buckets = old.get("buckets", buckets)
    kind = docs.schema[key].dataType.simpleString()
    doc_schema = f"{key} {kind}, doc_hash string"
    batch = uuid.uuid4().hex
    given = docs.select(key, text).withColumns({"doc_hash": F.sha2(F.coalesce(F.col(text), F.lit("")), 256), "bucket": bucket_of(key, buckets)})
    known = _read(spark, at, "docs", old["docs"], doc_schema).withColumn("bucket", bucket_of(key, buckets))
    changed = stored(changes(given, known, key), f"{at}/changes/{batch}")
    touched = sorted(r.bucket for r in changed.select("bucket").distinct().collect())  # no more than there are buckets
    if done and not touched:
        discard(spark, f"{at}/changes/{batch}")
        return done[-1]
    moved = changed.select(F.col(key).alias("__key"))
    same = F.col(key).eqNullSafe(F.col("__key"))
    # the first batch is new as a whole; later ones join their texts with the changes by a merge, whatever the sizes
    news = changed.where("kind <> 'vanished'").select(F.col(key).alias("__key")).hint("merge")
    fresh = build((given.join(news, same, "left_semi") if done else given).select(key, text))
    chunk_schema = old.get("chunk_schema") or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema)
    kept = _read(spark, at, "chunks", old["chunks"], chunk_schema, touched).join(moved, same, "left_anti")
    rows = kept.unionByName(fresh).withColumn("bucket", bucket_of(key, buckets))
    rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{at}/chunks/{batch}")
    here = given.join(F.broadcast(changed.select("bucket").distinct()), "bucket", "left_semi").select(key, "doc_hash", "bucket")  # no more rows than buckets
    here.repartition("bucket").write.partitionBy("bucket").parquet(f"{at}/docs/{batch}")
    told = {"buckets": buckets, "chunk_schema": chunk_schema, "doc_schema": doc_schema}
    for table in ("chunks", "docs"):
        fs, path = filesystem(spark, f"{at}/{table}/{batch}")
        there = {s.getPath().getName().removeprefix("bucket=") for s in fs.listStatus(path)}
        told[table] = old[table] | {str(b): batch if str(b) in there else "" for b in touched}
    version = (done[-1] if done else 0) + 1
    commit(spark, at, version, told)
    discard(spark, f"{at}/changes/{batch}")
    return version
