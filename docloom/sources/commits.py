"""Small committed manifests: a version exists once its manifest has its name, so readers see all of a write or nothing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from docloom.sources.files import filesystem


def versions(spark: SparkSession, at: str) -> list[int]:
    """The committed versions in a folder, ascending."""
    fs, path = filesystem(spark, f"{at}/commits")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def manifest_path(at: str, version: int) -> str:
    return f"{at}/commits/{version:012d}.json"


def commit(spark: SparkSession, at: str, version: int, manifest: dict) -> None:
    """Writes the manifest under a name of its own and then gives it the version's; fails if someone else has committed that version."""
    fs, final = filesystem(spark, manifest_path(at, version))
    _, draft = filesystem(spark, f"{at}/commits/_{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"version {version} of {at} has been committed by another writer")


def manifest(spark: SparkSession, at: str, version: int) -> dict:
    text = spark.read.text(manifest_path(at, version), wholetext=True).first()
    return json.loads(text.value)
