"""Fingerprints: whether files and settings are those a result was made of, and which data sets have changed."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_hash(path: str) -> str:
    """sha256 of a file, or of the names and contents of a folder's files."""
    p = Path(path)
    h = hashlib.sha256()
    for q in [p] if p.is_file() else sorted(x for x in p.rglob("*") if x.is_file()):
        if q != p:
            h.update(str(q.relative_to(p)).encode())
        with q.open("rb") as f:
            while block := f.read(1 << 20):
                h.update(block)
    return h.hexdigest()


def fingerprint(document: dict) -> str:
    """sha256 of a document's JSON with sorted keys."""
    return hashlib.sha256(json.dumps(document, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()


def guard_state(files: dict[str, str], settings: dict) -> dict:
    """Hashes of files and settings with their fingerprint."""
    state = {"files": {n: file_hash(p) for n, p in files.items()}, "settings": settings}
    return state | {"fingerprint": fingerprint(state)}


def unchanged(state: dict, stored: dict | None) -> bool:
    return bool(stored) and stored.get("fingerprint") == state["fingerprint"]


def folder_hashes(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, sha256 of each file below a folder, hashed where the tasks run."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def pending(hashes: DataFrame, cache: DataFrame, schema_tag: str, force: bool = False) -> DataFrame:
    """Files to process: those whose hash or schema tag isn't in the cache (path, sha256, schema_tag); all with ``force``."""
    if force:
        return hashes
    done = cache.where(F.col("schema_tag") == schema_tag).select("path", "sha256")
    return hashes.join(done, ["path", "sha256"], "left_anti")
