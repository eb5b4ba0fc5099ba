"""Incremental maintenance: skipping by signature, baseline diff, versioned upserts with conflicts, revisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reconcile import first_by


def unseen(records: DataFrame, manifest: DataFrame, keys: list[str], since: Column | None = None) -> DataFrame:
    """Records to process: those whose signature isn't in the manifest, or, with ``since``, was recorded at it or later.

    A record recorded before ``since`` is done; one recorded since then is done again.
    """
    done = manifest if since is None else manifest.where(F.col("recorded_at") < since)
    return records.join(done.select(*keys).distinct(), keys, "left_anti")


def manifest_of(records: DataFrame, keys: list[str], at: Column) -> DataFrame:
    """Manifest rows of processed records."""
    return records.select(*keys).distinct().withColumn("recorded_at", at)


def content_hash(df: DataFrame, columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def changed(current: DataFrame, baseline: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows that are new or differ from the baseline in ``columns``."""
    before = baseline.select(key, content_hash(baseline, columns).alias("_h"))
    return current.withColumn("_h", content_hash(current, columns)).join(before, [key, "_h"], "left_anti").drop("_h")


def classify_bundles(bundles: DataFrame, manifest: DataFrame, allow_conflicts: bool = False) -> DataFrame:
    """Each bundle with its outcome: created, updated, deleted, skipped (same checksum, or deleting what isn't there) or conflict (stale).

    bundles: annotation_id, operation, updated_at, checksum. manifest: annotation_id, updated_at, checksum.
    """
    held = manifest.select("annotation_id", F.col("updated_at").alias("_at"), F.col("checksum").alias("_sum"))
    stale = (F.col("updated_at") <= F.col("_at")) & F.lit(not allow_conflicts)
    known = F.col("_at").isNotNull()
    outcome = (
        F.when((F.col("operation") == "delete") & ~known, "skipped")
        .when(known & F.col("checksum").eqNullSafe(F.col("_sum")) & (F.col("operation") != "delete"), "skipped")
        .when(known & stale, "conflict")
        .when(F.col("operation") == "delete", "deleted")
        .when(known, "updated")
        .otherwise("created")
    )
    return bundles.join(held, "annotation_id", "left").withColumn("outcome", outcome).drop("_at", "_sum")


def upsert(table: DataFrame, classified: DataFrame, rows: DataFrame, key: str = "annotation_id") -> DataFrame:
    """The table after bundles: rows of updated and deleted keys dropped, rows of created and updated keys added."""
    touched = classified.where(F.col("outcome").isin("created", "updated", "deleted")).select(key).distinct()
    added = classified.where(F.col("outcome").isin("created", "updated")).select(key).distinct()
    kept = table.join(touched, key, "left_anti")
    return kept.unionByName(rows.join(added, key, "left_semi"), allowMissingColumns=True)


def latest(events: DataFrame, keys: list[str], at: str, tie: str, deleted: Column | None = None) -> DataFrame:
    """Last row of each key by time, then the larger tie; keys whose last row is a deletion are left out."""
    rest = [c for c in events.columns if c not in keys]
    last = events.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(at, tie)).alias("_row"))
    out = last.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*events.columns)
    return out if deleted is None else out.where(~F.coalesce(deleted, F.lit(False)))


def current_revision(revisions: DataFrame, key: str = "annotation_id") -> DataFrame:
    """Of each key the current revision: the one flagged, else the highest version."""
    return first_by(revisions, [key], [~F.coalesce(F.col("is_current"), F.lit(False)), -F.col("version")])


def tag_changes(revisions: DataFrame, key: str = "annotation_id", tags: str = "tags") -> DataFrame:
    """Tags added and removed by each revision against the version before it: key, version, added, removed (sorted)."""
    before = revisions.select(key, (F.col("version") + 1).alias("version"), F.col(tags).alias("_old"))
    old = F.coalesce("_old", F.array().cast("array<string>"))
    return revisions.join(before, [key, "version"], "left").select(
        key, "version", F.array_sort(F.array_except(tags, old)).alias("added"), F.array_sort(F.array_except(old, F.col(tags))).alias("removed")
    )


def distinct_in_order(items: Column | str) -> Column:
    """Trimmed, filled items of an array, each once, in order."""
    a = F.col(items) if isinstance(items, str) else items
    return F.array_distinct(F.filter(F.transform(a, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))


def orphans_removed(chunks: DataFrame, documents: DataFrame, key: str) -> DataFrame:
    """Chunks whose document still exists (a cascading delete)."""
    return chunks.join(documents.select(key).distinct(), key, "left_semi")
