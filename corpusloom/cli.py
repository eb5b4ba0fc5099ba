"""Command line: curate, process, ingest, index, query, analyse, stats, guard.

    python -m corpusloom.cli curate --input raw/ --output out/
    python -m corpusloom.cli query "scarlet rot" --index index/ --filter category=npc
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.values import first_filled, flag
from .operators import analysis, guard, incremental, lore, motifs, process, profile, reconcile, retrieval
from .session import session
from .sources import readers, records, writers

DIMENSIONS = 64


def _entities(spark: SparkSession, folder: str) -> DataFrame:
    """Entities of all files of a folder; a file's stem is its table, "dlc" in its path its edition."""
    out = None
    for i, path in enumerate(readers.data_files(folder, spark)):
        df = readers.read_any(spark, path)
        kind = "dlc" if "dlc" in path.lower() else "api" if path.endswith(".json") else "base"
        stem = Path(path).stem.lower()
        name = first_filled(*[c for c in records.NAMES["name"] if c in df.columns]) if any(c in df.columns for c in records.NAMES["name"]) else F.lit(None).cast("string")
        rows = df.select(
            F.lit(stem.rstrip("s")).alias("entity_type"), name.alias("name"), records.field(df, "description").alias("description"),
            (F.lit(True) if kind == "dlc" else F.coalesce(flag(records.field(df, "dlc")), F.lit(False))).alias("is_dlc"),
            F.lit(stem).alias("source"), F.lit(reconcile.PRIORITY[kind]).alias("priority"), F.struct(F.lit(i).alias("file"), F.monotonically_increasing_id().alias("row")).alias("ordinal"),
            records.meta_map(df, ["name", "description"]).alias("meta"),
        ).where(F.col("name").isNotNull())
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise SystemExit(f"no data files in {folder}")
    return out


def curate(spark: SparkSession, a: argparse.Namespace) -> int:
    """Reconcile the entities of a folder and export them; with --baseline only what changed since."""
    done = reconcile.reconcile(_entities(spark, a.input)).drop("ordinal", "source", "priority")
    state = Path(a.output) / "state"
    if a.incremental and state.exists():
        old = spark.read.parquet(str(state))
        fresh = incremental.changed(done.withColumn("_k", F.concat_ws(":", "entity_type", "slug")), old.withColumn("_k", F.concat_ws(":", "entity_type", "slug")), "_k", ["name", "description", "is_dlc"])
        if fresh.isEmpty():
            print("nothing changed")
            return 0
        print(f"{fresh.count()} new or changed")
    done = done.persist()
    writers.export_by_type(done, a.output)
    writers.write_lineage(done, f"{a.output}/lineage")
    writers.write_json(writers.metadata(done), f"{a.output}/metadata.json")
    writers.quality_report(profile.profile(done.drop("meta", "sources")), "Curated entities", f"{a.output}/quality.html")
    writers.write_parquet(done.drop("meta"), str(state))
    done.unpersist()
    return 0


def run_process(spark: SparkSession, a: argparse.Namespace) -> int:
    """Bring a raw file into a data set's schema; exit code 1 if rules are broken."""
    done = process.process(readers.read_any(spark, a.input), a.dataset)
    writers.write_parquet(done.rows, a.output)
    broken = done.violations.collect()
    for r in broken:
        print(f"{r['rule']} {r['column_name']}: {r['violations']}")
    return int(bool(broken))


def ingest(spark: SparkSession, a: argparse.Namespace) -> int:
    """Apply annotation bundles to the annotation table; conflicts aren't applied, and give exit code 1 unless allowed."""
    bundles = readers.read_bundles(spark, a.bundles)
    table, manifest = Path(a.store) / "annotations", Path(a.store) / "manifest"
    schema = "annotation_id string, annotation string, revisions string"
    held = spark.read.parquet(str(table)) if table.exists() else spark.createDataFrame([], schema)
    known = spark.read.parquet(str(manifest)) if manifest.exists() else spark.createDataFrame([], "annotation_id string, updated_at timestamp, checksum string")
    last = incremental.latest(bundles, ["annotation_id"], "updated_at", "path")
    done = incremental.classify_bundles(last, known, a.allow_conflicts).persist()
    counts = {r["outcome"]: r["count"] for r in done.groupBy("outcome").count().collect()}
    print(json.dumps(counts, sort_keys=True))
    if not a.dry_run:
        new = incremental.upsert(held, done, done.select("annotation_id", "annotation", "revisions"))
        entries = incremental.upsert(known, done, done.select("annotation_id", "updated_at", "checksum"))
        for df, path in ((new, table), (entries, manifest)):
            writers.write_parquet(df, f"{path}.new")
        for path in (table, manifest):
            _replace(Path(f"{path}.new"), path)
    done.unpersist()
    return int(bool(counts.get("conflict")) and not a.allow_conflicts)


def _replace(new: Path, old: Path) -> None:
    import shutil

    if old.exists():
        shutil.rmtree(old)
    new.rename(old)


def index(spark: SparkSession, a: argparse.Namespace) -> int:
    """Compose weighted texts per entity, encode them, and write the vector table."""
    weights = readers.weights_from_yaml(a.weights, lore.WEIGHTS) if a.weights else lore.WEIGHTS
    lines = spark.read.parquet(a.lore)
    ordinal = "lore_id" if "lore_id" in lines.columns else "doc_id"
    texts = lore.weighted_texts(lines, "canonical_id", "text_type", "text", ordinal, weights)
    extra = lines.where(F.col("canonical_id").isNotNull()).groupBy("canonical_id").agg(F.min("category").alias("category"), F.array_join(F.array_sort(F.collect_set("source")), "|").alias("source"))
    vectors = texts.join(extra, "canonical_id", "left").withColumn("embedding", retrieval.HashedWords(DIMENSIONS).column(F.col("embedding_text")))
    writers.write_parquet(vectors, f"{a.output}/vectors")
    writers.write_json(guard.guard_state({"lore": a.lore}, {"dimensions": DIMENSIONS, "weights": weights}), f"{a.output}/guard.json")
    return 0


def run_query(spark: SparkSession, a: argparse.Namespace) -> int:
    """Print the best entities for a text."""
    vector = list(spark.range(1).select(retrieval.HashedWords(DIMENSIONS).column(F.lit(a.text)).alias("v")).first()["v"])
    found = retrieval.search(spark.read.parquet(f"{a.index}/vectors"), vector, a.top_k, "canonical_id", "embedding", a.filter, a.mode)
    for r in found.orderBy("position").collect():
        print(json.dumps({k: r[k] for k in ("position", "canonical_id", "score", "text_type", "category")}, ensure_ascii=False))
    return 0


def analyse(spark: SparkSession, a: argparse.Namespace) -> int:
    """Coverage, graph, summaries or clusters of a lore table."""
    taxonomy = readers.motifs_from_yaml(a.taxonomy)
    lines = spark.read.parquet(a.lore).where("trim(text) <> ''")
    key = "lore_id" if "lore_id" in lines.columns else "doc_id"
    found = motifs.hits(lines, taxonomy, "text", [key, "canonical_id"])
    if a.what == "coverage":
        cover = motifs.coverage(lines, taxonomy, key)
        writers.write_parquet(cover, f"{a.output}/coverage")
        Path(f"{a.output}/coverage.md").write_text(writers.markdown(cover.drop("sample_ids").orderBy("category", "motif_slug")))
    elif a.what == "graph":
        edges = motifs.graph_edges(lines, found, "canonical_id", key)
        writers.write_graph(motifs.graph_nodes(edges), edges, f"{a.output}/graph")
    elif a.what == "summaries":
        summary = motifs.entity_summary(lines, found, "canonical_id", key, "category")
        tops = motifs.top_motifs(motifs.entity_motif_stats(found, "canonical_id", key), taxonomy, "canonical_id", a.max_motifs)
        cited = motifs.quotes(lines, found.where("canonical_id IS NOT NULL"), taxonomy, "canonical_id", key, "text", a.max_quotes)
        told = motifs.heuristic_summary(summary, tops, cited, "canonical_id", "category", "text")
        writers.write_parquet(told, f"{a.output}/summaries")
        writers.write_jsonl(told, f"{a.output}/summaries_json")
    else:
        coded = lines.withColumn("vector", retrieval.HashedWords(DIMENSIONS).column(F.col("text")))
        members = analysis.clustered(analysis.components(coded, "vector", 15), "components", a.clusters)
        density = motifs.cluster_density(members, motifs.hits(lines, taxonomy, "text", [key]), motifs.coverage(lines, taxonomy, key), "cluster_id", key)
        writers.write_parquet(density, f"{a.output}/density")
        writers.write_parquet(motifs.exemplars(members, "cluster_id", "cluster_probability", "text", a.exemplars).drop("vector", "components"), f"{a.output}/exemplars")
    return 0


def stats(spark: SparkSession, a: argparse.Namespace) -> int:
    """Lines and entities by source, category and text type."""
    lines = spark.read.parquet(a.lore)
    print(writers.markdown(lore.lore_stats(lines, [c for c in ("source", "category", "text_type") if c in lines.columns], "canonical_id").orderBy("column_name", "value")))
    return 0


def run_guard(spark: SparkSession, a: argparse.Namespace) -> int:
    """Exit code 0 if the index is of this lore, 1 if not."""
    stored = Path(a.index) / "guard.json"
    old = json.loads(stored.read_text()) if stored.exists() else None
    state = guard.guard_state({"lore": a.lore}, (old or {}).get("settings", {}))
    print(state["fingerprint"])
    return int(not guard.unchanged(state, old))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusloom")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, *arguments: tuple) -> None:  # noqa: ANN001
        s = sub.add_parser(name, help=run.__doc__)
        for flags, options in arguments:
            s.add_argument(*flags, **options)
        s.set_defaults(run=run)

    need = {"required": True}
    command("curate", curate, (["--input"], need), (["--output"], need), (["--incremental"], {"action": "store_true"}))
    command("process", run_process, (["--input"], need), (["--dataset"], need), (["--output"], need))
    command("ingest", ingest, (["--bundles"], need), (["--store"], need), (["--allow-conflicts"], {"action": "store_true"}), (["--dry-run"], {"action": "store_true"}))
    command("index", index, (["--lore"], need), (["--output"], need), (["--weights"], {}))
    command("query", run_query, (["text"], {}), (["--index"], need), (["--top-k"], {"type": int, "default": 10}), (["--filter"], {"action": "append", "default": []}), (["--mode"], {"choices": ["balanced", "raw"], "default": "balanced"}))
    command(
        "analyse", analyse, (["what"], {"choices": ["coverage", "graph", "summaries", "clusters"]}), (["--lore"], need), (["--taxonomy"], need), (["--output"], need), (["--max-motifs"], {"type": int, "default": 4}),
        (["--max-quotes"], {"type": int, "default": 3}), (["--clusters"], {"type": int, "default": 20}), (["--exemplars"], {"type": int, "default": 5}),
    )
    command("stats", stats, (["--lore"], need))
    command("guard", run_guard, (["--lore"], need), (["--index"], need))
    return p


def main(arguments: list[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    spark = session("corpusloom")
    return a.run(spark, a)



if __name__ == "__main__":
    sys.exit(main())
