"""Writers: Parquet, CSV with nested values as JSON, partitioned exports, metadata, lineage, reports, JSON lines, graphs."""

from __future__ import annotations

import html
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType


#: Written so that texts come back as they are, white space at their ends and quotes included.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet, in one pass also where it is partitioned."""
    df.write.mode(mode).option("compression", compression).partitionBy(*(partition_by or [])).parquet(path)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text: null maps and structs as {}, null arrays as []."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (StructType, MapType, VariantType)):
            out[f.name] = F.coalesce(F.to_json(F.col(f.name)), F.lit("{}"))
        elif isinstance(f.dataType, ArrayType):
            out[f.name] = F.coalesce(F.to_json(F.col(f.name)), F.lit("[]"))
    return df.withColumns(out) if out else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    flat(df).write.mode(mode).csv(path, **CSV)


def export_by_type(df: DataFrame, folder: str, column: str = "entity_type") -> None:
    """Parquet and CSV parts by entity type, each in one pass over the data."""
    write_parquet(df, f"{folder}/parquet", partition_by=[column])
    flat(df).write.mode("overwrite").partitionBy(column).csv(f"{folder}/csv", **CSV)


def metadata(df: DataFrame, kind: str = "entity_type", edition: str = "is_dlc", sources: str = "sources") -> dict:
    """Counts of a curated table: total, dlc, base, by type, by source. A few numbers reach the driver."""
    total = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(edition, F.lit(False))).alias("dlc")).first()
    types = {r[kind]: r["n"] for r in df.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).collect()}
    by_source = {r["s"]: r["n"] for r in df.select(F.explode(sources).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {"total": total["n"], "dlc": total["dlc"], "base": total["n"] - total["dlc"], "by_type": types, "by_source": by_source}


def write_json(doc: dict, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(doc, indent=2, sort_keys=True, default=str, ensure_ascii=False))


def lineage(df: DataFrame, kind: str = "entity_type", slug: str = "slug", sources: str = "sources") -> DataFrame:
    """Lineage rows: type, slug, sources (sorted), n_sources."""
    return df.select(kind, slug, F.array_sort(sources).alias("sources"), F.size(sources).alias("n_sources"))


def write_lineage(df: DataFrame, folder: str, kind: str = "entity_type", slug: str = "slug", sources: str = "sources") -> None:
    """Lineage as JSON lines by type, sorted by slug within each file."""
    rows = lineage(df, kind, slug, sources)
    rows.repartitionByRange(kind, slug).sortWithinPartitions(kind, slug).write.mode("overwrite").partitionBy(kind).json(folder)


def quality_report(profiled: DataFrame, title: str, path: str) -> None:
    """A profile as an HTML table and JSON beside it; a row per column."""
    rows = [r.asDict() for r in profiled.orderBy("column_name").collect()]
    names = profiled.columns
    cells = lambda r: "".join(f"<td>{html.escape('' if r[n] is None else str(r[n]))}</td>" for n in names)
    head = "".join(f"<th>{html.escape(n)}</th>" for n in names)
    body = "".join(f"<tr>{cells(r)}</tr>" for r in rows)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(f"<html><head><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1><table><tr>{head}</tr>{body}</table></body></html>")
    write_json({"title": title, "columns": rows}, str(Path(path).with_suffix(".json")))


def write_jsonl(df: DataFrame, path: str, row: Column | None = None) -> None:
    """One JSON object per line."""
    df.select(F.to_json(row if row is not None else F.struct(*[F.col(c) for c in df.columns])).alias("value")).write.mode("overwrite").text(path)


def batch_requests(contexts: DataFrame, entity: str, model: str, instructions: str) -> DataFrame:
    """One request object per entity for a batch of a language model service: custom_id, request (JSON)."""
    payload = F.to_json(F.struct(*[F.col(c) for c in contexts.columns]))
    request = F.struct(
        F.col(entity).cast("string").alias("custom_id"), F.lit("POST").alias("method"),
        F.struct(F.lit(model).alias("model"), F.lit(instructions).alias("instructions"), payload.alias("input")).alias("body"),
    )
    return contexts.select(F.col(entity).cast("string").alias("custom_id"), F.to_json(request).alias("request"))


def write_graph(nodes: DataFrame, edges: DataFrame, folder: str) -> None:
    """Graph as node and edge tables."""
    write_parquet(nodes, f"{folder}/nodes")
    write_parquet(edges, f"{folder}/edges", partition_by=["kind"])


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str, most: int = 1_000_000) -> None:
    """Small graph as GraphML; larger ones are refused, as the file is written by one process."""
    if edges.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} edges; use write_graph")
    esc = lambda x: html.escape(str(x), quote=True)
    with Path(path).open("w") as f:
        f.write('<graphml><key id="type" for="node" attr.name="type" attr.type="string"/><key id="weight" for="edge" attr.name="weight" attr.type="long"/><graph edgedefault="directed">')
        for r in nodes.toLocalIterator():
            f.write(f'<node id="{esc(r["node"])}"><data key="type">{esc(r["node_type"])}</data></node>')
        for r in edges.toLocalIterator():
            f.write(f'<edge source="{esc(r["src"])}" target="{esc(r["dst"])}"><data key="weight">{r["weight"]}</data></edge>')
        f.write("</graph></graphml>")


def markdown(df: DataFrame, most: int = 200) -> str:
    """A small table as Markdown. Of a longer one the first rows, and a line that says so."""
    rows = df.limit(most + 1).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    if len(rows) > most:
        rows = rows[:most]
        shown = ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]
        return "\n".join([*lines, *shown, "", f"The first {most} rows; the table has more."])
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows])


def write_jdbc(df: DataFrame, url: str, name: str, properties: dict[str, str]) -> None:
    """Rows to a relational table, nested columns as JSON."""
    flat(df).write.mode("append").jdbc(url, name, properties=properties)
