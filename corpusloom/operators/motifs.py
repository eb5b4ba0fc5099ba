"""Motifs: keyword hits in texts, coverage, entity statistics, clusters of texts, and the entity-line-motif graph."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import checkpointed


@dataclass(frozen=True)
class Motif:
    """A motif of a taxonomy; examples are looked for in hits but not in coverage."""

    slug: str
    label: str
    category: str
    category_label: str
    keywords: tuple[str, ...]
    examples: tuple[str, ...] = ()


def flags(motifs: list[Motif], text: str, examples: bool = True, whole_words: bool = False) -> dict[str, Column]:
    """A true-or-false column for each motif."""
    return {m.slug: T.any_keyword(text, [*m.keywords, *(m.examples if examples else ())], whole_words) for m in motifs}


def hits(lines: DataFrame, motifs: list[Motif], text: str = "text", keep: list[str] | None = None, examples: bool = True) -> DataFrame:
    """Long form: a row per line and motif it holds: ``keep`` columns, motif_slug. One scan, no join."""
    keep = keep or [c for c in lines.columns if c != text]
    found = F.array_compact(F.array(*[F.when(f, s) for s, f in flags(motifs, text, examples).items()]))
    return lines.select(*keep, F.explode(found).alias("motif_slug"))


def coverage(lines: DataFrame, motifs: list[Motif], line_id: str, text: str = "text", first: int = 5) -> DataFrame:
    """Of each motif: match_count, coverage_pct of all lines (2 decimals) and the first matching ids. Texts are read once.

    The smallest ids are found by a bounded aggregate, never by collecting the matches.
    """
    found = checkpointed(hits(lines, motifs, text, [line_id], examples=False))
    meta = [F.struct(F.lit(m.slug).alias("motif_slug"), F.lit(m.label).alias("label"), F.lit(m.category).alias("category")) for m in motifs]
    every = lines.agg(F.count(F.lit(1)).alias("_n")).select("_n", F.inline(F.array(*meta)))
    matched = found.groupBy("motif_slug").agg(F.count(F.lit(1)).alias("match_count"))
    counts = every.join(matched, "motif_slug", "left").fillna(0, ["match_count"])
    w = Window.partitionBy("motif_slug").orderBy(line_id)
    firsts = found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= first)
    listed = firsts.groupBy("motif_slug").agg(F.array_sort(F.collect_list(line_id)).alias("sample_ids"))
    share = F.round(100.0 * F.col("match_count") / F.greatest(F.col("_n"), F.lit(1)), 2)
    return counts.join(listed, "motif_slug", "left").select("motif_slug", "label", "category", "match_count", share.alias("coverage_pct"), "sample_ids")


def entity_summary(lines: DataFrame, found: DataFrame, entity: str, line_id: str, category: str) -> DataFrame:
    """Per entity and category: lore_count (distinct lines), motif_mentions, unique_motifs (0 without any)."""
    own = lines.where(F.col(entity).isNotNull()).groupBy(entity, category).agg(F.count_distinct(line_id).alias("lore_count"))
    per = found.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.count(F.lit(1)).alias("motif_mentions"), F.count_distinct("motif_slug").alias("unique_motifs"))
    return own.join(per, entity, "left").fillna(0, ["motif_mentions", "unique_motifs"])


def entity_motif_stats(found: DataFrame, entity: str, line_id: str) -> DataFrame:
    """Per entity and motif: hit_count, unique_lore."""
    return found.where(F.col(entity).isNotNull()).groupBy(entity, "motif_slug").agg(F.count(F.lit(1)).alias("hit_count"), F.count_distinct(line_id).alias("unique_lore"))


def with_motif(df: DataFrame, motifs: list[Motif]) -> DataFrame:
    """Rows with label, category and taxonomy order of their motif_slug; unknown ones as "unknown" and last."""
    spark = df.sparkSession
    known = spark.createDataFrame([(m.slug, m.label, m.category, i) for i, m in enumerate(motifs)], "motif_slug string, motif_label string, motif_category string, motif_order int")
    joined = df.join(F.broadcast(known), "motif_slug", "left")  # a taxonomy is a list in the program
    return joined.fillna({"motif_label": "unknown", "motif_category": "unknown", "motif_order": len(motifs)})


def top_motifs(stats: DataFrame, motifs: list[Motif], entity: str, k: int = 4) -> DataFrame:
    """The k most frequent motifs of each entity, ties by taxonomy order: entity, rank, motif_slug, hit_count, motif_label."""
    w = Window.partitionBy(entity).orderBy(F.desc("hit_count"), "motif_order", "motif_slug")
    ranked = with_motif(stats, motifs).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(entity, "rank", "motif_slug", "motif_label", "hit_count")


def quotes(lines: DataFrame, found: DataFrame, motifs: list[Motif], entity: str, line_id: str, text: str, k: int = 3) -> DataFrame:
    """The first k lines with a motif of each entity: entity, line id, text, motif labels (sorted, distinct)."""
    w = Window.partitionBy(entity).orderBy(line_id)
    labelled = with_motif(found, motifs).groupBy(entity, line_id).agg(F.array_sort(F.collect_set("motif_label")).alias("motif_labels"))
    first = labelled.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
    return first.join(lines.select(line_id, text), line_id)


def graph_edges(lines: DataFrame, found: DataFrame, entity: str, line_id: str) -> DataFrame:
    """Edges of the graph: kind (speaks entity-line, evokes line-motif, embodies entity-motif), src, dst, weight."""
    named = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))
    spoken = lines.where(F.col(entity).isNotNull())
    speaks = spoken.groupBy(named("entity", entity).alias("src"), named("lore", line_id).alias("dst")).agg(F.lit(1).cast("long").alias("weight")).select(F.lit("speaks").alias("kind"), "src", "dst", "weight")
    evokes = found.groupBy(named("lore", line_id).alias("src"), named("motif", "motif_slug").alias("dst")).agg(F.lit(1).cast("long").alias("weight")).select(F.lit("evokes").alias("kind"), "src", "dst", "weight")
    embodies = (
        found.where(F.col(entity).isNotNull())
        .groupBy(named("entity", entity).alias("src"), named("motif", "motif_slug").alias("dst"))
        .agg(F.count(F.lit(1)).alias("weight"))
        .select(F.lit("embodies").alias("kind"), "src", "dst", "weight")
    )
    return speaks.unionByName(evokes).unionByName(embodies)


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Nodes of the graph: node, node_type, degree."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree")).select("node", F.substring_index("node", ":", 1).alias("node_type"), "degree")


def entity_motifs(edges: DataFrame, least: int = 1) -> DataFrame:
    """Motifs of each entity with their weight, from ``least`` up: entity, motif, weight, rank."""
    strip = lambda c: F.regexp_replace(c, "^[a-z]+:", "")
    w = Window.partitionBy("entity").orderBy(F.desc("weight"), "motif")
    kept = edges.where((F.col("kind") == "embodies") & (F.col("weight") >= least)).select(strip("src").alias("entity"), strip("dst").alias("motif"), "weight")
    return kept.withColumn("rank", F.row_number().over(w))


def motif_report(edges: DataFrame, k: int = 5) -> DataFrame:
    """Of each motif the k entities that embody it most: motif, entity, weight, rank."""
    w = Window.partitionBy("motif").orderBy(F.desc("weight"), "entity")
    return entity_motifs(edges).drop("rank").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("motif", "entity", "weight", "rank")


def shared_motifs(found: DataFrame, line_id: str) -> DataFrame:
    """How often two motifs stand in one line: motif_a < motif_b, n. A line's motifs are paired in place."""
    per = found.groupBy(line_id).agg(F.array_sort(F.collect_set("motif_slug")).alias("m"))  # at most one per motif of the taxonomy
    pairs = F.flatten(F.transform("m", lambda a: F.transform(F.filter("m", lambda b: b > a), lambda b: F.struct(a.alias("motif_a"), b.alias("motif_b")))))
    return per.select(F.inline(pairs)).groupBy("motif_a", "motif_b").agg(F.count(F.lit(1)).alias("n"))


def cluster_density(members: DataFrame, found: DataFrame, cover: DataFrame | None, cluster: str, line_id: str) -> DataFrame:
    """Per cluster and motif that occurs: cluster_size, hits, density_pct, global_pct, delta_pct (2 decimals; null without cover)."""
    sizes = members.groupBy(cluster).agg(F.count(F.lit(1)).alias("cluster_size"))
    counted = found.join(members.select(line_id, cluster), line_id).groupBy(cluster, "motif_slug").agg(F.count(F.lit(1)).alias("hits"))
    dense = counted.join(sizes, cluster).withColumn("density_pct", F.round(100.0 * F.col("hits") / F.col("cluster_size"), 2))
    if cover is None:
        return dense.withColumn("global_pct", F.lit(None).cast("double")).withColumn("delta_pct", F.lit(None).cast("double"))
    joined = dense.join(cover.select("motif_slug", F.col("coverage_pct").alias("global_pct")), "motif_slug", "left")
    return joined.withColumn("delta_pct", F.round(F.col("density_pct") - F.col("global_pct"), 2))


def cluster_summary(members: DataFrame, cluster: str) -> DataFrame:
    """Clusters with size and whether they are noise (-1)."""
    return members.groupBy(cluster).agg(F.count(F.lit(1)).alias("size")).withColumn("is_noise", F.col(cluster) == -1)


def cluster_top_motifs(density: DataFrame, cluster: str, k: int = 5) -> DataFrame:
    w = Window.partitionBy(cluster).orderBy(F.desc("density_pct"), F.desc("hits"), "motif_slug")
    return density.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def exemplars(members: DataFrame, cluster: str, score: str, tie: str, k: int) -> DataFrame:
    """The k members of each cluster of highest score, ties by text."""
    w = Window.partitionBy(cluster).orderBy(F.desc(score), tie)
    return members.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def heuristic_summary(summary: DataFrame, tops: DataFrame, cited: DataFrame, entity: str, category: str, text: str) -> DataFrame:
    """A sentence on each entity with motifs: entity, summary_text, motif_slugs, n_quotes, first quote."""
    slugs = tops.groupBy(entity).agg(F.array_sort(F.collect_list(F.struct("rank", "motif_slug", "motif_label"))).alias("t"))
    spoken = cited.groupBy(entity).agg(F.count(F.lit(1)).alias("n_quotes"), F.min(text).alias("quote"))
    totals = summary.groupBy(entity).agg(F.sum("lore_count").alias("lore_count"), F.max("motif_mentions").alias("motif_mentions"), F.min(category).alias("category"))
    labels = T.listed(F.transform("t", lambda x: x["motif_label"]))
    sentence = F.concat(
        F.initcap(F.replace(F.coalesce("category", F.lit("entity")), F.lit("_"), F.lit(" "))), F.lit(" "), F.col(entity).cast("string"), F.lit(" evokes "), labels,
        F.lit(" across "), F.col("lore_count").cast("string"), F.when(F.col("lore_count") == 1, " line.").otherwise(" lines."),
    )
    joined = totals.join(slugs, entity).join(spoken, entity, "left").fillna(0, ["n_quotes"])
    return joined.select(entity, sentence.alias("summary_text"), F.transform("t", lambda x: x["motif_slug"]).alias("motif_slugs"), "n_quotes", "quote")


def resolve_quotes(answers: DataFrame, known: DataFrame, entity: str, claimed_id: str, claimed_text: str) -> DataFrame:
    """Claimed quotes with the line they are of: exact id, an id within the claim, equal text, then one text in the other.

    known: entity, quotes (array of struct<id:string,text:string>, a few per entity). Claims without line are left out.
    """
    norm = T.quote_text
    claim_text = norm(F.coalesce(F.col(claimed_text), F.lit("")))
    joined = answers.join(known, entity)
    by = lambda test: F.try_element_at(F.filter("quotes", test), F.lit(1))["id"]
    exact = by(lambda q: q["id"] == F.col(claimed_id))
    within = by(lambda q: F.contains(F.col(claimed_id), q["id"]))
    same = by(lambda q: (claim_text != "") & (norm(q["text"]) == claim_text))
    part = by(lambda q: (claim_text != "") & (F.contains(norm(q["text"]), claim_text) | F.contains(claim_text, norm(q["text"]))))
    return joined.withColumn("quote_id", F.coalesce(exact, within, same, part)).where(F.col("quote_id").isNotNull()).drop("quotes")
