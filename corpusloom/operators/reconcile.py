"""Reconciling and deduplicating entities by priority, and attaching text to them by exact, fuzzy, glob and prefix joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity, text
from .ordering import numbered

#: Priority of each source kind: the smaller wins.
PRIORITY = {"dlc": 1, "base": 2, "api": 3, "fmg": 4}
BASELINE_PRIORITY = 99


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the order. As an aggregate, so that rows are reduced before the shuffle."""
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def reconcile(entities: DataFrame, kind: str = "entity_type", name: str = "name", priority: str = "priority", ordinal: str = "ordinal", source: str = "source") -> DataFrame:
    """One row per (type, slug): the columns of the row of smallest priority (null as baseline, ties by ordinal), and
    ``sources``: the distinct sources, the winner's first. Different types never merge."""
    prio = F.coalesce(F.col(priority), F.lit(BASELINE_PRIORITY))
    keyed = entities.withColumn("slug", text.slug(name)).where(F.col("slug") != "")
    # distinct sources are few, so each is kept once with its best rank
    per_source = keyed.groupBy(kind, "slug", source).agg(F.min_by(F.struct(*[F.col(c) for c in entities.columns]), F.struct(prio, F.col(ordinal))).alias("row"), F.min(F.struct(prio.alias("p"), F.col(ordinal).alias("o"))).alias("rank"))
    merged = per_source.groupBy(kind, "slug").agg(F.min_by("row", "rank").alias("row"), F.array_sort(F.collect_list(F.struct("rank", F.col(source).alias("s")))).alias("ranked"))
    return merged.select(*[F.col(f"row.{c}").alias(c) for c in entities.columns], "slug", F.transform("ranked", lambda x: x["s"]).alias("sources"))


def canonical_merge(records: DataFrame, name: str = "name", source: str = "source", source_id: str = "source_id", priority: str = "source_priority", edition: str = "is_dlc") -> DataFrame:
    """Canonical table: one row per matched name (source_id where the name gives none), best priority first, with
    is_dlc if any row has it, provenance (JSON list by priority) and an id numbered by slug."""
    key = F.coalesce(F.nullif(text.match_name(name), F.lit("")), F.col(source_id).cast("string"))
    prio = F.coalesce(F.col(priority), F.lit(BASELINE_PRIORITY))
    rank = F.struct(prio.alias("p"), F.col(source).alias("s"), F.col(source_id).cast("string").alias("i"))
    rest = F.struct(*[F.col(c) for c in records.columns])
    merged = (
        records.withColumn("_key", key)
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min_by(rest, rank).alias("row"), F.bool_or(F.coalesce(edition, F.lit(False))).alias("any_dlc"), F.to_json(F.array_sort(F.collect_set(rank))).alias("provenance"))
    )
    kept = [c for c in records.columns if c != edition]
    out = merged.select(*[F.col(f"row.{c}").alias(c) for c in kept], F.col("any_dlc").alias(edition), "provenance", text.slug("row." + name).alias("canonical_slug"), "_key")
    return numbered(out, ["canonical_slug", "_key"], "id").drop("_key")


def preferred_text(records: DataFrame, key: str, column: str, source: str, order: list[str], ordinal: str = "ordinal") -> DataFrame:
    """Of each key the first text that isn't blank, by a fixed order of sources, then ordinal: key, column."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in order]), F.col(source)), F.lit(0))
    place = F.when(place == 0, len(order) + 1).otherwise(place)
    filled = records.where(F.trim(column) != "")
    return filled.groupBy(key).agg(F.min_by(column, F.struct(place, F.col(ordinal))).alias(column))


def name_bucket(records: DataFrame, record_id: str, name: str, description: str) -> DataFrame:
    """Records of one matched name collapsed: smallest id, all ids, first description that isn't blank by id."""
    keyed = records.withColumn("key", text.match_name(name)).where(F.col("key") != "")
    filled = F.when(F.trim(description) != "", F.struct(F.col(record_id).alias("i"), F.col(description).alias("d")))
    return keyed.groupBy("key").agg(F.min(record_id).alias(record_id), F.array_sort(F.collect_set(record_id)).alias("ids"), F.min(filled)["d"].alias(description))


def column_conflicts(records: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Number of keys whose filled values of a column differ: column_name, conflicts."""
    wide = records.groupBy(key).agg(*[(F.count_distinct(F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))) > 1).alias(c) for c in columns])
    counts = wide.agg(*[F.count_if(F.col(c)).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "conflicts")


def fuzzy_attach(snippets: DataFrame, entities: DataFrame, threshold: float, snippet_id: str, entity_id: str, name: str = "name", block: str | None = None) -> DataFrame:
    """Each snippet with the entity it belongs to: exact matched name first, else the best ratio of at least ``threshold``.

    Returns snippet_id, entity_id, score, ties to the smallest entity id; snippets without match are left out.
    Only snippets without exact match, and distinct names, enter the fuzzy join. Two names of ratio t share
    a run of letters: their alignment has at most (1 - t)(la + lb) breaks, so cutting a name into one piece more
    than that leaves a piece intact. Names are joined on pieces, never all with all, and the ratio decides.
    """
    blocks = [block] if block else []
    s = snippets.select(F.col(snippet_id).alias("s"), text.match_name(name).alias("sn"), *blocks).where("sn != ''")
    e = entities.select(F.col(entity_id).alias("e"), text.match_name(name).alias("en"), *blocks).where("en != ''")
    by_name = e.groupBy("en", *blocks).agg(F.min("e").alias("e"))
    exact = s.join(by_name, [s["sn"] == by_name["en"], *[s[b] == by_name[b] for b in blocks]]).select("s", "e", F.lit(1.0).alias("score"))
    left = s.join(exact, "s", "left_anti")
    names = left.select("sn", *blocks).distinct()
    pairs = similar_names(names.select(F.col("sn").alias("a"), *blocks), by_name.select(F.col("en").alias("b"), *blocks), threshold, blocks)
    found = pairs.join(by_name.withColumnRenamed("en", "b"), ["b", *blocks])
    best = found.groupBy("a", *blocks).agg(F.min(F.struct((-F.col("score")).alias("x"), "e")).alias("m"))
    fuzzy = left.join(best.withColumnRenamed("a", "sn"), ["sn", *blocks]).select("s", F.col("m.e").alias("e"), (-F.col("m.x")).alias("score"))
    return exact.unionByName(fuzzy).select(F.col("s").alias(snippet_id), F.col("e").alias(entity_id), F.round("score", 6).alias("score"))


def similar_names(a: DataFrame, b: DataFrame, threshold: float, blocks: list[str] | None = None) -> DataFrame:
    """Pairs of distinct names (a, b) whose ratio is at least ``threshold``: a, b, blocks, score.

    At ratio t, names of lengths la and lb differ by at most k = (1 - t)(la + lb) letters put in or taken out. Of the k + 1
    equal pieces of the one, at least one stands whole in the other, at most k places off; names are joined on that.
    Where a name is so short that a piece is a single letter, the pieces are letters, and the join is still exact.
    """
    blocks = blocks or []
    most = lambda n: F.floor(F.col(n) * (2.0 * (1 - threshold) / threshold) + 1e-9).cast("int")  # noqa: E731  for la + lb <= 2 la / t
    al = a.where("a != ''").withColumn("n", F.length("a")).withColumn("k", most("n"))
    count = F.least(F.col("k") + 1, F.col("n"))
    pieces = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(
            F.floor(i * F.col("n") / count).cast("int").alias("at"),
            F.substring(F.col("a"), F.floor(i * F.col("n") / count).cast("int") + 1, (F.floor((i + 1) * F.col("n") / count) - F.floor(i * F.col("n") / count)).cast("int")).alias("piece"),
        ),
    )
    ap = al.select("a", "n", "k", *blocks, F.inline(pieces))
    sizes = ap.select(F.length("piece").alias("size")).distinct()
    starts = F.transform(F.sequence(F.lit(1), F.length("b") - F.col("size") + 1), lambda p: F.struct((p - 1).alias("pos"), F.substring(F.col("b"), p, F.col("size")).alias("piece")))
    bp = b.where("b != ''").crossJoin(F.broadcast(sizes)).where(F.length("b") >= F.col("size")).select("b", *blocks, F.inline(starts))
    near = ap.join(bp, ["piece", *blocks]).where((F.abs(F.col("at") - F.col("pos")) <= F.col("k")) & similarity.ratio_possible("a", "b", threshold))
    # few bytes but much work a pair: by number, so that adaptive planning leaves them spread
    distinct = near.select("a", "b", *blocks).distinct().repartition(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return distinct.withColumn("score", similarity.batch_ratio("a", "b")).where(F.col("score") >= threshold)


#: Letters of a pattern that ids are joined on.
BEGINNING = 8


def glob_regex(pattern: Column | str) -> Column:
    """Regular expression of a glob with * and ?."""
    p = F.col(pattern) if isinstance(pattern, str) else pattern
    return F.concat(F.lit("(?s)^"), F.replace(F.replace(F.regexp_replace(p, r"([^\p{L}\p{N}_*?])", r"\\$1"), F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def glob_alias(ids: DataFrame, patterns: DataFrame, raw: str, pattern: str = "pattern", canonical: str = "canonical_id", most_patterns: int | None = None) -> DataFrame:
    """Each raw id with its canonical id: of the patterns that match, the one with fewest wildcards, then the longest, then
    the smallest; without one the id itself. Patterns that give the id itself count as none.

    Distinct ids meet only the patterns that begin like them: both are joined on the first letters before a pattern's first wildcard, up to
    ``BEGINNING`` of them. Patterns that begin with a wildcard meet every id. ``most_patterns`` refuses larger tables, if given.
    """
    if most_patterns is not None and patterns.limit(most_patterns + 1).count() > most_patterns:
        raise ValueError(f"more than {most_patterns} patterns")
    begin = F.substring(F.regexp_extract(pattern, r"^[^*?\[]*", 0), F.lit(1), F.lit(BEGINNING))
    known = patterns.where(F.col(pattern).isNotNull()).select(
        F.col(pattern).alias("_p"), F.col(canonical).alias("_c"), glob_regex(pattern).alias("_r"), F.length(F.regexp_replace(pattern, r"[^*?\[]", "")).alias("_w"), begin.alias("_b")
    )
    lengths = [r["n"] for r in known.select(F.length("_b").alias("n")).distinct().collect()]  # BEGINNING + 1 at most
    begun = F.array_distinct(F.transform(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: F.substring(F.col(raw), F.lit(1), n)))
    distinct = ids.select(raw).where(F.col(raw).isNotNull()).distinct().select(raw, F.explode(begun).alias("_b"))
    hits = distinct.join(known, "_b").where(F.rlike(F.col(raw), F.col("_r")) & (F.col("_c") != F.col(raw)))
    best = hits.groupBy(raw).agg(F.min_by("_c", F.struct("_w", -F.length("_p"), "_p")).alias("_found"))
    return ids.join(best, raw, "left").withColumn(canonical, F.coalesce("_found", raw)).drop("_found")


def alias_lookup(df: DataFrame, aliases: DataFrame, raw: str, canonical: str = "canonical_id") -> DataFrame:
    """canonical id of an exact alias, the last given winning; the raw id where there is none."""
    known = aliases.select(F.col("raw_id").alias(raw), F.col("canonical_id").alias("_found")).groupBy(raw).agg(F.max("_found").alias("_found"))
    return df.join(known, raw, "left").withColumn(canonical, F.coalesce("_found", F.col(raw).cast("string"))).drop("_found")


def prefix_ancestor(ids: DataFrame, known: DataFrame, number: str, ancestor: str = "ancestor") -> DataFrame:
    """Each number with the longest known number that is a prefix of its digits (itself included); null without one."""
    digits = F.col(number).cast("string")
    steps = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(digits, F.lit(1), i).cast("long"))
    walked = ids.select(number).distinct().select(number, F.explode(steps).alias(ancestor))
    found = walked.join(known.select(F.col(ancestor)).distinct(), ancestor).groupBy(number).agg(F.max(ancestor).alias(ancestor))
    return ids.join(found, number, "left")
