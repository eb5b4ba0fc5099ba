"""Registered queries of the engine's own operators, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..functions import values as V
from ..operators import incremental, lore, motifs, ordering, profile, reconcile, retrieval
from ..session import checkpointed, table
from ..sources import records, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Motifs by words that occur in the test tables.
MOTIFS = [
    motifs.Motif("rot", "Rot", "decay", "Decay and Renewal", ("rot", "rusted")),
    motifs.Motif("rebirth", "Rebirth", "decay", "Decay and Renewal", ("rebirth", "dawn")),
    motifs.Motif("flame", "Flame", "element", "Elements", ("flame", "ember", "brazier")),
    motifs.Motif("frost", "Frost", "element", "Elements", ("frost", "winter"), ("glacier",)),
    motifs.Motif("grief", "Grief", "feeling", "Feelings", ("grief", "sorrow")),
    motifs.Motif("dream", "Dream", "feeling", "Feelings", ("dream", "slumber")),
    motifs.Motif("oath", "Oath", "bond", "Bonds", ("oath", "penance"), ("oathkeeper",)),
]

#: Vector asked for: 1, -1, 1, ... with thirds, so that no two scores tie by form.
QUERY = [(1.0 if i % 2 else -1.0) * (1 + i % 3) for i in range(64)]


def query(sql: str | None = None) -> Callable:
    """Registers a function as a query by its name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _has(column: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{w}')" for w in words) + ")"


def _hit_rows(key: str = "doc_id", extra: str = "", examples: bool = True) -> str:
    parts = [f"SELECT {key}{extra}, '{m.slug}' AS motif_slug FROM documents WHERE {_has('text', m.keywords + (m.examples if examples else ()))}" for m in MOTIFS]
    return " UNION ALL ".join(parts)


_META = "(VALUES " + ", ".join(f"('{m.slug}', '{m.label}', '{m.category}', {i})" for i, m in enumerate(MOTIFS)) + ") AS m(motif_slug, motif_label, motif_category, motif_order)"
_TRIM = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_MATCH = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))"


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _hits(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.hits(_docs(spark, folder), MOTIFS, "text", ["doc_id", "canonical_id"])


# ---- names, ids, hashes ----


@query(
    "SELECT canonical_id, regexp_replace(regexp_replace(regexp_replace(lower(name), '[^\\p{L}\\p{M}\\p{N}_\\s-]', '', 'g'), '[-\\s]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM canonical_entity"
)
def name_slugs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "canonical_entity").select("canonical_id", T.slug("name").alias("slug"))


@query(f"SELECT record_id, {_MATCH.format('name')} AS match_name FROM entity_record")
def match_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "entity_record").select("record_id", T.match_name("name").alias("match_name"))


_LORE = "regexp_replace(regexp_replace(replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \\t]+', ' ', 'g'), '\\n{2,}', chr(10), 'g')"


@query(f"SELECT doc_id, substr(sha256(coalesce(canonical_id, '') || '|' || coalesce(text_type, '') || '|' || {_TRIM.format(_LORE)}), 1, 16) AS lore_id FROM documents")
def lore_ids(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).select("doc_id", T.lore_id("canonical_id", "text_type", T.lore_text("text")).alias("lore_id"))


@query("SELECT chunk_id, sha256(concat_ws(':', coalesce(entity_type, ''), coalesce(game_entity_id, ''), coalesce(name, ''), coalesce(text, ''))) AS content_hash FROM corpus_chunk")
def chunk_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "corpus_chunk").select("chunk_id", T.chunk_hash("entity_type", "game_entity_id", "name", "text").alias("content_hash"))


@query("SELECT event_id, sha256('events|' || event_type || '|' || user_id) AS signature FROM events")
def event_signatures(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", T.signature("events", "event_type", "user_id").alias("signature"))


# ---- motifs ----


@query(
    "WITH n AS (SELECT count(*) AS n FROM documents), h AS ("
    + _hit_rows(examples=False)
    + "), f AS (SELECT motif_slug, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS sample_ids FROM (SELECT *, row_number() OVER (PARTITION BY motif_slug ORDER BY doc_id) AS r FROM h) WHERE r <= 5 GROUP BY 1), "
    "c AS (SELECT motif_slug, count(*) AS k FROM h GROUP BY 1) "
    f"SELECT m.motif_slug, m.motif_label AS label, m.motif_category AS category, coalesce(k, 0) AS match_count, round(100.0 * coalesce(k, 0) / greatest(n.n, 1), 2) AS coverage_pct, sample_ids FROM {_META} "
    "LEFT JOIN c USING (motif_slug) LEFT JOIN f USING (motif_slug) CROSS JOIN n"
)
def motif_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: how much of the corpus each motif covers."""
    return motifs.coverage(_docs(spark, folder), MOTIFS, "doc_id").withColumn("sample_ids", F.array_join(F.col("sample_ids").cast("array<string>"), ","))


@query(_hit_rows())
def motif_hits(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.hits(_docs(spark, folder), MOTIFS, "text", ["doc_id"])


@query(
    "WITH h AS (" + _hit_rows(extra=", canonical_id") + "), a AS (SELECT canonical_id, category, count(DISTINCT doc_id) AS lore_count FROM documents WHERE canonical_id IS NOT NULL GROUP BY 1, 2), "
    "b AS (SELECT canonical_id, count(*) AS motif_mentions, count(DISTINCT motif_slug) AS unique_motifs FROM h WHERE canonical_id IS NOT NULL GROUP BY 1) "
    "SELECT a.*, coalesce(motif_mentions, 0) AS motif_mentions, coalesce(unique_motifs, 0) AS unique_motifs FROM a LEFT JOIN b USING (canonical_id)"
)
def entity_summary(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.entity_summary(_docs(spark, folder), _hits(spark, folder), "canonical_id", "doc_id", "category")


@query(
    "WITH h AS (" + _hit_rows(extra=", canonical_id") + ") SELECT canonical_id, h.motif_slug, count(*) AS hit_count, count(DISTINCT doc_id) AS unique_lore, motif_label, motif_category, motif_order "
    f"FROM h JOIN {_META} ON m.motif_slug = h.motif_slug WHERE canonical_id IS NOT NULL GROUP BY ALL"
)
def entity_motif_stats(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.with_motif(motifs.entity_motif_stats(_hits(spark, folder), "canonical_id", "doc_id"), MOTIFS)


_EDGES = (
    "WITH h AS (" + _hit_rows(extra=", canonical_id") + ") SELECT 'speaks' AS kind, 'entity:' || canonical_id AS src, 'lore:' || doc_id AS dst, 1::BIGINT AS weight FROM documents WHERE canonical_id IS NOT NULL GROUP BY ALL "
    "UNION ALL SELECT 'evokes', 'lore:' || doc_id, 'motif:' || motif_slug, 1 FROM h GROUP BY ALL "
    "UNION ALL SELECT 'embodies', 'entity:' || canonical_id, 'motif:' || motif_slug, count(*) FROM h WHERE canonical_id IS NOT NULL GROUP BY ALL"
)


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.graph_edges(_docs(spark, folder), _hits(spark, folder), "canonical_id", "doc_id")


@query(_EDGES)
def graph_edges(spark: SparkSession, folder: str) -> DataFrame:
    return _edges(spark, folder)


@query(f"WITH e AS ({_EDGES}) SELECT node, split_part(node, ':', 1) AS node_type, count(*) AS degree FROM (SELECT src AS node FROM e UNION ALL SELECT dst FROM e) GROUP BY 1")
def graph_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.graph_nodes(_edges(spark, folder))


@query(
    f"WITH e AS ({_EDGES}), k AS (SELECT regexp_replace(src, '^[a-z]+:', '') AS entity, regexp_replace(dst, '^[a-z]+:', '') AS motif, weight FROM e WHERE kind = 'embodies') "
    "SELECT motif, entity, weight, row_number() OVER (PARTITION BY motif ORDER BY weight DESC, entity) AS rank FROM k QUALIFY rank <= 5"
)
def graph_motif_report(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.motif_report(_edges(spark, folder))


@query(
    f"WITH e AS ({_EDGES}) SELECT regexp_replace(src, '^[a-z]+:', '') AS entity, regexp_replace(dst, '^[a-z]+:', '') AS motif, weight, "
    "row_number() OVER (PARTITION BY src ORDER BY weight DESC, dst) AS rank FROM e WHERE kind = 'embodies' AND weight >= 2"
)
def graph_entity_motifs(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.entity_motifs(_edges(spark, folder), 2)


@query("WITH h AS (" + _hit_rows() + ") SELECT a.motif_slug AS motif_a, b.motif_slug AS motif_b, count(*) AS n FROM h a JOIN h b ON a.doc_id = b.doc_id AND a.motif_slug < b.motif_slug GROUP BY 1, 2")
def shared_motifs(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.shared_motifs(motifs.hits(_docs(spark, folder), MOTIFS, "text", ["doc_id"]), "doc_id")


_TOP = (
    "WITH h AS (" + _hit_rows(extra=", canonical_id") + "), s AS (SELECT canonical_id, motif_slug, count(*) AS hit_count FROM h WHERE canonical_id IS NOT NULL GROUP BY 1, 2) "
    f"SELECT canonical_id, row_number() OVER (PARTITION BY canonical_id ORDER BY hit_count DESC, motif_order, s.motif_slug) AS rank, s.motif_slug, motif_label, hit_count FROM s JOIN {_META} ON m.motif_slug = s.motif_slug QUALIFY rank <= 4"
)


@query(_TOP)
def top_motifs(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.top_motifs(motifs.entity_motif_stats(_hits(spark, folder), "canonical_id", "doc_id"), MOTIFS, "canonical_id")


_QUOTES = (
    "WITH h AS (" + _hit_rows(extra=", canonical_id") + f"), l AS (SELECT canonical_id, doc_id, string_agg(DISTINCT motif_label, ',' ORDER BY motif_label) AS motif_labels FROM h JOIN {_META} ON m.motif_slug = h.motif_slug WHERE canonical_id IS NOT NULL GROUP BY 1, 2 "
    "QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY doc_id) <= 3) SELECT l.*, text FROM l JOIN documents d ON d.doc_id = l.doc_id"
)


def _quotes(spark: SparkSession, folder: str, found: DataFrame | None = None) -> DataFrame:
    own = (_hits(spark, folder) if found is None else found).where("canonical_id IS NOT NULL")
    return motifs.quotes(_docs(spark, folder), own, MOTIFS, "canonical_id", "doc_id", "text")


@query(_QUOTES)
def motif_quotes(spark: SparkSession, folder: str) -> DataFrame:
    return _quotes(spark, folder).withColumn("motif_labels", F.array_join("motif_labels", ","))


@query(
    f"WITH t AS ({_TOP}), q AS ({_QUOTES}), s AS (SELECT canonical_id, count(DISTINCT (category, doc_id)) AS lore_count, min(category) AS category FROM documents WHERE canonical_id IS NOT NULL GROUP BY 1), "
    "g AS (SELECT canonical_id, list(motif_label ORDER BY rank) AS l, string_agg(motif_slug, ',' ORDER BY rank) AS motif_slugs FROM t GROUP BY 1), c AS (SELECT canonical_id, count(*) AS n_quotes, min(text) AS quote FROM q GROUP BY 1) "
    "SELECT canonical_id, upper(substr(coalesce(category, 'entity'), 1, 1)) || substr(coalesce(category, 'entity'), 2) || ' ' || canonical_id || ' evokes ' || "
    "CASE WHEN len(l) = 1 THEN l[1] ELSE array_to_string(l[1:len(l) - 1], ', ') || ' and ' || l[len(l)] END || ' across ' || lore_count || CASE WHEN lore_count = 1 THEN ' line.' ELSE ' lines.' END AS summary_text, "
    "motif_slugs, coalesce(n_quotes, 0) AS n_quotes, quote FROM s JOIN g USING (canonical_id) LEFT JOIN c USING (canonical_id)"
)
def heuristic_summaries(spark: SparkSession, folder: str) -> DataFrame:
    found = checkpointed(_hits(spark, folder))
    summary = motifs.entity_summary(_docs(spark, folder), found, "canonical_id", "doc_id", "category")
    tops = motifs.top_motifs(motifs.entity_motif_stats(found, "canonical_id", "doc_id"), MOTIFS, "canonical_id")
    out = motifs.heuristic_summary(summary, tops, _quotes(spark, folder, found), "canonical_id", "category", "text")
    return out.withColumn("motif_slugs", F.array_join("motif_slugs", ","))


_MEMBERS = "(SELECT doc_id, text, label AS cluster_id FROM documents JOIN embeddings ON vec_id = doc_id)"


def _members(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster_id"))
    return _docs(spark, folder).select("doc_id", "text").join(labels, "doc_id")


_DENSITY = (
    "WITH n AS (SELECT count(*) AS n FROM documents), h AS (" + _hit_rows() + "), g AS (SELECT motif_slug, round(100.0 * count(*) / greatest(any_value(n.n), 1), 2) AS global_pct FROM (" + _hit_rows(examples=False) + ") CROSS JOIN n GROUP BY 1), "
    f"z AS (SELECT cluster_id, count(*) AS cluster_size FROM {_MEMBERS} GROUP BY 1), c AS (SELECT cluster_id, motif_slug, count(*) AS hits FROM h JOIN {_MEMBERS} x USING (doc_id) GROUP BY 1, 2) "
    "SELECT cluster_id, motif_slug, hits, cluster_size, round(100.0 * hits / cluster_size, 2) AS density_pct, global_pct, round(round(100.0 * hits / cluster_size, 2) - global_pct, 2) AS delta_pct FROM c JOIN z USING (cluster_id) LEFT JOIN g USING (motif_slug)"
)


def _density(spark: SparkSession, folder: str) -> DataFrame:
    docs = _docs(spark, folder)
    cover = motifs.coverage(docs, MOTIFS, "doc_id")
    return motifs.cluster_density(_members(spark, folder), motifs.hits(docs, MOTIFS, "text", ["doc_id"]), cover, "cluster_id", "doc_id")


@query(_DENSITY)
def cluster_density(spark: SparkSession, folder: str) -> DataFrame:
    return _density(spark, folder)


@query(f"SELECT cluster_id, motif_slug, hits, density_pct, row_number() OVER (PARTITION BY cluster_id ORDER BY density_pct DESC, hits DESC, motif_slug) AS rank FROM ({_DENSITY}) QUALIFY rank <= 5")
def cluster_top_motifs(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.cluster_top_motifs(_density(spark, folder), "cluster_id").select("cluster_id", "motif_slug", "hits", "density_pct", "rank")


@query("SELECT label AS cluster_id, count(*) AS size, label = -1 AS is_noise FROM embeddings GROUP BY 1")
def cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return motifs.cluster_summary(table(spark, folder, "embeddings").withColumnRenamed("label", "cluster_id"), "cluster_id")


@query(f"SELECT cluster_id, doc_id, length(text) AS probability, row_number() OVER (PARTITION BY cluster_id ORDER BY length(text) DESC NULLS LAST, text, doc_id) AS rank FROM {_MEMBERS} QUALIFY rank <= 3")
def cluster_exemplars(spark: SparkSession, folder: str) -> DataFrame:
    scored = _members(spark, folder).withColumn("probability", F.length("text").cast("long")).withColumn("tie", F.struct("text", "doc_id"))
    return motifs.exemplars(scored, "cluster_id", "probability", "tie", 3).select("cluster_id", "doc_id", "probability", "rank")


# ---- reconcile, dedupe, merge ----

_SLUG = "regexp_replace(regexp_replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s\\p{{Z}}-]', '', 'g'), '[-\\s\\p{{Z}}]+', '_', 'g'), '^_+|_+$', '', 'g')"


@query(
    f"WITH k AS (SELECT *, {_SLUG.format('name')} AS slug, coalesce(source_priority, 99) AS p FROM entity_record), r AS (SELECT *, row_number() OVER (PARTITION BY entity_type, slug ORDER BY p, record_id) AS n FROM k WHERE slug <> ''), "
    "s AS (SELECT entity_type, slug, source, min((p, record_id)) AS b FROM k WHERE slug <> '' GROUP BY 1, 2, 3), g AS (SELECT entity_type, slug, string_agg(source, ',' ORDER BY b) AS sources FROM s GROUP BY 1, 2) "
    "SELECT entity_type, slug, record_id, name, source, sources FROM r JOIN g USING (entity_type, slug) WHERE n = 1"
)
def priority_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "entity_record").select("entity_type", "name", "source", "record_id", "source_priority")
    out = reconcile.reconcile(rows, priority="source_priority", ordinal="record_id")
    return out.select("entity_type", "slug", "record_id", "name", "source", F.array_join("sources", ",").alias("sources"))


@query(
    f"WITH k AS (SELECT *, coalesce(nullif({_MATCH.format('name')}, ''), source_id) AS key FROM source_entity), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY source, source_id) AS n, bool_or(coalesce(is_dlc, false)) OVER (PARTITION BY key) AS dlc FROM k WHERE key IS NOT NULL), "
    f"f AS (SELECT key, name, source, source_id, dlc AS is_dlc, {_SLUG.format('name')} AS canonical_slug FROM r WHERE n = 1) "
    "SELECT row_number() OVER (ORDER BY canonical_slug, key) AS id, canonical_slug, name, source, source_id, is_dlc FROM f"
)
def canonical_merge(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "source_entity").select("name", "source", "source_id", "is_dlc", F.lit(None).cast("int").alias("source_priority"))
    return reconcile.canonical_merge(rows).select("id", "canonical_slug", "name", "source", "source_id", "is_dlc")


@query(
    "SELECT lower(trim(match_key)) AS match_key, arg_min(description, (CASE source WHEN 'carian_fmg' THEN 1 WHEN 'kaggle_dlc' THEN 2 WHEN 'kaggle_base' THEN 3 WHEN 'github_api' THEN 4 ELSE 5 END, record_id)) AS description "
    "FROM entity_record WHERE trim(description) <> '' GROUP BY 1"
)
def description_override(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "entity_record").withColumn("match_key", F.lower(F.trim("match_key")))
    return reconcile.preferred_text(rows, "match_key", "description", "source", ["carian_fmg", "kaggle_dlc", "kaggle_base", "github_api"], "record_id")


@query(
    f"SELECT {_MATCH.format('name')} AS key, min(record_id) AS record_id, string_agg(DISTINCT record_id::VARCHAR, ',' ORDER BY record_id::VARCHAR) AS ids, "
    "arg_min(description, record_id) FILTER (trim(description) <> '') AS description FROM entity_record WHERE key <> '' GROUP BY 1"
)
def name_buckets(spark: SparkSession, folder: str) -> DataFrame:
    out = reconcile.name_bucket(table(spark, folder, "entity_record"), "record_id", "name", "description")
    return out.withColumn("ids", F.array_join(F.array_sort(F.col("ids").cast("array<string>")), ","))


_CONFLICT = ["entity_type", "effect", "obtained_from", "source"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (n > 1) AS conflicts FROM (SELECT match_key, count(DISTINCT nullif(trim({c}), '')) AS n FROM entity_record GROUP BY 1)" for c in _CONFLICT))
def column_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.column_conflicts(table(spark, folder, "entity_record"), "match_key", _CONFLICT)


@query("SELECT source, count(*) AS n_rows, count(DISTINCT match_key) AS n_groups, count(*) - count(DISTINCT match_key) AS n_merged FROM entity_record GROUP BY 1")
def rows_by_source(spark: SparkSession, folder: str) -> DataFrame:
    g = table(spark, folder, "entity_record").groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("match_key").alias("n_groups"))
    return g.withColumn("n_merged", F.col("n_rows") - F.col("n_groups"))


@query()
def fuzzy_names(spark: SparkSession, folder: str) -> DataFrame:
    """Typed names attached to canonical entities: exact, else best ratio of at least 0.82. Checked against brute force in tests."""
    typed = table(spark, folder, "entity_aliases").select("alias_id", F.col("raw_id").alias("name"))
    return reconcile.fuzzy_attach(typed, table(spark, folder, "canonical_entity"), 0.82, "alias_id", "canonical_id")


@query()
def fuzzy_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of part names of ratio 0.86 or more. Checked against brute force in tests."""
    names = table(spark, folder, "part").select(T.match_name("p_name").alias("a")).distinct()
    return reconcile.similar_names(names, names.withColumnRenamed("a", "b"), 0.86).where("a < b").select("a", "b", F.round("score", 6).alias("score"))


_GLOB = "'^' || replace(replace(regexp_replace(p.raw_id, '([^A-Za-z0-9_*?])', '\\\\\\1', 'g'), '*', '.*'), '?', '.') || '$'"


@query(
    f"WITH d AS (SELECT DISTINCT raw_id FROM entity_aliases WHERE raw_id IS NOT NULL), h AS (SELECT d.raw_id, arg_min(p.canonical_id, (length(regexp_replace(p.raw_id, '[^*?]', '', 'g')), -length(p.raw_id), p.raw_id)) AS c FROM d JOIN alias_pattern p ON regexp_full_match(d.raw_id, {_GLOB}) WHERE p.canonical_id <> d.raw_id GROUP BY 1) "
    "SELECT alias_id, coalesce(c, raw_id) AS canonical_id FROM entity_aliases LEFT JOIN h USING (raw_id)"
)
def glob_aliases(spark: SparkSession, folder: str) -> DataFrame:
    ids = table(spark, folder, "entity_aliases").select("alias_id", "raw_id")
    return reconcile.glob_alias(ids, table(spark, folder, "alias_pattern"), "raw_id", "raw_id").select("alias_id", "canonical_id")


@query(
    "WITH k AS (SELECT s_suppkey AS ancestor FROM supplier), n AS (SELECT o_orderkey, unnest(range(1, length(o_orderkey::VARCHAR) + 1)) AS i FROM orders), "
    "f AS (SELECT o_orderkey, max(ancestor) AS ancestor FROM n JOIN k ON ancestor = substr(o_orderkey::VARCHAR, 1, i)::BIGINT GROUP BY 1) SELECT o_orderkey, ancestor FROM orders LEFT JOIN f USING (o_orderkey)"
)
def prefix_ancestors(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("ancestor"))
    return reconcile.prefix_ancestor(table(spark, folder, "orders").select("o_orderkey"), known, "o_orderkey")


@query(
    "WITH k AS (SELECT raw_id, max(canonical_id) AS c FROM entity_aliases WHERE canonical_id IS NOT NULL GROUP BY 1) SELECT alias_id, coalesce(c, raw_id) AS canonical_id FROM entity_aliases LEFT JOIN k USING (raw_id)"
)
def alias_lookup(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "entity_aliases")
    return reconcile.alias_lookup(rows.select("alias_id", "raw_id"), rows.where("canonical_id IS NOT NULL").select("raw_id", "canonical_id"), "raw_id").select("alias_id", "canonical_id")


@query("SELECT chunk_id, game_entity_id FROM corpus_chunk WHERE game_entity_id IN (SELECT canonical_id FROM canonical_entity WHERE category <> 'npc')")
def cascade_delete(spark: SparkSession, folder: str) -> DataFrame:
    kept = table(spark, folder, "canonical_entity").where("category <> 'npc'").select(F.col("canonical_id").alias("game_entity_id"))
    return incremental.orphans_removed(table(spark, folder, "corpus_chunk").select("chunk_id", "game_entity_id"), kept, "game_entity_id")


# ---- incremental ----


@query("SELECT event_id, user_id, event_type FROM events WHERE (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM events WHERE ts < TIMESTAMP '2024-01-05')")
def incremental_skip(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    manifest = incremental.manifest_of(events.where("ts < TIMESTAMP '2024-01-05'"), ["user_id", "event_type"], F.current_timestamp())
    return incremental.unseen(events.select("event_id", "user_id", "event_type"), manifest, ["user_id", "event_type"])


@query(
    "WITH m AS (SELECT user_id, event_type, max(ts) AS recorded_at FROM events GROUP BY 1, 2) SELECT event_id, user_id, event_type FROM events WHERE (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM m WHERE recorded_at < TIMESTAMP '2024-01-28')"
)
def incremental_since(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    manifest = events.groupBy("user_id", "event_type").agg(F.max("ts").alias("recorded_at"))
    return incremental.unseen(events.select("event_id", "user_id", "event_type"), manifest, ["user_id", "event_type"], F.expr("TIMESTAMP '2024-01-28'"))


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN 'changed' ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 7 = 0")
def baseline_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which a tenth is changed against a baseline that lacks a seventh."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    baseline = orders.where("o_orderkey % 7 <> 0")
    current = orders.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 10 == 0, "changed").otherwise(F.col("o_orderpriority")))
    return incremental.changed(current, baseline, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND event_type <> 'error'")
def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Last event of each user; an error counts as deletion."""
    events = table(spark, folder, "events")
    return incremental.latest(events, ["user_id"], "ts", "event_id", F.col("event_type") == "error").select("user_id", "event_id", "event_type", "value")


_BUNDLES = (
    "b AS (SELECT user_id AS annotation_id, arg_max(event_type, (ts, event_id)) AS checksum, max(ts) AS updated_at, CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN 'delete' ELSE 'upsert' END AS operation FROM events GROUP BY 1), "
    "m AS (SELECT user_id AS annotation_id, max(ts) AS updated_at, arg_max(event_type, (ts, event_id)) AS checksum FROM events WHERE user_id % 3 <> 0 AND (user_id % 5 = 0 OR ts < TIMESTAMP '2024-01-20') GROUP BY 1)"
)


@query(
    f"WITH {_BUNDLES} SELECT annotation_id, operation, CASE WHEN operation = 'delete' AND m.annotation_id IS NULL THEN 'skipped' WHEN m.annotation_id IS NOT NULL AND b.checksum = m.checksum AND operation <> 'delete' THEN 'skipped' "
    "WHEN m.annotation_id IS NOT NULL AND b.updated_at <= m.updated_at THEN 'conflict' WHEN operation = 'delete' THEN 'deleted' WHEN m.annotation_id IS NOT NULL THEN 'updated' ELSE 'created' END AS outcome FROM b LEFT JOIN m USING (annotation_id)"
)
def bundle_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Users as annotations: their last event against a manifest of earlier ones."""
    events = table(spark, folder, "events")
    last = F.max_by("event_type", F.struct("ts", "event_id")).alias("checksum")
    bundles = events.groupBy(F.col("user_id").alias("annotation_id")).agg(last, F.max("ts").alias("updated_at"))
    bundles = bundles.withColumn("operation", F.when(F.col("checksum") == "error", "delete").otherwise("upsert"))
    old = events.where("user_id % 3 <> 0 AND (user_id % 5 = 0 OR ts < TIMESTAMP '2024-01-20')")
    manifest = old.groupBy(F.col("user_id").alias("annotation_id")).agg(F.max("ts").alias("updated_at"), last)
    return incremental.classify_bundles(bundles, manifest).select("annotation_id", "operation", "outcome")


@query("SELECT o_custkey AS annotation_id, o_orderkey AS version FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus = 'O') DESC, o_orderkey DESC) = 1")
def current_revisions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(F.col("o_custkey").alias("annotation_id"), F.col("o_orderkey").alias("version"), (F.col("o_orderstatus") == "O").alias("is_current"))
    return incremental.current_revision(rows).select("annotation_id", "version")


@query(
    "WITH r AS (SELECT user_id AS annotation_id, row_number() OVER (PARTITION BY user_id ORDER BY day) AS version, tags FROM (SELECT user_id, date_trunc('day', ts) AS day, list_sort(list_distinct(list(event_type))) AS tags FROM events GROUP BY 1, 2)) "
    "SELECT annotation_id, version, array_to_string(list_sort(list_filter(tags, lambda x: NOT list_contains(coalesce(old, []), x))), ',') AS added, array_to_string(list_sort(list_filter(coalesce(old, []), lambda x: NOT list_contains(tags, x))), ',') AS removed "
    "FROM (SELECT *, lag(tags) OVER (PARTITION BY annotation_id ORDER BY version) AS old FROM r)"
)
def revision_tags(spark: SparkSession, folder: str) -> DataFrame:
    """The kinds of events of each user's days as tags of revisions."""
    days = table(spark, folder, "events").groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(F.array_sort(F.collect_set("event_type")).alias("tags"))
    revisions = days.select(F.col("user_id").alias("annotation_id"), F.row_number().over(Window.partitionBy("user_id").orderBy("day")).alias("version"), "tags")
    out = incremental.tag_changes(revisions)
    return out.select("annotation_id", "version", F.array_join("added", ",").alias("added"), F.array_join("removed", ",").alias("removed"))


# ---- quality ----

_PROFILED = ["weight", "source_priority", "name", "effect", "obtained_from"]


def _profile_sql(c: str, numeric: bool) -> str:
    x = f"{c}::DOUBLE" if numeric else "NULL::DOUBLE"
    return (
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, round(100.0 * (count(*) - count({c})) / count(*), 4) AS null_percent, count(DISTINCT {c}) AS n_unique, round(min({x}), 4) AS min_value, round(max({x}), 4) AS max_value, "
        f"round(avg({x}), 4) AS mean_value, round(stddev_samp({x}), 4) AS std_value FROM (SELECT * REPLACE (CASE WHEN isnan(weight) THEN NULL ELSE weight END AS weight) FROM entity_record)"
    )


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "entity_record").withColumn("weight", F.nanvl("weight", F.lit(None).cast("double")))


@query(" UNION ALL ".join(_profile_sql(c, c in ("weight", "source_priority")) for c in _PROFILED))
def quality_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.profile(_clean(spark, folder), _PROFILED)


@query("SELECT column_name, value, n, rank FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}::VARCHAR) AS rank FROM documents WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("lang", "source", "category", "text_type")) + ") WHERE rank <= 5")
def top_values(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(_docs(spark, folder), ["lang", "source", "category", "text_type"])


def _checks() -> list[profile.Check]:
    return [
        profile.not_null("name"), profile.non_empty("name"), profile.at_least("weight", 0.01), profile.one_of("entity_type", ["weapon", "armor", "item", "boss", "spell"]),
        profile.between("source_priority", 1, 3), profile.matches("match_key", "^[a-z0-9_-]+$"), profile.not_null("updated_at"),
    ]


_CHECK_SQL = [
    ("not_null", "name", "name IS NULL"), ("non_empty", "name", "length(name) = 0"), ("at_least", "weight", "weight < 0.01"),
    ("one_of", "entity_type", "entity_type NOT IN ('weapon', 'armor', 'item', 'boss', 'spell')"), ("between", "source_priority", "source_priority NOT BETWEEN 1 AND 3"),
    ("matches", "match_key", "NOT regexp_matches(match_key, '^[a-z0-9_-]+$')"), ("not_null", "updated_at", "updated_at IS NULL"),
]


@query(
    " UNION ALL ".join(f"SELECT '{r}' AS rule, '{c}' AS column_name, count(*) FILTER ({bad}) AS violations FROM entity_record" for r, c, bad in _CHECK_SQL)
    + " UNION ALL SELECT 'unique', 'match_key', count(match_key) - count(DISTINCT match_key) FROM entity_record"
)
def schema_violations(spark: SparkSession, folder: str) -> DataFrame:
    return profile.violations(table(spark, folder, "entity_record"), _checks(), ["match_key"])


@query("SELECT * FROM (SELECT record_id, concat_ws(',', " + ", ".join(f"CASE WHEN {bad} THEN '{r}:{c}' END" for r, c, bad in _CHECK_SQL) + ") AS broken FROM entity_record) WHERE broken <> ''")
def failing_rows(spark: SparkSession, folder: str) -> DataFrame:
    return profile.failing_rows(table(spark, folder, "entity_record"), _checks(), "record_id").withColumn("broken", F.array_join("broken", ","))


@query(
    "WITH x AS (SELECT record_id, CASE WHEN isnan(weight) THEN NULL ELSE weight END AS weight, source_priority, effect FROM entity_record), s AS (SELECT avg(weight) AS a, median(source_priority) AS b, "
    "(SELECT effect FROM x WHERE effect IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, effect LIMIT 1) AS c FROM x) SELECT record_id, round(coalesce(weight, a), 6) AS weight, coalesce(source_priority, b)::DOUBLE AS source_priority, coalesce(effect, c) AS effect FROM x CROSS JOIN s"
)
def filled_values(spark: SparkSession, folder: str) -> DataFrame:
    rows = _clean(spark, folder).select("record_id", "weight", F.col("source_priority").cast("double").alias("source_priority"), "effect")
    return profile.filled(rows, {"weight": "mean", "source_priority": "median", "effect": "mode"}).withColumn("weight", F.round("weight", 6))


@query("SELECT source, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM documents), 2) AS percent FROM documents GROUP BY 1")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return profile.shares(_docs(spark, folder), "source")


@query(
    "WITH h AS (" + _hit_rows(examples=False) + f"), c AS (SELECT m.motif_slug, count(h.doc_id) AS k FROM {_META} LEFT JOIN h ON h.motif_slug = m.motif_slug GROUP BY 1), n AS (SELECT count(*) AS n FROM documents) "
    "SELECT count(*) AS total, count(*) FILTER (k = 0) AS zero, count(*) FILTER (k < 5) AS few, round(avg(k), 4) AS average, round(avg(round(100.0 * k / greatest(n, 1), 2)), 4) AS average_pct FROM c CROSS JOIN n"
)
def coverage_stats(spark: SparkSession, folder: str) -> DataFrame:
    c = motifs.coverage(_docs(spark, folder), MOTIFS, "doc_id")
    return c.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("match_count") == 0).alias("zero"), F.count_if(F.col("match_count") < 5).alias("few"), F.round(F.avg("match_count"), 4).alias("average"), F.round(F.avg("coverage_pct"), 4).alias("average_pct"))


@query("SELECT canonical_id, count(*) AS n FROM documents WHERE canonical_id IS NOT NULL GROUP BY 1 HAVING count(*) < 10")
def sparse_entities(spark: SparkSession, folder: str) -> DataFrame:
    return _docs(spark, folder).where("canonical_id IS NOT NULL").groupBy("canonical_id").agg(F.count(F.lit(1)).alias("n")).where("n < 10")


@query("SELECT count(*) AS total, count(*) FILTER (is_dlc) AS dlc, count(*) FILTER (NOT coalesce(is_dlc, false)) AS base FROM source_entity")
def edition_counts(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "source_entity")
    return e.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_dlc").alias("dlc"), F.count_if(~F.coalesce("is_dlc", F.lit(False))).alias("base"))


@query("SELECT lower(entity_type) AS entity_type, source, count(*) AS n FROM source_entity GROUP BY 1, 2")
def type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "source_entity").groupBy(F.lower("entity_type").alias("entity_type"), "source").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT word, count(*) AS n FROM (SELECT unnest(string_split(name, ' ')) AS word FROM canonical_entity) GROUP BY 1")
def exploded_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "canonical_entity").select(F.explode(F.split("name", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT match_key, CASE WHEN count(DISTINCT entity_type) = 1 THEN max(entity_type) END AS entity_type, CASE WHEN count(DISTINCT source) = 1 THEN max(source) END AS source FROM entity_record WHERE match_key IS NOT NULL GROUP BY 1")
def constant_values(spark: SparkSession, folder: str) -> DataFrame:
    g = table(spark, folder, "entity_record").where("match_key IS NOT NULL").groupBy("match_key")
    return g.agg(profile.constant_or_null("entity_type").alias("entity_type"), profile.constant_or_null("source").alias("source"))


@query(
    "WITH k AS (SELECT entity_type, match_key, source, min(coalesce(source_priority, 99)) AS p FROM entity_record WHERE match_key IS NOT NULL GROUP BY 1, 2, 3) SELECT entity_type, match_key AS slug, string_agg(source, ',' ORDER BY source) AS sources, count(*) AS n_sources FROM k GROUP BY 1, 2"
)
def lineage_rows(spark: SparkSession, folder: str) -> DataFrame:
    g = table(spark, folder, "entity_record").where("match_key IS NOT NULL").groupBy("entity_type", F.col("match_key").alias("slug")).agg(F.collect_set("source").alias("sources"))
    return writers.lineage(g).withColumn("sources", F.array_join("sources", ","))


# ---- lore ----


@query(
    "SELECT match_key AS canonical_id, text_type, text FROM (SELECT match_key, 'description' AS text_type, description AS text FROM entity_record UNION ALL SELECT match_key, 'effect', effect FROM entity_record UNION ALL SELECT match_key, 'obtained_from', obtained_from FROM entity_record) "
    "WHERE match_key IS NOT NULL AND trim(text) <> ''".replace("SELECT match_key AS canonical_id, text_type, text FROM", f"SELECT DISTINCT match_key AS canonical_id, text_type, {_TRIM.format(_LORE)} AS text FROM")
)
def entity_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the entities' text columns, each once."""
    rows = table(spark, folder, "entity_record").where("match_key IS NOT NULL").withColumnRenamed("match_key", "canonical_id")
    parts = [lore.explode_texts(rows, "canonical_id", [c], []) for c in ("description", "effect", "obtained_from")]
    return lore.union_lines(*parts).select("canonical_id", "text_type", "text")


def _weight_case() -> str:
    return "CASE lower(trim(t)) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in lore.WEIGHTS.items()) + " ELSE 1.0 END"


@query(
    f"WITH l AS (SELECT canonical_id AS c, coalesce(text_type, '') AS t, {_TRIM.format('text')} AS x, doc_id AS o FROM documents WHERE canonical_id IS NOT NULL), "
    "b AS (SELECT c, t, string_agg(x, chr(10) || chr(10) ORDER BY o) AS block, min(o) AS seen FROM l WHERE x <> '' GROUP BY 1, 2), "
    f"w AS (SELECT *, ({_weight_case()})::DOUBLE AS w, regexp_split_to_array(block, '\\s+') AS words FROM b), "
    "v AS (SELECT *, greatest(1, floor(len(words) * (CASE WHEN w >= 1 THEN w - 1 ELSE w END))::BIGINT) AS k FROM w), "
    "s AS (SELECT *, CASE WHEN w >= 1 AND w - 1 > 0 THEN block || chr(10) || chr(10) || array_to_string(words[1:k], ' ') WHEN w >= 1 THEN block ELSE array_to_string(words[1:k], ' ') END AS scaled, "
    "array_to_string(list_transform(string_split(replace(t, '_', ' '), ' '), lambda p: upper(p[1]) || lower(p[2:])), ' ') AS label FROM v) "
    "SELECT c AS canonical_id, md5(string_agg(label || ':' || chr(10) || block, chr(10) || chr(10) ORDER BY w DESC, length(scaled) DESC, seen)) AS text_md5, "
    "md5(string_agg(label || ':' || chr(10) || scaled, chr(10) || chr(10) ORDER BY w DESC, length(scaled) DESC, seen)) AS embedding_md5, "
    "string_agg(t, '|' ORDER BY w DESC, length(scaled) DESC, seen) AS text_type_components, count(*) AS component_count FROM s GROUP BY 1"
)
def weighted_texts(spark: SparkSession, folder: str) -> DataFrame:
    out = lore.weighted_texts(_docs(spark, folder), "canonical_id", "text_type", "text", "doc_id")
    return out.select("canonical_id", F.md5("text").alias("text_md5"), F.md5("embedding_text").alias("embedding_md5"), "text_type_components", F.col("component_count").cast("long").alias("component_count"))


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS n_lines, count(DISTINCT canonical_id) AS n_entities FROM documents GROUP BY {c}" for c in ("source", "category", "text_type", "lang")))
def lore_stats(spark: SparkSession, folder: str) -> DataFrame:
    return lore.lore_stats(_docs(spark, folder), ["source", "category", "text_type", "lang"], "canonical_id")


@query("SELECT canonical_id, count(DISTINCT source) AS n_sources FROM documents WHERE canonical_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source) > 1")
def multi_source(spark: SparkSession, folder: str) -> DataFrame:
    return lore.multi_source(_docs(spark, folder), "canonical_id", "source")


@query(
    "WITH o AS (SELECT * FROM documents WHERE starts_with(canonical_id, 'npc:')), h AS (" + _hit_rows(extra=", canonical_id") + "), t AS (SELECT canonical_id, text_type, count(*) AS n FROM o GROUP BY 1, 2), "
    "j AS (SELECT canonical_id, '{' || string_agg('\"' || text_type || '\":' || n, ',' ORDER BY text_type) || '}' AS text_types FROM t GROUP BY 1), c AS (SELECT canonical_id, count(DISTINCT doc_id) AS lore_count FROM o GROUP BY 1), "
    "m AS (SELECT canonical_id, string_agg(DISTINCT motif_slug, ',' ORDER BY motif_slug) AS motifs, count(DISTINCT motif_slug) AS k FROM h GROUP BY 1) "
    "SELECT canonical_id, lore_count, text_types, coalesce(motifs, '') AS motifs, coalesce(k, 0) AS motif_count FROM c LEFT JOIN j USING (canonical_id) LEFT JOIN m USING (canonical_id)"
)
def speaker_audit(spark: SparkSession, folder: str) -> DataFrame:
    out = lore.speaker_audit(_docs(spark, folder), _hits(spark, folder), "npc:", "canonical_id", "doc_id", "text_type")
    return out.withColumn("motifs", F.array_join("motifs", ",")).withColumn("motif_count", F.col("motif_count").cast("long"))


@query("WITH f AS (SELECT canonical_id, trim(source) AS v, min(doc_id) AS o FROM documents WHERE trim(source) <> '' GROUP BY 1, 2) SELECT canonical_id, string_agg(v, '|' ORDER BY o, v) AS source FROM f GROUP BY 1")
def joined_sources(spark: SparkSession, folder: str) -> DataFrame:
    return lore.joined_unique(_docs(spark, folder), "canonical_id", "source", "doc_id")


@query(
    "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events"
)
def forward_fill(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").withColumn("last_purchase", F.when(F.col("event_type") == "purchase", F.col("value")))
    return lore.forward_filled(rows, "last_purchase", ["user_id"], "event_id").select("event_id", "last_purchase")


# ---- retrieval ----

_Q = "[" + ", ".join(str(x) for x in QUERY) + "]::DOUBLE[]"


@query(f"SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], {_Q}), 6) AS score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM embeddings QUALIFY rank <= 10")
def vector_topk_cosine(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.top_k(table(spark, folder, "embeddings"), "embedding", QUERY, 10, "vec_id").select("vec_id", "label", "score", "rank")


@query(f"SELECT vec_id, round(list_distance(embedding::DOUBLE[], {_Q}), 6) AS score, row_number() OVER (ORDER BY score, vec_id) AS rank FROM embeddings QUALIFY rank <= 10")
def vector_topk_l2(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.top_k(table(spark, folder, "embeddings"), "embedding", QUERY, 10, "vec_id", metric="l2").select("vec_id", "score", "rank")


@query(
    f"SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], {_Q}), 6) AS score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM embeddings JOIN documents ON doc_id = vec_id "
    "WHERE category IN ('npc', 'boss') AND (source <> 'impalers' OR source IS NULL) QUALIFY rank <= 10"
)
def vector_topk_filtered(spark: SparkSession, folder: str) -> DataFrame:
    clauses = retrieval.parse_filters(["category=npc,boss", "source!=impalers"])
    rows = table(spark, folder, "embeddings").join(_docs(spark, folder).select(F.col("doc_id").alias("vec_id"), "category", "source"), "vec_id")
    return retrieval.top_k(rows, "embedding", QUERY, 10, "vec_id", clauses).select("vec_id", "score", "rank")


_RANKED = f"(SELECT vec_id, text, text_type, round(list_cosine_similarity(embedding::DOUBLE[], {_Q}), 6) AS score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM embeddings JOIN documents ON doc_id = vec_id QUALIFY rank <= 30)"


def _window(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").join(_docs(spark, folder).select(F.col("doc_id").alias("vec_id"), "text", "text_type"), "vec_id")
    return retrieval.top_k(rows, "embedding", QUERY, retrieval.candidate_window(10), "vec_id")


@query(
    f"WITH r AS (SELECT *, lower(text_type) AS k FROM {_RANKED}), t AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rank) AS turn, min(rank) OVER (PARTITION BY k) AS seen, "
    "CASE k WHEN 'description' THEN 1 WHEN 'lore' THEN 2 WHEN 'impalers_excerpt' THEN 3 WHEN 'dialogue' THEN 4 ELSE 5 END AS f FROM r) SELECT vec_id, text_type, rank, row_number() OVER (ORDER BY turn, f, seen) AS position FROM t QUALIFY position <= 10"
)
def balanced_interleave(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.interleave(_window(spark, folder), 10).select("vec_id", "text_type", "rank", "position")


@query(
    f"WITH n AS (SELECT vec_id, rank, lower({_TRIM.format(chr(39).join(['regexp_replace(translate(text, ', '‘’“”–—', ', ', chr(39) * 4 + '""--', '), ', '\\s+', ', ', ' ', ', ', 'g', ')']))}) AS t FROM {_RANKED}) "
    "SELECT vec_id, rank FROM n WHERE t <> '' AND t IS NOT NULL QUALIFY row_number() OVER (PARTITION BY t ORDER BY rank) = 1 UNION ALL SELECT vec_id, rank FROM n WHERE t = '' OR t IS NULL"
)
def text_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.text_dedupe(_window(spark, folder)).select("vec_id", "rank")


@query()
def semantic_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Greedy in rank order, so without SQL; tested against a plain loop."""
    return retrieval.semantic_dedupe(_window(spark, folder), "embedding", "vec_id", None, same=0.8).select("vec_id", "rank")


@query()
def retrieval_search(spark: SparkSession, folder: str) -> DataFrame:
    """The whole retrieval path."""
    rows = table(spark, folder, "embeddings").join(_docs(spark, folder).select(F.col("doc_id").alias("vec_id"), "text", "text_type", "category", "source"), "vec_id")
    return retrieval.search(rows, QUERY, 10, "vec_id", "embedding", ["category!=spell"]).select("vec_id", "text_type", "score", "position")


@query(
    "SELECT doc_id, (SELECT count(*) FROM (SELECT unnest(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+')) AS w) WHERE w IN ('pale', 'grief')) AS term_count FROM documents "
    "WHERE list_contains(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), 'pale') AND list_contains(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), 'grief')"
)
def term_search(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval.term_search(_docs(spark, folder), "pale grief").select("doc_id", F.col("term_count").cast("long").alias("term_count"))


@query("SELECT event_id, (props ->> '$.k')::BIGINT AS k FROM events WHERE (props ->> '$.k')::BIGINT >= 50")
def json_meta_filter(spark: SparkSession, folder: str) -> DataFrame:
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, folder, "events").select("event_id", k.alias("k")).where("k >= 50")


@query("SELECT chunk_id, meta ->> '$.region' AS region, TRY_CAST(meta ->> '$.weight' AS DOUBLE) AS weight FROM corpus_chunk WHERE meta ->> '$.region' IS NOT NULL")
def chunk_meta(spark: SparkSession, folder: str) -> DataFrame:
    region = F.get_json_object("meta", "$.region")
    return table(spark, folder, "corpus_chunk").select("chunk_id", region.alias("region"), V.safe_float(F.get_json_object("meta", "$.weight")).alias("weight")).where("region IS NOT NULL")


# ---- values ----


def _map_sql(values: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in values.items()) + "}"


@query(
    "WITH c AS (SELECT record_id, coalesce(payload ->> '$.category', payload ->> '$.Category', payload ->> '$.type') AS v FROM raw_record WHERE json_valid(payload)), n AS (SELECT record_id, v, trim(translate(lower(v), '-_/', '   ')) AS t, lower(trim(v)) AS a, trim(regexp_replace(translate(lower(v), '-_', '  '), '\\s+', ' ', 'g')) AS i FROM c) "
    f"SELECT record_id, coalesce(CASE WHEN t LIKE '%s' THEN {_map_sql(V.WEAPON_TYPES)}[t[:length(t) - 1]] END, {_map_sql(V.WEAPON_TYPES)}[t], {_map_sql(V.WEAPON_TYPES)}[regexp_replace(t, 's+$', '')], 'other') AS weapon_type, "
    "CASE " + " ".join(f"WHEN regexp_matches(a, '{'|'.join(p)}') THEN '{s}'" for s, p in V.ARMOR_SLOTS) + " ELSE 'other' END AS armor_type, "
    f"coalesce(CASE WHEN i <> '' THEN coalesce({_map_sql(V.ITEM_CATEGORIES)}[i], CASE " + " ".join(f"WHEN contains(i, '{k}') OR contains('{k}', i) THEN '{v}'" for k, v in V.ITEM_CATEGORIES.items()) + " END) END, 'other') AS item_category FROM n"
)
def category_types(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.try_parse_json("payload")
    v = F.coalesce(*[F.try_variant_get(doc, f"$.{k}", "string") for k in ("category", "Category", "type")])
    rows = table(spark, folder, "raw_record").where(doc.isNotNull()).select("record_id", v.alias("v"))
    return rows.select("record_id", V.weapon_type("v").alias("weapon_type"), V.armor_type("v").alias("armor_type"), V.item_category("v").alias("item_category"))


@query(
    "SELECT record_id, coalesce(nullif(trim(effect), ''), nullif(trim(obtained_from), ''), nullif(trim(name), '')) AS first_text, "
    "concat_ws(' / ', " + ", ".join(f"CASE WHEN lower(trim({c})) NOT IN ('', 'nan', 'none', 'null') THEN trim({c}) END" for c in ("name", "effect", "obtained_from")) + ") AS merged FROM entity_record"
)
def merged_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "entity_record").select("record_id", V.first_filled("effect", "obtained_from", "name").alias("first_text"), V.merged_text("name", "effect", "obtained_from", sep=" / ").alias("merged"))


@query("SELECT l_orderkey, l_linenumber, trunc(TRY_CAST(replace(trim(v), ',', '') AS DOUBLE))::BIGINT AS whole, TRY_CAST(replace(trim(v), ',', '') AS DOUBLE) AS number FROM (SELECT *, ' ' || l_extendedprice::DECIMAL(12,2)::VARCHAR AS v FROM lineitem)")
def safe_numbers(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat(F.lit(" "), F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", V.safe_int(text).alias("whole"), V.safe_float(text).alias("number"))


@query("SELECT vec_id, round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm, round(list_inner_product(embedding::DOUBLE[], " + _Q + "), 6) AS dot FROM embeddings")
def vector_norms(spark: SparkSession, folder: str) -> DataFrame:
    q = F.array(*[F.lit(x) for x in QUERY])
    return table(spark, folder, "embeddings").select("vec_id", F.round(S.norm("embedding"), 6).alias("norm"), F.round(S.dot("embedding", q), 6).alias("dot"))


@query("SELECT doc_id, source FROM documents ORDER BY canonical_id NULLS FIRST, text_type NULLS FIRST, source NULLS FIRST, doc_id LIMIT 50")
def lore_order(spark: SparkSession, folder: str) -> DataFrame:
    """The first lines in lore order (a top-k report)."""
    return _docs(spark, folder).orderBy("canonical_id", "text_type", "source", "doc_id").limit(50).select("doc_id", "source")


@query("SELECT record_id, entity_type, source, (name IS NOT NULL)::INT + (weight IS NOT NULL)::INT + (effect IS NOT NULL)::INT AS n_meta FROM entity_record")
def meta_maps(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "entity_record").select("record_id", "entity_type", "source", "name", "weight", "effect")
    return rows.select("record_id", "entity_type", "source", F.size(records.meta_map(rows, ["record_id", "entity_type", "source"])).alias("n_meta"))


# ---- ordering and keeping one ----


@query("SELECT doc_id, source, text FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def distinct_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The first document of each text."""
    rows = _docs(spark, folder).where("text IS NOT NULL").select("doc_id", "source", "text")
    return reconcile.first_by(rows, ["text"], [F.col("doc_id")])


@query("SELECT canonical_id, row_number() OVER (ORDER BY name, canonical_id) AS id FROM canonical_entity")
def surrogate_ids(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.numbered(table(spark, folder, "canonical_entity").select("name", "canonical_id"), ["name", "canonical_id"], "id").drop("name")


@query("SELECT event_id, user_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS next_id FROM events")
def next_events(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.followed(table(spark, folder, "events").select("user_id", "event_id"), "user_id", "event_id", "next_id")


@query(
    f"WITH x AS (SELECT text_type, {_TRIM.format('text')} AS t, (CASE lower(trim(text_type)) "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in lore.WEIGHTS.items())
    + " ELSE 1.0 END)::DOUBLE AS w FROM documents WHERE text_type IS NOT NULL AND text IS NOT NULL), y AS (SELECT *, regexp_split_to_array(t, '\\s+') AS words FROM x WHERE t <> ''), "
    "z AS (SELECT *, greatest(1, floor(len(words) * (CASE WHEN w >= 1 THEN w - 1 ELSE w END))::BIGINT) AS k FROM y), "
    "s AS (SELECT text_type, length(t) AS o, length(CASE WHEN w > 1 THEN t || chr(10) || chr(10) || array_to_string(words[1:k], ' ') WHEN w = 1 THEN t ELSE array_to_string(words[1:k], ' ') END) AS l FROM z) "
    "SELECT text_type, count(*) AS blocks, median(o) AS median_original, median(l) AS median_weighted FROM s GROUP BY 1"
)
def weighting_stats(spark: SparkSession, folder: str) -> DataFrame:
    weights = F.create_map(*[F.lit(v) for kv in lore.WEIGHTS.items() for v in kv])
    body = T.trim_space("text")
    rows = _docs(spark, folder).where(F.col("text_type").isNotNull() & (body != "")).select(
        "text_type", F.length(body).alias("original_length"), F.length(T.scale_block("text", F.coalesce(F.try_element_at(weights, F.lower(F.trim("text_type"))), F.lit(1.0)))).alias("weighted_length")
    )
    return lore.weighting_stats(rows)


@query("SELECT doc_id FROM documents WHERE trim(text) <> '' AND category IN ('npc', 'boss') AND starts_with(canonical_id, 'npc:') AND (source NOT IN ('impalers') OR source IS NULL)")
def filtered_lines(spark: SparkSession, folder: str) -> DataFrame:
    clauses = retrieval.parse_filters(["category=npc,boss", "source!=impalers"])
    return retrieval.where(_docs(spark, folder), clauses).where((F.trim("text") != "") & F.col("canonical_id").startswith("npc:")).select("doc_id")


_NULLS = ["canonical_id", "lang", "source", "text"]


@query(
    "WITH p AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS c, round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 4) AS p FROM documents" for c in _NULLS)
    + ") SELECT 'column' AS level, c AS subject, p AS percent FROM p WHERE p >= 1.0 UNION ALL SELECT 'overall', 'nulls', round(avg(p), 4) FROM p HAVING avg(p) >= 0.5"
)
def quality_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.alerts(profile.profile(_docs(spark, folder), _NULLS), 1.0, 0.5)
