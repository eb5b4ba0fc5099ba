"""Registered queries of the training-data problems (pN_), and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from . import canonical, clusters, encode, matching, mixing, neighbours, spans, survivor, vectors


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of chunks of which one is among the five most similar to the other, at 0.9 or more."""
    return neighbours.near_pairs(table(spark, folder, "corpus_chunk"), "chunk_id", "embedding", 128).selectExpr("a AS chunk_a", "b AS chunk_b")


def p3_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The most similar others of each chunk, with their similarity."""
    return neighbours.nearest(table(spark, folder, "corpus_chunk"), "chunk_id", "embedding", 128)


def p3_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five most similar others, however unlike, of every chunk whose id is divisible by 100."""
    rows = vectors.usable_vectors(table(spark, folder, "corpus_chunk"), "chunk_id", "embedding", 128)
    return neighbours.search(rows.where("id % 100 = 0"), rows, 128)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of records of different sources that are one thing."""
    return matching.match(table(spark, folder, "source_entity")).selectExpr("a AS entity_a", "b AS entity_b")


def p4_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs with the confidence of each."""
    return matching.match(table(spark, folder, "source_entity"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The record that gives each field of each group's survivor."""
    return survivor.survivors(table(spark, folder, "entity_record"), "match_key", survivor.entity_rules()).select("match_key", "field_name", "record_id")


def p5_golden(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving record of each group."""
    return survivor.golden(table(spark, folder, "entity_record"), "match_key", survivor.entity_rules())


def p5_currency(spark: SparkSession, folder: str) -> DataFrame:
    """Where each group's thing is obtained now, undated values placed by learned precedence."""
    return survivor.currency_latest(table(spark, folder, "entity_record"), "match_key", "obtained_from", survivor.usable_text("obtained_from"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The entity each open alias means, or unmatched."""
    found = canonical.map_aliases(table(spark, folder, "entity_aliases"), table(spark, folder, "canonical_entity"), table(spark, folder, "alias_pattern"))
    return found.select("alias_id", "canonical_id")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks that follow each other within their cluster."""
    found = clusters.clusters(table(spark, folder, "corpus_chunk"), "chunk_id", "embedding", 128)
    return clusters.chained(found).selectExpr("a AS chunk_a", "b AS chunk_b")


def p7_described(spark: SparkSession, folder: str) -> DataFrame:
    """Each cluster with its size and most typical members."""
    chunks = table(spark, folder, "corpus_chunk")
    return clusters.described(clusters.clusters(chunks, "chunk_id", "embedding", 128), chunks, "chunk_id", "text")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return encode.encode(table(spark, folder, "documents"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The share of all tokens that each target source has in the mix."""
    targets = table(spark, folder, "mix_target")
    return mixing.shares(mixing.select(table(spark, folder, "documents"), targets), targets)


def p9_selected(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the mix and how often each is used."""
    return mixing.select(table(spark, folder, "documents"), table(spark, folder, "mix_target"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of at least 200 characters that stand in another document too."""
    return spans.shared_spans(table(spark, folder, "documents"))


def p10_share(spark: SparkSession, folder: str) -> DataFrame:
    """How much of each document is shared."""
    return spans.shared_share(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (p3_found, p3_nearest, p3_search, p4_found, p4_confidence, p5_found, p5_golden, p5_currency, p6_found, p7_found, p7_described, p8_ids, p9_selected, p9_shares, p10_found, p10_share)
}

_TRIMMED = "regexp_replace({0}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"
_MARKS = ", ".join(f"'{p}'" for p in survivor.PLACEHOLDERS)


def _usable(column: str) -> str:
    t = f"lower({_TRIMMED.format(column)})"
    return f"{column} IS NOT NULL AND {t} <> '' AND {t} NOT IN ({_MARKS})"


def _survivor_sql(value: bool) -> str:
    """Rows of survivors by plain SQL, with their value or without."""
    prio, date = "coalesce(source_priority, 99)", "-coalesce(epoch_us(updated_at), -4611686018427387904)"
    order = {
        "name": f"({prio}, {date}, record_id)", "weight": f"({prio}, {date}, record_id)", "effect": f"({prio}, {date}, record_id)", "obtained_from": f"({date}, {prio}, record_id)",
        "description": f"(-length({_TRIMMED.format('description')}), {prio}, {date}, record_id)",
    }
    parts = []
    for field, by in order.items():
        ok = "weight IS NOT NULL AND NOT isnan(weight) AND weight > 0 AND NOT isinf(weight)" if field == "weight" else _usable(field)
        shown = f", arg_min({field}::VARCHAR, {by}) AS value" if value else ""
        parts.append(f"SELECT match_key, '{field}' AS field_name, arg_min(record_id, {by}) AS record_id{shown} FROM r WHERE {ok} GROUP BY 1")
    keyed = f"SELECT * REPLACE (lower({_TRIMMED.format('match_key')}) AS match_key) FROM entity_record WHERE match_key IS NOT NULL"
    return f"WITH a AS ({keyed}), r AS (SELECT * FROM a QUALIFY count(*) OVER (PARTITION BY match_key) >= 2) " + " UNION ALL ".join(parts)


_NEAREST = (
    "WITH u AS (SELECT chunk_id, embedding::DOUBLE[] AS e FROM corpus_chunk WHERE embedding IS NOT NULL AND len(embedding) = 128 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0), "
    "s AS (SELECT a.chunk_id AS id, b.chunk_id AS other, round(list_cosine_similarity(a.e, b.e), 6) AS similarity FROM u a JOIN u b ON a.chunk_id <> b.chunk_id), "
    "t AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, other) AS rank FROM s QUALIFY rank <= 5) "
)

ORACLES: dict[str, str] = {
    "p3_found": _NEAREST + "SELECT DISTINCT least(id, other) AS chunk_a, greatest(id, other) AS chunk_b FROM t WHERE similarity >= 0.9",
    "p3_nearest": _NEAREST + "SELECT id, other, similarity, rank FROM t WHERE similarity >= 0.9",
    "p3_search": _NEAREST.replace("FROM u a JOIN u b ON a.chunk_id <> b.chunk_id", "FROM u a JOIN u b ON a.chunk_id <> b.chunk_id WHERE a.chunk_id % 100 = 0") + "SELECT id, other, similarity, rank FROM t",
    "p5_found": _survivor_sql(value=False),
    "p5_golden": "WITH l AS (" + _survivor_sql(value=True) + "), n AS (SELECT match_key, count(*) AS n_records FROM (" + f"SELECT lower({_TRIMMED.format('match_key')}) AS match_key FROM entity_record WHERE match_key IS NOT NULL" + ") GROUP BY 1) "
    "SELECT match_key, any_value(n_records) AS n_records, " + ", ".join(f"max(value) FILTER (field_name = '{f}') AS {f}" for f in ("name", "weight", "effect", "obtained_from", "description")) + " FROM l JOIN n USING (match_key) GROUP BY 1",
}
