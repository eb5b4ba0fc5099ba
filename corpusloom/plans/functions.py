"""Registered queries of column functions, processing, models and streams, each with SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import incremental, lore, motifs, process, profile, registry, retrieval
from ..session import shared_folder, table
from ..sources import records
from ..streaming import incremental as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable:
    """Registers a function as a query by its name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


_GONE = "lower(trim({0})) IN ('', 'nan', 'none', 'null')"
_SPACED = "lower(regexp_replace(regexp_replace({0}, '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g'))"


# ---- columns ----


@query("SELECT c_custkey AS cust_key, c_name AS full_name, c_acctbal AS acct_bal, c_mktsegment AS market_segment FROM customer")
def snake_columns(spark: SparkSession, folder: str) -> DataFrame:
    return process.normalized_names(table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").toDF("custKey", "Full-Name", "acctBal", "market segment"))


@query("SELECT c_custkey AS cust_key, c_name AS name, c_acctbal AS name_2, c_mktsegment AS segment FROM customer")
def plain_columns(spark: SparkSession, folder: str) -> DataFrame:
    named = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment").toDF("Cust Key", "Name!", "(name)", "segment?")
    return process.normalized_names(named, "plain")


@query("SELECT s_suppkey AS boss_id, s_name AS name FROM supplier")
def keyed_bosses(spark: SparkSession, folder: str) -> DataFrame:
    return process.with_key(table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), "bosses")


_TEXTS = ("name", "description", "effect", "obtained_from")


@query("SELECT record_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} IS NOT NULL AND NOT {_GONE.format(c)} THEN regexp_replace({c}, '^ +| +$', '', 'g') END" for c in _TEXTS) + "], lambda x: x IS NOT NULL), chr(10) || chr(10)) AS description FROM entity_record")
def entity_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "entity_record")
    return df.select("record_id", records.entity_description(df, [*_TEXTS, "lore"]).alias("description"))


@query(
    "SELECT c_custkey, 'Customer of ' || c_mktsegment || chr(10) || chr(10) || 'Stats: balance: ' || floor(c_acctbal)::BIGINT || ', nation: ' || c_nationkey || CASE WHEN c_custkey % 2 = 0 THEN chr(10) || chr(10) || 'Location: ' || c_mktsegment ELSE '' END AS description FROM customer"
)
def api_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    stats = F.create_map(F.lit("balance"), F.floor("c_acctbal").cast("long").cast("string"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    full = c.select("c_custkey", F.concat(F.lit(" Customer of "), F.col("c_mktsegment")).alias("d"), stats.alias("s"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.col("c_mktsegment"), F.lit(" "))).alias("l"))
    return full.select("c_custkey", records.stats_description("d", "s", "l").alias("description"))


_PARTS = {"description": "Description", "effect": "Effect"}
_P = {c: f"CASE WHEN {c} IS NOT NULL AND NOT {_GONE.format(c)} THEN regexp_replace({c}, '^ +| +$', '', 'g') END" for c in _PARTS}


@query(
    f"WITH x AS (SELECT record_id, {_P['description']} AS d, {_P['effect']} AS e FROM entity_record) "
    "SELECT record_id, CASE WHEN d IS NOT NULL AND e IS NOT NULL THEN 'Description: ' || d || chr(10) || chr(10) || 'Effect: ' || e ELSE coalesce(d, e, '') END AS body FROM x"
)
def labelled_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "entity_record").select("record_id", V.labelled_text(_PARTS).alias("body"))


@query("SELECT record_id, '-' AS scaling_str, '[]' AS provenance, coalesce(name, 'other') AS name, entity_type FROM entity_record")
def fixed_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Columns in a fixed order, missing ones with their defaults, then the others."""
    df = table(spark, folder, "entity_record").select("entity_type", "name", "record_id")
    return records.in_order(df, ["record_id", "scaling_str", "provenance", "name"]).fillna({"scaling_str": "-", "provenance": "[]", "name": "other"})


# ---- values ----


@query("SELECT event_id, ts::TIMESTAMP AS at FROM events")
def iso_times(spark: SparkSession, folder: str) -> DataFrame:
    """Times of ISO texts with Z, an offset, or none."""
    t = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zone = F.when(F.col("event_id") % 3 == 0, "Z").when(F.col("event_id") % 3 == 1, "+00:00").otherwise("")
    return table(spark, folder, "events").select("event_id", V.iso_time(F.concat(t, zone)).cast("timestamp_ntz").alias("at"))


_RARE = "CASE p_partkey % 6 WHEN 0 THEN ' Common' WHEN 1 THEN 'UNCOMMON ' WHEN 2 THEN 'rare' WHEN 3 THEN 'Legendary' WHEN 4 THEN 'mythic' END"


@query(f"SELECT p_partkey, CASE WHEN lower(trim({_RARE})) IN ('common', 'uncommon', 'rare', 'legendary') THEN lower(trim({_RARE})) END AS rarity FROM part")
def rarities(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select("p_partkey", V.rarity(F.expr(_RARE)).alias("rarity"))


@query("SELECT event_id, CASE lower(trim(event_type)) WHEN 'purchase' THEN 'buy' ELSE coalesce(lower(trim(event_type)), 'nan') END AS kind FROM events")
def categorical_values(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", V.categorical(F.upper("event_type"), {"purchase": "buy"}).alias("kind"))


@query(
    "SELECT record_id, TRY_CAST(v AS BIGINT) AS whole, TRY_CAST(v AS DOUBLE) AS number FROM (SELECT record_id, CASE record_id % 4 WHEN 0 THEN record_id::VARCHAR WHEN 1 THEN 'many' WHEN 2 THEN record_id || 'x' END AS v FROM entity_record)"
)
def coerced_values(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("record_id")
    v = F.when(k % 4 == 0, k.cast("string")).when(k % 4 == 1, "many").when(k % 4 == 2, F.concat(k.cast("string"), F.lit("x")))
    return profile.coerced(table(spark, folder, "entity_record").select("record_id", v.alias("whole"), v.alias("number")), {"whole": "bigint", "number": "double"})


_WRITTEN = "CASE record_id % 5 WHEN 0 THEN '[{''name'': ''Str'', ''amount'': ' || record_id || '}, {''name'': ''Dex'', ''amount'': None}]' WHEN 1 THEN '{\"Str\": ' || record_id || ', \"Arc\": \"7\"}' WHEN 2 THEN '[{\"Int\": 4}, {\"name\": \"fai\", \"amount\": 9}]' WHEN 3 THEN 'neither' END"


@query(
    "SELECT record_id, CASE record_id % 5 WHEN 0 THEN 'Str: ' || record_id || '; Dex' WHEN 1 THEN 'Str: ' || record_id || '; Arc: 7' WHEN 2 THEN 'fai: 9' WHEN 3 THEN 'neither' END AS line, "
    "CASE WHEN record_id % 5 IN (0, 1) THEN record_id END AS required_str, CASE record_id % 5 WHEN 2 THEN 4 END::BIGINT AS required_int, CASE record_id % 5 WHEN 2 THEN 9 END::BIGINT AS required_fai, CASE record_id % 5 WHEN 1 THEN 7 END::BIGINT AS required_arc, "
    "record_id % 5 IN (0, 1, 2) AS structured FROM entity_record"
)
def structured_values(spark: SparkSession, folder: str) -> DataFrame:
    """Loosely written structures: a readable line, requirements by attribute, and whether they can be read."""
    t = table(spark, folder, "entity_record").select("record_id", F.expr(_WRITTEN).alias("t"))
    needs = V.requirements(V.entries("t"))
    return t.select("record_id", V.structured_text("t").alias("line"), *[needs[n].alias(n) for n in ("required_str", "required_int", "required_fai", "required_arc")], F.coalesce(V.structured_json("t").isNotNull(), F.lit(False)).alias("structured"))


_ARMOR = "CASE record_id % 4 WHEN 0 THEN '[{\"name\": \"Phy\", \"amount\": -2.5}, {\"name\": \"Poi.\", \"amount\": 12.5}]' WHEN 1 THEN '[{\"VS Str.\": 3.4, \"Imm.\": \"1,204\"}]' WHEN 2 THEN '{\"Fire\": 8, \"Rob.\": 9.9}' END"


@query(
    "SELECT record_id, CASE record_id % 4 WHEN 0 THEN 0.0 END::DOUBLE AS defense_physical, CASE record_id % 4 WHEN 1 THEN 3.4 END::DOUBLE AS defense_strike, CASE record_id % 4 WHEN 2 THEN 8.0 END::DOUBLE AS defense_fire, "
    "CASE record_id % 4 WHEN 0 THEN 12.5 END::DOUBLE AS poise, CASE record_id % 4 WHEN 1 THEN 1204 END::BIGINT AS resistance_immunity, CASE record_id % 4 WHEN 2 THEN 9 END::BIGINT AS resistance_robustness FROM entity_record"
)
def armor_values(spark: SparkSession, folder: str) -> DataFrame:
    """Negations and resistances: not below 0, null where not given, poise not cut, keys as names."""
    t = table(spark, folder, "entity_record").select("record_id", F.expr(_ARMOR).alias("t"))
    found = {**V.negations(V.entries("t")), **V.resistances(V.entries("t"))}
    return t.select("record_id", *[found[n].alias(n) for n in ("defense_physical", "defense_strike", "defense_fire", "poise", "resistance_immunity", "resistance_robustness")])


@query("SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'boss' WHEN 1 THEN 'ash_of_war' WHEN 2 THEN 'weapon' WHEN 3 THEN 'sorcery' ELSE 'item' END AS entity_type FROM nation")
def derived_types(spark: SparkSession, folder: str) -> DataFrame:
    name = F.element_at(F.array(*[F.lit(x) for x in ("Bosses", "ashes", "weapons ", "sorceries", "items")]), (F.col("n_nationkey") % 5 + 1).cast("int"))
    return table(spark, folder, "nation").select("n_nationkey", V.entity_type_of(name).alias("entity_type"))


@query("SELECT entity_id, coalesce(is_dlc, false) AS is_dlc, CASE WHEN trim(category) <> '' THEN trim(category) WHEN trim(source) <> '' THEN trim(source) END AS place FROM source_entity")
def flags_and_places(spark: SparkSession, folder: str) -> DataFrame:
    written = F.when(F.col("is_dlc"), " Yes").when(~F.col("is_dlc"), "0").otherwise("?")
    return table(spark, folder, "source_entity").select("entity_id", F.coalesce(V.flag(written), F.lit(False)).alias("is_dlc"), V.first_filled("category", "source").alias("place"))


@query(f"SELECT doc_id, {_SPACED.format('text')} AS quote FROM documents")
def quote_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", T.quote_text("text").alias("quote"))


@query("SELECT alias_id, coalesce(regexp_full_match(raw_id, '[a-z0-9_-]{2,39}'), false) AS ok FROM entity_aliases")
def handles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "entity_aliases").select("alias_id", T.handle_ok("raw_id").alias("ok"))


@query(
    "SELECT event_id, array_to_string(list_filter(x, lambda v, i: list_position(x, v) = i), ',') AS tags "
    "FROM (SELECT event_id, list_filter([trim(event_type), 'tag' || user_id % 3, '', event_type, 'tag1'], lambda v: v <> '') AS x FROM events)"
)
def distinct_tags(spark: SparkSession, folder: str) -> DataFrame:
    tags = F.array(F.concat(F.lit(" "), F.col("event_type")), F.concat(F.lit("tag"), (F.col("user_id") % 3).cast("string")), F.lit(" "), F.col("event_type"), F.lit("tag1 "))
    return table(spark, folder, "events").select("event_id", F.array_join(incremental.distinct_in_order(tags), ",").alias("tags"))


# ---- processing ----

_COUNTED = {"record_id": "bigint", "match_key": "string", "weight": "double", "is_dlc": "boolean", "source_priority": "int"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS nulls FROM entity_record" for c, t in _COUNTED.items()))
def table_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return process.statistics(table(spark, folder, "entity_record").select(*[F.col(c).cast(t).alias(c) for c, t in _COUNTED.items()]))


@query("SELECT endpoint AS status, count(*) AS n FROM api_page GROUP BY 1")
def outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    return process.outcome_counts(table(spark, folder, "api_page").withColumnRenamed("endpoint", "status"))


@query("SELECT 'missing_column' AS rule, 'weapon_type' AS column_name, 1 AS violations UNION ALL SELECT 'not_null', 'weapon_type', count(*) FROM part")
def missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Required columns that a table lacks, with the rows that miss their value."""
    df = table(spark, folder, "part").select(F.col("p_partkey").alias("weapon_id"), F.col("p_name").alias("name"))
    return registry.validate(df, registry.find("weapons"))[1].where("rule IN ('missing_column', 'not_null')")


# ---- lore ----


def _weight_case() -> str:
    return "CASE lower(trim(t)) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in lore.WEIGHTS.items()) + " ELSE 1.0 END"


@query(
    "WITH l AS (SELECT canonical_id, coalesce(text_type, '') AS t, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS x FROM documents WHERE canonical_id IS NOT NULL) "
    f"SELECT canonical_id, max(({_weight_case()})::DOUBLE) AS weight, count(DISTINCT t) AS component_count FROM l WHERE x <> '' GROUP BY 1"
)
def primary_types(spark: SparkSession, folder: str) -> DataFrame:
    """The weight of the text type that stands first in each entity's text."""
    docs = table(spark, folder, "documents").select("canonical_id", "text_type", "text", "doc_id")
    composed = lore.weighted_texts(docs, "canonical_id", "text_type", "text", "doc_id")
    known = F.create_map(*[F.lit(v) for kv in lore.WEIGHTS.items() for v in kv])
    return composed.select("canonical_id", F.coalesce(F.try_element_at(known, F.lower("text_type")), F.lit(1.0)).alias("weight"), "component_count")


@query(
    "WITH k AS (SELECT canonical_id, doc_id, text FROM documents WHERE canonical_id IS NOT NULL AND text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY canonical_id ORDER BY doc_id) <= 3), "
    "q AS (SELECT canonical_id, list(doc_id ORDER BY doc_id) AS ids, list(text ORDER BY doc_id) AS texts FROM k GROUP BY 1), "
    "c AS (SELECT canonical_id, ids, texts, unnest(ids) AS doc_id FROM q) "
    "SELECT canonical_id, doc_id, coalesce(list_filter(ids, lambda i: i::VARCHAR = 'see ' || doc_id)[1], list_filter(ids, lambda i: contains('see ' || doc_id, i::VARCHAR))[1])::VARCHAR AS quote_id FROM c"
)
def quoted_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Claims that name their line within a sentence."""
    docs = table(spark, folder, "documents").where("canonical_id IS NOT NULL AND text IS NOT NULL").select("canonical_id", "doc_id", "text")
    three = docs.groupBy("canonical_id").agg(F.slice(F.array_sort(F.collect_list("doc_id")), 1, 3).alias("ids"))
    kept = three.select("canonical_id", F.explode("ids").alias("doc_id")).join(docs, ["canonical_id", "doc_id"])
    known = kept.groupBy("canonical_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda x: F.struct(x["doc_id"].cast("string").alias("id"), x["text"].alias("text"))).alias("quotes"))
    claims = kept.select("canonical_id", "doc_id", F.concat(F.lit("see "), F.col("doc_id").cast("string")).alias("claimed_id"), F.lit("").alias("claimed_text"))
    return motifs.resolve_quotes(claims, known, "canonical_id", "claimed_id", "claimed_text").select("canonical_id", "doc_id", "quote_id")


# ---- retrieval ----


@query(
    "WITH w AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL QUALIFY r <= 40), "
    "s AS (SELECT doc_id, r, CASE WHEN r <= 25 THEN length(text)::DOUBLE END AS rerank_score FROM w) "
    "SELECT doc_id, rerank_score, row_number() OVER (ORDER BY (r > 25)::INT, rerank_score DESC NULLS LAST, r) AS rank FROM s"
)
def reranked(spark: SparkSession, folder: str) -> DataFrame:
    """A window of 40 documents whose first 25 are scored anew, here by their length."""
    from pyspark.sql import Window

    window = table(spark, folder, "documents").where("text IS NOT NULL").orderBy("doc_id").limit(40).select("doc_id", "text")
    ranked = window.withColumn("rank", F.row_number().over(Window.orderBy("doc_id")))
    return retrieval.rerank(ranked, lambda t: t.str.len().astype(float), "text", pool=25).select("doc_id", "rerank_score", "rank")


_WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"


@query(
    f"WITH w AS (SELECT doc_id, unnest({_WORDS}) AS w FROM documents), b AS (SELECT doc_id, ('0x' || left(md5(w), 8))::BIGINT % 16 AS i, count(*)::DOUBLE AS n FROM w GROUP BY 1, 2) "
    "SELECT d.doc_id, j AS i, coalesce(round(b.n / sqrt(sum(coalesce(b.n * b.n, 0)) OVER (PARTITION BY d.doc_id)), 6), 0) AS value FROM documents d CROSS JOIN range(16) AS r(j) LEFT JOIN b ON b.doc_id = d.doc_id AND b.i = j"
)
def encoded_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as vectors of hashed words."""
    coded = retrieval.with_vectors(table(spark, folder, "documents").select("doc_id", "text"), "text", retrieval.HashedWords(16), "v")
    return coded.select("doc_id", F.posexplode("v").alias("i", "value")).select("doc_id", F.col("i").cast("long").alias("i"), F.round("value", 6).alias("value"))


# ---- streams ----


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream of its file."""
    source = table(spark, folder, name)
    path = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    source.write.parquet(path)
    return spark.readStream.schema(source.schema).parquet(path)


def _run(df: DataFrame, mode: str = "append") -> DataFrame:
    """The rows that a stream has given when its input is done."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/out-{uuid.uuid4().hex}"
    writer = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{path}-state").format("parquet")
    writer.start(path).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_once(spark: SparkSession, folder: str) -> DataFrame:
    """Each signature once."""
    stream = _stream(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return _run(streams.once(stream, ["user_id", "event_type"], "ts", "3650 days").select("user_id", "event_type"))


@query("SELECT event_id, user_id FROM events WHERE ts >= (SELECT min(ts) FROM events) + INTERVAL 3 DAY")
def stream_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """Events since a cutoff."""
    since = table(spark, folder, "events").agg(F.min("ts").alias("m")).first()["m"]
    stream = _stream(spark, folder, "events")
    return _run(streams.replayed(stream, "ts", F.lit(since) + F.expr("INTERVAL 3 DAYS")).select("event_id", "user_id"))


_ORDERED = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@query(
    "WITH e AS (SELECT *, lag(event_type) OVER w AS before, lag(ts) OVER w AS earlier FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1) WINDOW w AS (PARTITION BY user_id ORDER BY ts)) "
    "SELECT user_id::VARCHAR AS key, event_id::VARCHAR AS value, CASE WHEN event_type = 'error' THEN 'deleted' WHEN before IS NULL OR before = 'error' THEN 'created' ELSE 'updated' END AS outcome FROM e"
)
def stream_state(spark: SparkSession, folder: str) -> DataFrame:
    """What each event did to its user's entry; an error deletes it."""
    stream = _stream(spark, folder, "events")
    states = streams.latest_state(stream.withColumn("gone", F.col("event_type") == "error"), "user_id", "ts", "event_id", "gone")
    return _run(states.select("key", "value", "outcome")).where("outcome != 'stale'")


@query("SELECT user_id, event_type, 1 AS times FROM events GROUP BY ALL")
def stream_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Signatures processed by a stream that runs twice over the same events: none of them twice."""
    path = f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    keys = ["user_id", "event_type"]
    for i in (1, 2):
        stream = _stream(spark, folder, "events").select(*keys)
        writer = streams.each_batch(stream, f"{path}/seen", keys, lambda batch: batch.write.mode("append").parquet(f"{path}/done"))
        writer.trigger(availableNow=True).option("checkpointLocation", f"{path}/state{i}").start().awaitTermination()
    return spark.read.parquet(f"{path}/done").groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("times"))
