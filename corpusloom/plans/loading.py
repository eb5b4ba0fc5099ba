"""Registered queries of sources, loaders and sinks, each with SQL that gives the same rows.

Round trips write a table into the shared folder and read it back with the reader that belongs to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import values as V
from ..session import shared_folder, table
from ..sources import readers, records, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable:
    """Registers a function as a query by its name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def _scratch(spark: SparkSession, suffix: str = "") -> str:
    return f"{shared_folder(spark)}/written-{uuid.uuid4().hex}{suffix}"


# ---- domain loaders, over the payloads of raw records ----

#: Names under which payload fields are looked for, as the loaders know them (those that differ in case only are left out).
_FIELDS = tuple(dict.fromkeys(n for names in records.NAMES.values() for n in names if n not in ("DLC", "HP")))

#: Kinds of source with the priority of each.
_KINDS = {"dlc": 1, "base": 2, "api": 3}


def payload_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records as a wide table of texts, nested values as JSON."""
    schema = ", ".join(f"`{n}` string" for n in _FIELDS)
    raw = table(spark, folder, "raw_record").where(F.try_parse_json("payload").isNotNull())
    return raw.select("record_id", F.from_json("payload", schema).alias("p")).select("record_id", "p.*")


def _lookup(text: str, names: dict[str, str]) -> str:
    return f"CASE {text} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


def _filled(want: str, fields: tuple[str, ...]) -> str:
    """SQL of the first filled of the fields an attribute goes by."""
    parts = [f"nullif(trim(json_extract_string(p, '$.\"{n}\"')), '')" for n in records.NAMES[want] if n in fields]
    return f"coalesce({', '.join([*parts, 'NULL'])})"


def _doc(text: str) -> str:
    python = f"replace(replace(replace(replace({text}, '''', chr(34)), 'None', 'null'), 'True', 'true'), 'False', 'false')"
    return f"CASE WHEN json_valid({text}) THEN {text} WHEN json_valid({python}) THEN {python} END::JSON"


def _entries(doc: str) -> str:
    """SQL of a list of entries (JSON objects with name, amount, scaling, value)."""
    keys = f"list_transform(json_keys({doc}), lambda k: json_object('name', k, 'amount', json_extract_string({doc}, '$.\"' || k || '\"'), 'scaling', json_extract_string({doc}, '$.\"' || k || '\"'), 'value', json_extract_string({doc}, '$.\"' || k || '\"')))"
    return f"CASE json_type({doc}) WHEN 'ARRAY' THEN list_filter({doc}::JSON[], lambda e: json_type(e) = 'OBJECT') WHEN 'OBJECT' THEN {keys} ELSE [] END"


def _last(found: str, keys: list[str], value: str, given: bool = False) -> str:
    some = " AND json_extract_string(e, '$.scaling') IS NOT NULL" if given else ""
    hit = f"list_filter({found}, lambda e: lower(trim(json_extract_string(e, '$.name'))) IN ({', '.join(repr(k) for k in keys)}){some})[-1]"
    return f"json_extract_string({hit}, '$.{value}')"


def _float(x: str) -> str:
    return f"TRY_CAST(replace(trim({x}), ',', '') AS DOUBLE)"


def _int(x: str) -> str:
    return f"TRY_CAST(trunc({_float(x)}) AS BIGINT)"


def _keys(names: dict[str, str]) -> dict[str, list[str]]:
    return {t: [k for k, x in names.items() if x == t] for t in dict.fromkeys(names.values())}


def _pivoted(found: str, names: dict[str, str], form: Callable[[str, str], str], value: str = "amount") -> dict[str, str]:
    return {t: form(_last(found, keys, value), t) for t, keys in _keys(names).items()}


_FLAG = "CASE WHEN lower(trim({0})) IN ('1', 'true', 'yes', 'y', 't', '1.0') THEN true WHEN lower(trim({0})) IN ('0', 'false', 'no', 'n', 'f', '', '0.0') THEN false END"


def _requirements(found: str) -> dict[str, str]:
    return {t: _int(f"coalesce({_last(found, keys, 'amount')}, {_last(found, keys, 'value')})") for t, keys in _keys(V.REQUIREMENTS).items()}


def _weapon_type(t: str) -> str:
    t = f"trim(translate(lower({t}), '-_/', '   '))"
    one = f"CASE WHEN ends_with({t}, 's') THEN {_lookup(f'left({t}, length({t}) - 1)', V.WEAPON_TYPES)} END"
    return f"coalesce({one}, {_lookup(t, V.WEAPON_TYPES)}, {_lookup(f'''regexp_replace({t}, 's+$', '')''', V.WEAPON_TYPES)}, 'other')"


def _armor_type(t: str) -> str:
    t = f"lower(trim({t}))"
    return "CASE " + " ".join(f"WHEN regexp_matches({t}, '{'|'.join(parts)}') THEN '{slot}'" for slot, parts in V.ARMOR_SLOTS) + " ELSE 'other' END"


def _item_category(t: str) -> str:
    t = f"trim(regexp_replace(translate(lower({t}), '-_', '  '), '\\s+', ' ', 'g'))"
    parts = " ".join(f"WHEN contains({t}, '{k}') OR contains('{k}', {t}) THEN '{v}'" for k, v in V.ITEM_CATEGORIES.items())
    return f"CASE WHEN {t} IS NULL OR {t} = '' THEN 'other' ELSE coalesce({_lookup(t, V.ITEM_CATEGORIES)}, CASE {parts} END, 'other') END"


def _own(domain: str) -> dict[str, str]:
    """SQL of a domain's own columns."""
    above = lambda x: f"CASE WHEN {x} IS NOT NULL THEN greatest({x}, 0) END"
    if domain == "weapons":
        scaling = {t: f"coalesce(nullif(upper(trim({_last('sc', keys, 'scaling', True)})), ''), '-')" for t, keys in _keys(V.SCALING).items()}
        return {"weapon_type": _weapon_type("category"), "weight": _float("weight"), **_pivoted("atk", V.DAMAGE, lambda x, _: _float(x)), **_requirements("rq"), **scaling}
    if domain == "armor":
        resist = _pivoted("re", V.RESISTANCES, lambda x, t: above(_float(x) if t == "poise" else _int(x)))
        return {"armor_type": _armor_type("category"), "weight": _float("weight"), **_pivoted("ne", V.NEGATIONS, lambda x, _: above(_float(x))), **resist}
    if domain == "items":
        rarity = f"CASE WHEN lower(trim(rarity)) IN ({', '.join(repr(r) for r in V.RARITIES)}) THEN lower(trim(rarity)) END"
        return {"category": _item_category("category"), "weight": _float("weight"), "sell_price": _int("sell_price"), "max_stack": _int("max_stack"), "rarity": rarity, "effect": "effect", "obtained_from": "trim(obtained_from)"}
    if domain == "bosses":
        return {"region": "region", "location": "obtained_from", "health_points": _int("health_points"), "drops": "trim(drops)"}
    needs = {t: x for t, x in _requirements("rq").items() if t in ("required_int", "required_fai", "required_arc")}
    kind = "CASE WHEN contains(lower(spell_type), 'incant') THEN 'incantation' WHEN contains(lower(spell_type), 'sorc') THEN 'sorcery' ELSE 'other' END"
    return {"spell_type": kind, "fp_cost": _int("cost"), "slots_required": _int("slots"), "effect": "effect", **needs}


_SLUG = "regexp_replace(regexp_replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s-]', '', 'g'), '[-\\s]+', '_', 'g'), '^_+|_+$', '', 'g')"


_RAW = "SELECT record_id, payload::JSON AS p FROM raw_record WHERE json_valid(payload)"


def load_sql(domain: str, source: str, kind: str, columns: list[str], rows: str = _RAW, fields: tuple[str, ...] = _FIELDS) -> str:
    """SQL of a domain loader over JSON objects ``p``."""
    wants = [w for w in records.NAMES if w not in ("attack", "requirements", "scaling", "negation", "resistance")]
    lists = {"atk": "attack", "rq": "requirements", "sc": "scaling", "ne": "negation", "re": "resistance"}
    own = _own(domain)
    shared = {
        "source_id": "source_id", "name": "name", "canonical_slug": _SLUG.format("name"), "description": "CASE WHEN lower(trim(description)) NOT IN ('', 'nan', 'none', 'null') THEN description END",
        "is_dlc": "true" if kind == "dlc" else f"coalesce({_FLAG.format('dlc')}, false)", "source": f"'{source}'", "source_priority": str(_KINDS[kind]),
    }
    picked = {**shared, **own}
    return (
        f"WITH r AS ({rows}), "
        f"t AS (SELECT {', '.join(f'{_filled(w, fields)} AS {w}' for w in wants)}, {', '.join(f'{_filled(w, fields)} AS {k}_text' for k, w in lists.items())} FROM r), "
        f"d AS (SELECT *, {', '.join(f'{_doc(f'{k}_text')} AS {k}_doc' for k in lists)} FROM t), "
        f"e AS (SELECT *, {', '.join(f'{_entries(f'{k}_doc')} AS {k}' for k in lists)} FROM d) "
        f"SELECT {', '.join(f'{picked[c]} AS {c}' for c in columns)} FROM e WHERE name IS NOT NULL"
    )


_COMMON = ["source_id", "name", "canonical_slug", "description", "is_dlc", "source", "source_priority"]


def _loader(domain: str, source: str, kind: str) -> None:
    def load(spark: SparkSession, folder: str) -> DataFrame:
        return records.load(payload_columns(spark, folder), domain, source, kind)

    name = f"load_{domain}_{kind}"
    load.__name__, load.__doc__ = name, f"Raw records as {domain} of a source of kind {kind}."
    query(load_sql(domain, source, kind, [*_COMMON, *_own(domain)]))(load)


for _domain in records.DOMAINS:
    for _source, _kind in (("kaggle_dlc", "dlc"), ("kaggle_base", "base"), ("github_api", "api")):
        _loader(_domain, _source, _kind)


#: Fields of API items that its loader reads, and the items that are objects.
_API_FIELDS = ("id", "name", "description", "category", "weight", "attack", "requiredAttributes", "scalesWith")
_API_ITEMS = (
    "SELECT o AS p FROM (SELECT unnest((body::JSON -> '$.data')::JSON[]) AS o FROM api_page WHERE endpoint = 'weapons' AND json_valid(body) AND json_type(body::JSON, '$.data') = 'ARRAY') WHERE json_type(o) = 'OBJECT'"
)


@query(load_sql("weapons", "github_api", "api", [*_COMMON, *_own("weapons")], _API_ITEMS, _API_FIELDS))
def canonical_weapons(spark: SparkSession, folder: str) -> DataFrame:
    """Weapons of the API pages' envelopes as canonical records."""
    items = readers.envelope(table(spark, folder, "api_page").where("endpoint = 'weapons'"), ", ".join(f"{n} string" for n in _API_FIELDS), keep=["page_id"])
    return records.load(items, "weapons", "github_api", "api")


# ---- round trips ----


@query("SELECT record_id::VARCHAR AS record_id, nullif(name, '') AS name, nullif(description, '') AS description, '[\"' || coalesce(source, '') || '\",\"' || coalesce(entity_type, '') || '\"]' AS tags FROM entity_record")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as they are and nested values as JSON, through CSV; empty texts come back as null."""
    path = _scratch(spark)
    tags = F.array(F.coalesce("source", F.lit("")), F.coalesce("entity_type", F.lit("")))
    writers.write_csv(table(spark, folder, "entity_record").select("record_id", "name", "description", tags.alias("tags")), path)
    return readers.read_csv(spark, path)


@query("SELECT record_id::VARCHAR AS record_id, nullif(name, '') AS name, true AS named FROM entity_record WHERE entity_type IS NOT NULL")
def csv_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Parts exported by type, read back as one tree of files."""
    path = _scratch(spark)
    writers.export_by_type(table(spark, folder, "entity_record").where("entity_type IS NOT NULL").select("record_id", "name", "entity_type"), path)
    return readers.read_csv_tree(spark, f"{path}/csv").select("record_id", "name", F.col("table_name").startswith("part-").alias("named"))


@query("SELECT record_id, entity_type, name, weight FROM entity_record WHERE entity_type IS NOT NULL")
def packed_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """The Parquet side of an export by type."""
    path = _scratch(spark)
    writers.export_by_type(table(spark, folder, "entity_record").where("entity_type IS NOT NULL").select("record_id", "name", "weight", "entity_type"), path)
    return spark.read.parquet(f"{path}/parquet")


@query("SELECT chunk_id, entity_type, text, embedding[1] AS first_value FROM corpus_chunk")
def parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Nested columns through gzip Parquet, with the CSV as fallback where there is none."""
    path = _scratch(spark)
    writers.write_parquet(table(spark, folder, "corpus_chunk").select("chunk_id", "entity_type", "text", "embedding"), path, "gzip")
    return readers.read_table(spark, path, f"{path}.csv").select("chunk_id", "entity_type", "text", F.get("embedding", F.lit(0)).alias("first_value"))


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name FROM supplier")
def csv_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """A table that is there as CSV only."""
    path = _scratch(spark)
    writers.write_csv(table(spark, folder, "supplier").select("s_suppkey", "s_name"), f"{path}.csv")
    return readers.read_table(spark, path, f"{path}.csv")


@query("SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand FROM part")
def sniffed_file(spark: SparkSession, folder: str) -> DataFrame:
    """A file whose delimiter isn't known."""
    path = _scratch(spark, ".csv")
    table(spark, folder, "part").select("p_partkey", "p_name", "p_brand").write.csv(path, header=True, sep="|")
    return readers.read_any(spark, path)


@query("SELECT canonical_id, name, category FROM canonical_entity")
def json_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = _scratch(spark, ".jsonl")
    writers.write_jsonl(table(spark, folder, "canonical_entity"), path)
    return readers.read_any(spark, path).select("canonical_id", "name", "category")


@query(
    "SELECT 'all' AS kind, 'total' AS name, count(*) AS n FROM source_entity UNION ALL SELECT 'all', 'dlc', count(*) FILTER (is_dlc) FROM source_entity "
    "UNION ALL SELECT 'all', 'base', count(*) - count(*) FILTER (is_dlc) FROM source_entity "
    "UNION ALL SELECT 'type', entity_type, count(*) FROM source_entity GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM source_entity GROUP BY 2"
)
def metadata_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of a curated table's metadata document."""
    doc = writers.metadata(table(spark, folder, "source_entity").withColumn("sources", F.array("source")))
    rows = [("all", k, doc[k]) for k in ("total", "dlc", "base")] + [("type", k, n) for k, n in doc["by_type"].items()] + [("source", k, n) for k, n in doc["by_source"].items()]
    return spark.createDataFrame(rows, "kind string, name string, n long")


@query("SELECT alias_id::VARCHAR AS alias_id, raw_id, comment_text FROM entity_aliases WHERE canonical_id IS NULL AND raw_id IS NOT NULL AND raw_id <> ''")
def unmapped_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Typed values without entity, as the file for review."""
    path = _scratch(spark)
    writers.write_csv(table(spark, folder, "entity_aliases").where("canonical_id IS NULL AND raw_id IS NOT NULL AND raw_id != ''").select("alias_id", "raw_id", "comment_text"), path)
    return readers.read_csv(spark, path)


@query(
    "WITH d AS (SELECT raw_id, min(canonical_id) AS canonical_id FROM entity_aliases WHERE canonical_id IS NOT NULL GROUP BY 1) SELECT regexp_replace(raw_id, '^ +| +$', '', 'g') AS raw_id, min(canonical_id) AS canonical_id FROM d WHERE raw_id <> '' GROUP BY 1 HAVING count(DISTINCT canonical_id) = 1"
)
def alias_file(spark: SparkSession, folder: str) -> DataFrame:
    """An alias table with its columns under other names."""
    path = _scratch(spark, ".parquet")
    one = table(spark, folder, "entity_aliases").where("canonical_id IS NOT NULL").groupBy("raw_id").agg(F.min("canonical_id").alias("to"))
    clear = one.withColumn("alias", F.col("raw_id")).groupBy(F.trim("alias").alias("t")).agg(F.count_distinct("to").alias("n"), F.min("to").alias("to"), F.min("alias").alias("alias")).where("n = 1")
    clear.select("alias", "to").write.parquet(path)
    return readers.read_aliases(spark, path)


def _answers(spark: SparkSession, folder: str) -> str:
    """A file of batch answers: those of doc_id divisible by 5 are cut, those by 7 have another form."""
    path = _scratch(spark)
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    told = F.concat(F.lit("Sure: "), F.to_json(F.struct(F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("none")).alias("lang"))), F.lit(" - done"))
    answer = F.when(F.col("doc_id") % 5 == 0, F.substring(told, F.lit(1), F.length(told) - 9)).otherwise(told)
    direct = F.struct(F.struct(F.array(F.struct(F.array(F.struct(answer.alias("text"))).alias("content"))).alias("output")).alias("body"))
    chat = F.struct(F.struct(F.array(F.struct(F.struct(answer.alias("content")).alias("message"))).alias("choices")).alias("body"))
    line = F.when(F.col("doc_id") % 7 == 0, F.to_json(F.struct(F.col("doc_id").cast("string").alias("custom_id"), chat.alias("response"))))
    docs.select(F.coalesce(line, F.to_json(F.struct(F.col("doc_id").cast("string").alias("custom_id"), direct.alias("response")))).alias("value")).write.text(path)
    return path


@query("SELECT doc_id::VARCHAR AS custom_id, CASE WHEN doc_id % 5 <> 0 THEN coalesce(lang, 'none') END AS lang, doc_id % 5 <> 0 AS ok FROM documents")
def batch_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Answers of a language model service, the objects in their texts repaired."""
    read = readers.read_answers(spark, _answers(spark, folder))
    return read.select("custom_id", F.get_json_object("answer", "$.lang").alias("lang"), "ok")


@query("SELECT count(*) FILTER (doc_id % 5 <> 0) AS successes, count(*) FILTER (doc_id % 5 = 0) AS failures FROM documents")
def batch_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    return readers.answer_diagnostics(readers.read_answers(spark, _answers(spark, folder)))


@query("SELECT canonical_id AS custom_id, 'POST' AS method, 'tiny' AS model, name FROM canonical_entity")
def answer_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Request lines of a batch, with what they carry."""
    made = writers.batch_requests(table(spark, folder, "canonical_entity"), "canonical_id", "tiny", "Summarize.")
    at = lambda p: F.get_json_object("request", p)
    return made.select("custom_id", at("$.method").alias("method"), at("$.body.model").alias("model"), F.get_json_object(at("$.body.input"), "$.name").alias("name"))


def _fmg(spark: SparkSession, rows: DataFrame) -> str:
    """FMG text entries of rows (id, text), in files of about ten thousand."""
    path = _scratch(spark)
    safe = F.replace(F.replace(F.coalesce("text", F.lit("%null%")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    elements = rows.select("id", F.concat(F.lit('<text id="'), F.col("id").cast("string"), F.lit('">'), safe, F.lit("</text>")).alias("x"))
    files = elements.groupBy(F.floor(F.col("id") / 10_000)).agg(F.concat(F.lit("<fmg>"), F.array_join(F.collect_list("x"), ""), F.lit("</fmg>")).alias("value"))
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


_FMG_TEXT = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\\r\\n?', chr(10), 'g'), '[ \\t]*\\n[ \\t]*', chr(10), 'g'), '\\n{{2,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"
)


@query(f"SELECT record_id AS id, {_FMG_TEXT.format('name')} AS text FROM entity_record WHERE name IS NOT NULL AND trim(name) NOT IN ('', '%null%')")
def fmg_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Text entries of a game message file, null texts dropped."""
    return readers.read_fmg_xml(spark, _fmg(spark, table(spark, folder, "entity_record").select(F.col("record_id").alias("id"), F.col("name").alias("text"))))


@query(
    "SELECT s_suppkey AS source_id, s_name AS name, CASE WHEN s_suppkey % 3 <> 0 THEN 'Nation ' || s_nationkey END AS description, 'carian_fmg' AS source, 4 AS source_priority FROM supplier"
)
def fmg_records(spark: SparkSession, folder: str) -> DataFrame:
    """Names with the captions of their ids; a third has none."""
    s = table(spark, folder, "supplier")
    names = readers.read_fmg_xml(spark, _fmg(spark, s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("text"))))
    captions = readers.read_fmg_xml(spark, _fmg(spark, s.where("s_suppkey % 3 != 0").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("text"))))
    return readers.fmg_names(names, captions, "carian_fmg")


@query(
    "WITH n AS (SELECT s_suppkey AS id, s_name FROM supplier), l AS (SELECT o_orderkey, unnest(range(1, length(o_orderkey::VARCHAR) + 1)) AS i FROM orders), "
    "f AS (SELECT o_orderkey, max(id) AS speaker_id FROM l JOIN n ON id = left(o_orderkey::VARCHAR, i)::BIGINT GROUP BY 1) "
    "SELECT o_orderkey AS talk_id, o_orderstatus AS text, speaker_id, s_name AS speaker_name, 'npc:' || coalesce(speaker_id, o_orderkey) AS canonical_id FROM orders LEFT JOIN f USING (o_orderkey) LEFT JOIN n ON n.id = speaker_id"
)
def dialogue_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the speaker whose id theirs begins with."""
    talk = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("text"))
    names = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("text"))
    return readers.dialogue(talk, names).select("talk_id", "text", "speaker_id", "speaker_name", "canonical_id")


def _pages(spark: SparkSession, folder: str, form: str) -> DataFrame:
    """One page per category of the canonical entities: a heading and an element for each of them."""
    e = table(spark, folder, "canonical_entity")
    safe = F.replace(F.replace("name", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("canonical_id", F.format_string(form, safe, F.translate("canonical_id", ":", "_"), safe).alias("x")))), lambda s: s["x"])
    return e.groupBy("category").agg(F.concat(F.lit("<html><script>var a = '<p>no</p>';</script><h2>"), F.col("category"), F.lit("</h2>"), F.array_join(parts, "\n"), F.lit("</html>")).alias("html"))


_SECTION = "CASE " + " ".join(f"WHEN contains(lower(category), '{w}') THEN '{k}'" for w, k in readers.SECTION_CATEGORIES) + " ELSE 'item' END"
_ONE = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"


@query(f"SELECT category AS page, category AS section, {_SECTION} AS category, replace(canonical_id, ':', '_') AS entry_id, {_ONE.format('name')} AS name, 'About ' || {_ONE.format('name')} || '.' || chr(10) || 'More.' AS text FROM canonical_entity")
def html_sections(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of pages of sections."""
    pages = _pages(spark, folder, "<h3>%s [%s]</h3><p>About %s.</p><p>More.</p>").withColumnRenamed("category", "page")
    return readers.html_entries(pages, "page")


@query(f"SELECT category AS page, category AS section, {_ONE.format('name')} AS name, replace(canonical_id, ':', '_') || ' is told of ' || {_ONE.format('name')} AS text FROM canonical_entity")
def html_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Names and texts of two-cell table rows."""
    pages = _pages(spark, folder, "<table><tr><td>%s</td><td>%s is told of %s</td></tr></table>").withColumnRenamed("category", "page")
    return readers.html_pairs(pages, "page")
