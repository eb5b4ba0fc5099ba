"""Readers: CSV, JSON envelopes, Parquet, FMG XML, HTML dumps, YAML bundles and taxonomies, alias tables, JSONL answers."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators.motifs import Motif
from ..session import listed, there

DELIMITERS = (",", "\t", "|", ";")


def read_csv(spark: SparkSession, path: str | list[str], sep: str = ",", lines: bool = False) -> DataFrame:
    """CSV with a header, all columns as text. Quoted line breaks are allowed, which makes each file one task, unless ``lines``: then large files are split."""
    return spark.read.csv(path, header=True, inferSchema=False, sep=sep, multiLine=not lines, escape='"')


def read_csv_tree(spark: SparkSession, folder: str, lines: bool = False) -> DataFrame:
    """All CSV files below a folder of one layout, with table_name (the file's stem) of each row; ``lines`` as in read_csv."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    df = reader.csv(folder, header=True, inferSchema=False, multiLine=not lines, escape='"')
    return df.withColumn("table_name", F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", ""))


def sniff_delimiter(spark: SparkSession, path: str, lines: int = 10) -> str:
    """The delimiter that occurs most in the first lines; a comma if none does."""
    head = [r["value"] for r in spark.read.text(path).limit(lines).collect()]
    counts = {d: sum(x.count(d) for x in head) for d in DELIMITERS}
    best = max(DELIMITERS, key=lambda d: counts[d])
    return best if counts[best] else ","


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """A data file by its suffix: csv (delimiter sniffed), json (one document or lines), jsonl, parquet."""
    suffix = Path(path).suffix.lower()
    if suffix in (".csv", ".tsv", ".txt"):
        return read_csv(spark, path, sniff_delimiter(spark, path))
    if suffix == ".json":
        return spark.read.json(path, multiLine=True)
    if suffix in (".jsonl", ".ndjson"):
        return spark.read.json(path)
    if suffix == ".parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown kind of file: {path}")


def read_table(spark: SparkSession, parquet: str, csv: str) -> DataFrame:
    """A Parquet table, or the CSV one where there is none (all columns as text then)."""
    return spark.read.parquet(parquet) if there(spark, parquet) else read_csv(spark, csv)


def data_files(folder: str, spark: SparkSession | None = None) -> list[str]:
    """Data files of a folder: csv, json, parquet, sorted. With a session also of a cluster's storage."""
    found = listed(spark, folder) if spark else [str(p) for p in Path(folder).iterdir()]
    return sorted(p for p in found if p.lower().endswith((".csv", ".json", ".parquet")))


def existing(candidates: list[str], spark: SparkSession | None = None) -> str | None:
    """First candidate that exists; with a session also on a cluster's storage."""
    return next((c for c in candidates if (there(spark, c) if spark else Path(c).exists())), None)


def best_language_path(paths: list[str]) -> str | None:
    """Of several files the English one (a folder eng or en), then the first by name."""
    def rank(p: str) -> tuple[int, str]:
        parts = [x.lower() for x in Path(p).parts]
        return (0 if any("eng" in x for x in parts) else 1 if "en" in parts else 2, p)

    return min(paths, key=rank) if paths else None


def envelope(df: DataFrame, item_schema: str, body: str = "body", keep: list[str] | None = None) -> DataFrame:
    """Items of JSON envelopes {source, data: [...]} in a text column: keep, api_source, item_no and the item's fields.

    Entries that aren't objects are dropped; bodies without a data list give nothing.
    """
    keep = keep or []
    fields = ", ".join(f"`{n}` {t}" for n, t in (p.strip().split(" ", 1) for p in item_schema.split(",")))
    doc = F.from_json(F.col(body), "source string, data array<string>")
    items = df.select(*keep, doc["source"].alias("api_source"), F.posexplode(doc["data"]).alias("item_no", "_item"))
    parsed = items.where(F.col("_item").startswith("{")).withColumn("_item", F.from_json("_item", fields))
    return parsed.select(*keep, "api_source", "item_no", "_item.*")


def read_fmg_xml(spark: SparkSession, path: str) -> DataFrame:
    """Text entries of FMG XML: id (long), text (lines trimmed). %null%, blank texts and ids that are no number are dropped; of one id the last stands."""
    raw = spark.read.format("xml").option("rowTag", "text").option("attributePrefix", "_").option("valueTag", "_VALUE").schema("_id string, _VALUE string").load(path)
    rows = raw.select(F.col("_id").try_cast("long").alias("id"), T.collapse_blank_lines("_VALUE").alias("text"), F.monotonically_increasing_id().alias("_o"))
    good = rows.where(F.col("id").isNotNull() & (F.col("text") != "") & (F.lower("text") != "%null%"))
    return good.groupBy("id").agg(F.max_by("text", "_o").alias("text"))


def fmg_names(names: DataFrame, captions: DataFrame, source: str, priority: int = 4) -> DataFrame:
    """Names with their captions as records: source_id, name, description, source, source_priority."""
    joined = names.select("id", F.col("text").alias("name")).join(captions.select("id", F.col("text").alias("description")), "id", "left")
    return joined.select(F.col("id").alias("source_id"), "name", "description", F.lit(source).alias("source"), F.lit(priority).alias("source_priority"))


def dialogue(talk: DataFrame, names: DataFrame) -> DataFrame:
    """Talk lines with their speaker, found by shortening the talk id digit by digit: talk_id, text, speaker_id, speaker_name, canonical_id."""
    from ..operators.reconcile import prefix_ancestor

    lines = talk.select(F.col("id").alias("talk_id"), "text")
    found = prefix_ancestor(lines, names.select(F.col("id").alias("speaker_id")), "talk_id", "speaker_id")
    named = found.join(names.select(F.col("id").alias("speaker_id"), F.col("text").alias("speaker_name")), "speaker_id", "left")
    return named.withColumn("canonical_id", F.concat(F.lit("npc:"), F.coalesce("speaker_id", "talk_id").cast("string")))


class _Blocks(HTMLParser):
    """Text of headings, paragraphs, table cells and definition terms, in order: (tag, text)."""

    KEPT = ("h1", "h2", "h3", "h4", "h5", "h6", "p", "td", "th", "tr", "dt", "dd")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, str]] = []
        self.open: str | None = None
        self.parts: list[str] = []
        self.skip = 0

    def _close(self) -> None:
        if self.open is not None:
            body = " ".join("".join(self.parts).split())
            if body or self.open == "tr":
                self.out.append((self.open, body))
        self.open, self.parts = None, []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "br":
            self.parts.append(" ")
        elif tag in self.KEPT:
            self._close()
            self.open = tag
            if tag == "tr":
                self.out.append(("tr", ""))
                self.open = None

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag == self.open:
            self._close()

    def handle_data(self, data: str) -> None:
        if self.open is not None and not self.skip:
            self.parts.append(data)


def html_blocks(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Blocks of HTML pages: page_id, pos, tag, text. Scripts and styles have no text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, h in zip(f["k"], f["h"]):
                parser = _Blocks()
                parser.feed(h or "")
                parser.close()
                parser._close()
                rows += [(k, i, t, x) for i, (t, x) in enumerate(parser.out)]
            yield pd.DataFrame(rows, columns=["k", "pos", "tag", "text"])

    kind = dict(pages.dtypes)[page_id]
    return pages.select(F.col(page_id).alias("k"), F.col(html).alias("h")).mapInPandas(run, f"k {kind}, pos int, tag string, text string").withColumnRenamed("k", page_id)


# Words of a section heading and the category of its entries, the first that occurs deciding.
SECTION_CATEGORIES = (("weapon", "weapon"), ("protector", "armor"), ("armor", "armor"), ("magic", "spell"), ("spell", "spell"), ("goods", "item"), ("accessory", "item"), ("gem", "item"), ("npc", "npc"), ("talk", "npc"))


def html_entries(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Entries of an HTML dump: h2 begins a section, h3 "Name [id]" an entry (also a paragraph "[id] Name"), paragraphs are its text.

    Returns page_id, section, category, entry_id, name, text (paragraphs by line). Each entry of each section is kept.
    """
    blocks = html_blocks(pages, page_id, html).where(F.col("tag").isin("h2", "h3", "p"))
    headed = F.regexp_extract("text", r"^(.*?)\s*\[(\w+)\]\s*$", 1)
    leading = r"^\[(\w+)\]\s+(.+)$"
    starts = (F.col("tag") == "h3") | ((F.col("tag") == "p") & F.col("text").rlike(leading))
    w = Window.partitionBy(page_id).orderBy("pos")
    marked = (
        blocks.withColumn("section", F.last(F.when(F.col("tag") == "h2", F.col("text")), ignorenulls=True).over(w))
        .withColumn("entry_no", F.sum(F.when(starts | (F.col("tag") == "h2"), 1).otherwise(0)).over(w))
        .withColumn("start", starts)
        .where(F.col("tag") != "h2")
    )
    name = F.when(F.col("tag") == "p", F.regexp_extract("text", leading, 2)).when(headed != "", headed).otherwise(F.col("text"))
    number = F.when(F.col("tag") == "p", F.regexp_extract("text", leading, 1)).otherwise(F.nullif(F.regexp_extract("text", r"\[(\w+)\]\s*$", 1), F.lit("")))
    entries = marked.groupBy(page_id, "entry_no").agg(
        F.max("section").alias("section"),
        F.max(F.when(F.col("start"), name)).alias("name"),
        F.max(F.when(F.col("start"), number)).alias("entry_id"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("start"), F.struct("pos", "text")))), lambda x: x["text"]), "\n").alias("text"),
    )
    category = F
    for word, kind in SECTION_CATEGORIES:
        category = category.when(F.contains(F.lower("section"), F.lit(word)), kind)
    return entries.where(F.col("name").isNotNull() & (F.col("text") != "")).select(page_id, "section", category.otherwise("item").alias("category"), "entry_id", "name", "text")


def html_pairs(pages: DataFrame, page_id: str = "page_id", html: str = "html", least: int = 10) -> DataFrame:
    """Name and text pairs of HTML: two-cell table rows, definition lists, h4 to h6 with the next paragraph. Texts over ``least`` characters.

    Returns page_id, section (the h1 to h3 before), name, text.
    """
    blocks = html_blocks(pages, page_id, html)
    w = Window.partitionBy(page_id).orderBy("pos")
    nxt = blocks.withColumn("next_tag", F.lead("tag").over(w)).withColumn("next_text", F.lead("text").over(w))
    nxt = nxt.withColumn("before", F.lag("tag").over(w)).withColumn("after", F.coalesce(F.lead("tag", 2).over(w), F.lit("")))
    nxt = nxt.withColumn("section", F.last(F.when(F.col("tag").isin("h1", "h2", "h3"), F.col("text")), ignorenulls=True).over(w))
    follows = (
        (F.col("tag").isin("td", "th") & (F.col("next_tag") == "td") & (F.col("before") == "tr") & ~F.col("after").isin("td", "th"))
        | ((F.col("tag") == "dt") & (F.col("next_tag") == "dd"))
        | (F.col("tag").isin("h4", "h5", "h6") & (F.col("next_tag") == "p"))
    )
    pairs = nxt.where(follows & (F.col("text") != "") & (F.length("next_text") > least))
    return pairs.select(page_id, "section", F.col("text").alias("name"), F.col("next_text").alias("text"))


def motifs_from_yaml(path: str) -> list[Motif]:
    """Motifs of a taxonomy file: categories with motifs (slug, label, synonyms, narrative_signals, canonical_examples)."""
    import yaml

    with Path(path).open() as f:
        doc = yaml.safe_load(f)
    out = []
    for c in doc.get("categories", []):
        for m in c.get("motifs", []):
            words = [m.get("label", ""), *m.get("synonyms", []), *m.get("narrative_signals", [])]
            out.append(Motif(m["slug"], m.get("label", m["slug"]), c.get("slug", ""), c.get("label", ""), tuple(w for w in words if w), tuple(m.get("canonical_examples", []))))
    return out


def weights_from_yaml(path: str, defaults: dict[str, float]) -> dict[str, float]:
    """Weights of text types, lower-cased and laid over the defaults; anything but numbers is refused."""
    import yaml

    with Path(path).open() as f:
        doc = yaml.safe_load(f) or {}
    if not isinstance(doc, dict):
        raise ValueError("weights are a mapping of text type to number")
    for k, v in doc.items():
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            raise ValueError(f"weight of {k} is no number: {v!r}")
    return {**defaults, **{str(k).strip().lower(): float(v) for k, v in doc.items()}}


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Annotation bundles (**/bundle.yml): path, bundle_id, operation, updated_at, annotation_id, checksum, annotation (JSON), revisions (JSON array)."""
    import yaml  # noqa: F401  the tasks need it too

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import json

        import yaml

        for f in frames:
            rows = []
            for path, content in zip(f["path"], f["content"]):
                doc = yaml.safe_load(bytes(content).decode()) or {}
                head, note = doc.get("bundle", {}), doc.get("annotation", {})
                text = json.dumps({k: doc.get(k) for k in ("annotation", "revisions")}, sort_keys=True, default=str, ensure_ascii=False)
                rows.append((path, str(head.get("id", "")), str(head.get("operation", "upsert")), str(head.get("updated_at", "")), str(note.get("id", head.get("id", ""))), hashlib.sha256(text.encode()).hexdigest(), json.dumps(note, default=str, sort_keys=True), json.dumps(doc.get("revisions", []), default=str, sort_keys=True)))
            yield pd.DataFrame(rows, columns=["path", "bundle_id", "operation", "updated_at", "annotation_id", "checksum", "annotation", "revisions"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "bundle.yml").load(folder)
    rows = files.select("path", "content").mapInPandas(run, "path string, bundle_id string, operation string, updated_at string, annotation_id string, checksum string, annotation string, revisions string")
    return rows.withColumn("updated_at", V.iso_time("updated_at"))


#: Names that the columns of an alias table may have, best first.
ALIAS_COLUMNS = {"raw_id": ("raw_id", "raw_canonical_id", "alias", "from"), "canonical_id": ("canonical_id", "canonical", "target", "to")}


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Alias table of any kind of file: raw_id, canonical_id; blank ids dropped, of one raw id the last row stands."""
    df = read_any(spark, path)
    named = {want: next((c for c in names if c in df.columns), None) for want, names in ALIAS_COLUMNS.items()}
    if None in named.values():
        raise ValueError(f"no alias columns in {df.columns}")
    rows = df.select(*[F.trim(F.col(c).cast("string")).alias(want) for want, c in named.items()], F.monotonically_increasing_id().alias("_o"))
    return rows.where("raw_id != '' AND canonical_id != ''").groupBy("raw_id").agg(F.max_by("canonical_id", "_o").alias("canonical_id"))


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Batch answers (JSON lines): custom_id, answer (the text's JSON object, or null), ok. Blank lines are skipped; broken ones are failures.

    The answer stands under response.output, response.body.output, or response.body.choices.
    """
    raw = spark.read.text(path).where(F.trim("value") != "")
    doc = F.try_parse_json("value")
    at = lambda p: F.try_variant_get(doc, p, "string")
    text = F.coalesce(at("$.response.output[0].content[0].text"), at("$.response.body.output[0].content[0].text"), at("$.response.body.choices[0].message.content"))
    parsed = raw.select(at("$.custom_id").alias("custom_id"), V.repaired_json(text).alias("answer"))
    return parsed.withColumn("ok", F.col("custom_id").isNotNull() & F.col("answer").isNotNull())


def answer_diagnostics(answers: DataFrame, reasons: str | None = None) -> DataFrame:
    """Successes and failures of answers."""
    return answers.agg(F.count_if("ok").alias("successes"), F.count_if(~F.col("ok")).alias("failures"))


