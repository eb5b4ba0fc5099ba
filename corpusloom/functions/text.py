"""Text functions as Column expressions: names, slugs, hashes, lore text, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slug(text: Column | str) -> Column:
    """URL form: lower case, only Unicode word characters, runs of space and hyphen as one underscore."""
    kept = F.regexp_replace(F.lower(_c(text)), r"(?U)[^\w\s-]", "")
    return F.regexp_replace(F.regexp_replace(kept, r"(?U)[-\s]+", "_"), "^_+|_+$", "")


def match_name(text: Column | str) -> Column:
    """Name for matching: lower case, ASCII letters and digits, single spaces."""
    kept = F.regexp_replace(F.lower(_c(text)), r"[^a-z0-9\s]", "")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def joined_hash(*parts: Column | str, sep: str = "|") -> Column:
    """sha256 of the parts joined; null parts as empty text."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts]), 256)


def chunk_hash(entity_type: Column | str, entity_id: Column | str, name: Column | str, text: Column | str) -> Column:
    """Content hash of a corpus chunk."""
    return joined_hash(entity_type, entity_id, name, text, sep=":")


def signature(dataset: str | Column, *parts: Column | str) -> Column:
    """Incremental signature of a record: dataset and identifying parts."""
    first = F.lit(dataset) if isinstance(dataset, str) else dataset
    return joined_hash(first, *parts)


def lore_id(canonical_id: Column | str, text_type: Column | str, text: Column | str) -> Column:
    """Stable id of a line: first 16 hex digits of its hash."""
    return F.substring(joined_hash(canonical_id, text_type, text), 1, 16)


def lore_text(text: Column | str) -> Column:
    """Line text: LF line ends, single spaces and line breaks, trimmed; null as empty."""
    t = F.replace(F.replace(F.coalesce(_c(text), F.lit("")), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return trim_space(F.regexp_replace(F.regexp_replace(t, "[ \t]+", " "), "\n{2,}", "\n"))


def trim_space(text: Column | str) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(_c(text), r"^\s+|\s+$", "")


def collapse_blank_lines(text: Column | str) -> Column:
    """Lines trimmed, several line ends in a row as one blank line."""
    t = F.regexp_replace(F.regexp_replace(_c(text), "\r\n?", "\n"), "[ \t]*\n[ \t]*", "\n")
    return trim_space(F.regexp_replace(t, "\n{2,}", "\n\n"))


def query_text(text: Column | str) -> Column:
    """Text for comparing results: straight quotes and dashes, single spaces, lower case."""
    straight = F.translate(_c(text), "‘’“”–—", "''\"\"--")
    return F.lower(trim_space(F.regexp_replace(straight, r"\s+", " ")))


def quote_text(text: Column | str) -> Column:
    """Text for finding quotes: lower case, single spaces."""
    return F.lower(trim_space(F.regexp_replace(_c(text), r"\s+", " ")))


def section(text_type: Column | str, content: Column | str) -> Column:
    """Labelled section; empty content gives empty text."""
    body = trim_space(content)
    label = F.initcap(F.replace(_c(text_type), F.lit("_"), F.lit(" ")))
    label = F.when(label == "", "Text").otherwise(label)
    return F.when(body == "", "").otherwise(F.concat(label, F.lit(":\n"), body))


def scale_block(text: Column | str, weight: Column | float) -> Column:
    """Text repeated by weight: whole copies, then the leading share of its words that is left (at least one word).

    The share is what repeated subtraction of 1 leaves in double arithmetic.
    """
    w = F.greatest(weight if isinstance(weight, Column) else F.lit(float(weight)), F.lit(0.0)).cast("double")
    body = trim_space(text)
    words = F.split(body, r"\s+")
    left = F.aggregate(F.sequence(F.lit(1), F.greatest(F.floor(w).cast("int"), F.lit(1))), w, lambda acc, _: F.when(acc >= 1.0, acc - 1.0).otherwise(acc))
    part = F.when(left > 0, F.array_join(F.slice(words, F.lit(1), F.greatest(F.lit(1), F.floor(F.size(words) * left).cast("int"))), " "))
    whole = F.when(w >= 1.0, F.array_repeat(body, F.floor(w).cast("int"))).otherwise(F.array().cast("array<string>"))
    return F.when((body == "") | (w == 0.0), "").otherwise(F.array_join(F.array_compact(F.concat(whole, F.array(part))), "\n\n"))


def listed(items: Column | str) -> Column:
    """Array as prose: "a", "a and b", "a, b and c"."""
    a = _c(items)
    n = F.size(a)
    head = F.array_join(F.slice(a, F.lit(1), F.greatest(n - 1, F.lit(0))), ", ")
    return F.when(n <= 0, "").when(n == 1, F.element_at(a, 1)).otherwise(F.concat(head, F.lit(" and "), F.try_element_at(a, F.lit(-1))))


def any_keyword(text: Column | str, keywords: list[str], whole_words: bool = False) -> Column:
    """Whether a text holds one of the keywords, without case; as substrings unless ``whole_words``."""
    words = sorted({k.strip().lower() for k in keywords if k and k.strip()})
    if not words:
        return F.lit(False)
    bodies = [f"\\Q{w}\\E" for w in words]
    pattern = "|".join(f"\\b{b}\\b" if whole_words else b for b in bodies)
    return F.coalesce(_c(text).rlike(f"(?iu){pattern}"), F.lit(False))


def handle_ok(text: Column | str) -> Column:
    """Whether a contributor handle is well formed: 2 to 39 of a-z, 0-9, underscore, hyphen."""
    return F.coalesce(_c(text).rlike("^[a-z0-9_-]{2,39}$"), F.lit(False))


def snake_name(name: str) -> str:
    """Column name: spaces and hyphens as underscores, camel case split, lower case."""
    import re

    spaced = re.sub(r"[\s\-]+", "_", name.strip())
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", spaced).lower()


def plain_column_name(name: str) -> str:
    """Column name: lower case, punctuation dropped, spaces as underscores."""
    import re

    return re.sub(r"\s+", "_", re.sub(r"[^\w\s]", "", name.strip().lower()))
