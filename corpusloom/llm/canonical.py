"""Mapping free-entered values to a canonical list, by a prefix-filtered set-similarity join.

Distinct values are folded (case, accents, look-alike characters, doubled letters) and cut into words.
A word and a listed name are compared as sets of character pairs. Pairs are ordered by their rarity
over all words; two sets of Jaccard similarity t or more must share one of their rarest pairs, so only
these prefixes are joined, under length and positional filters. Jaccard is then computed exactly, an
alignment of the letters settles which candidates are spellings of the name, and the best is kept.

The joins run on distinct words: a value that holds a tenth or a third of all rows is one word.

Defined cases: null and blank values, and values without a close listed name, are ``unmatched``; ties go
to the smallest canonical id; values and listed names of any length work (sets have at most one element
per position); an empty list leaves all unmatched; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

UNMATCHED = "unmatched"

# Characters typed or scanned for one another, and sounds written in two ways.
_LOOKALIKE = str.maketrans({"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "$": "s", "@": "a", "|": "l", "!": "l"})
_SOUNDS = (("rn", "m"), ("ks", "x"), ("ph", "f"), ("y", "i"), ("c", "k"), ("w", "v"), ("j", "i"), ("q", "k"), ("z", "s"))

#: What takes away from the score of a word: standing as a place or epithet, after another name, being part of a longer word.
PLACED, SECOND, PART = 0.35, 0.1, 0.1

#: Least share of the listed names of several words (and at least two names) in which a word that links the own name to a place or epithet stands.
LINKING = 0.05

#: A word stands before names if it does so in this share of its values, and in so many values at least.
LEADING, LEADING_VALUES = 0.3, 3

_WORD = re.compile(r"[a-z0-9$@|!]+")
_TWICE = re.compile(r"(.)\1+")


def plain(text: str) -> str:
    """Lower case, without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def fold(word: str) -> str:
    """A form shared by common misspellings of a word."""
    word = word.translate(_LOOKALIKE)
    for a, b in _SOUNDS:
        word = word.replace(a, b)
    return _TWICE.sub(r"\1", word)


def own_name(name: str) -> str:
    """The first word of a listed name, plain."""
    parts = re.split(r"[\s,]+", name.strip())
    return plain(parts[0]).translate(_LOOKALIKE) if parts else ""


def name_words(text: str, shortest: int, longest: int, links: frozenset[str] = frozenset()) -> list[tuple[str, bool, str | None, bool]]:
    """(plain word, cut short, the word before it, part of a longer word) of each word that may be the own name.

    shortest, longest: letters of the listed own names. A word long enough to hold two of the shortest may have been run together with
    others: its ends of all such lengths are given too, as are two or three words that together are no longer than a name.
    The word before is null where there is none or a comma parts the two.
    """
    low = plain(text)
    out, end, before = [], 0, None
    found = list(_WORD.finditer(low))
    for m in found:
        word = m.group().translate(_LOOKALIKE)
        rest = low[m.end() :].strip()
        cut = rest[:1] in ("~", ".", "…") and not rest.strip(".~… ")
        held = before if before in links or "," not in low[end : m.start()] else None
        if m.group() not in links and len(word) >= min(4, shortest):
            out.append((word, cut, held, False))
            if len(word) > 2 * shortest:
                out += [(part, False, held, True) for n in range(shortest, min(longest, len(word) - 1) + 1) for part in {word[:n], word[-n:]}]
        before, end = m.group(), m.end()
    if len(found) in (2, 3):
        joined = "".join(m.group() for m in found).translate(_LOOKALIKE)
        if len(joined) <= longest:
            out.append((joined, False, None, False))
    return out


def grams(word: str) -> list[int]:
    """Distinct character pairs of a word, with marks at its ends, each as the number of its two code points."""
    padded = f"^{word}$"
    return sorted({ord(a) << 21 | ord(b) for a, b in zip(padded, padded[1:])})


def distance(a: str, b: str, most: int) -> int:
    """Edits between two words, or ``most`` + 1 if there are more; swapping neighbours counts once."""
    if a == b:
        return 0
    if max(len(a), len(b)) - (Counter(a) & Counter(b)).total() > most:  # letters that one lacks must be edited
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        before, row = row, new
        if min(row) > most and min(before) > most:
            return most + 1
    return min(row[-1], most + 1)


def spelling(word: str, name: str, accept: float = 0.0) -> tuple[float, float]:
    """How surely a word is a way of writing a name, 0 to 1: as it stands, and if it is cut short.

    Scores below ``accept`` may come out as any lower score.
    """
    longest = max(len(word), len(name))
    whole = 1 - distance(word, name, int((1 - accept) * longest)) / longest
    if not 4 <= len(word) < len(name):
        return whole, whole
    begun = 1 - distance(word, name[: len(word)], int((1 - accept) * len(word))) / len(word)
    return max(whole, begun - 0.2), max(whole, begun - 0.05)


def _prefixes(words: DataFrame, rarity: DataFrame, similarity: float) -> DataFrame:
    """Each word with its pairs, rarest first, one row per pair of its prefix: word, size, position, gram, grams."""
    listed = (
        words.select("word", F.explode("grams").alias("gram"))
        .join(rarity, "gram", "left")
        .groupBy("word")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram"))).getField("gram").alias("grams"))
        .withColumn("size", F.size("grams"))
    )
    length = F.col("size") - F.ceil(F.col("size") * similarity) + 1
    return listed.select("word", "size", "grams", F.posexplode(F.slice("grams", F.lit(1), length.cast("int"))).alias("position", "gram"))


def similar_words(left: DataFrame, right: DataFrame, similarity: float) -> DataFrame:
    """Pairs of a left and a right word with Jaccard similarity of their pairs at least ``similarity``.

    left, right: distinct ``word``, ``grams``. Returns left_word, right_word, jaccard. Exact.
    """
    rarity = left.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    a = _prefixes(left, rarity, similarity)
    b = _prefixes(right, rarity, similarity).select(
        F.col("word").alias("right_word"), F.col("size").alias("right_size"), F.col("grams").alias("right_grams"), F.col("position").alias("right_position"), "gram"
    )
    need = F.ceil((F.col("size") + F.col("right_size")) * (similarity / (1 + similarity)))
    # if this is the first pair that two sets share, what follows on the shorter side bounds all they share
    most = F.lit(1) + F.least(F.col("size") - F.col("position"), F.col("right_size") - F.col("right_position")) - 1
    pairs = a.join(b, "gram").where(
        (F.col("right_size") >= F.col("size") * similarity) & (F.col("size") >= F.col("right_size") * similarity) & (most >= need)
    )
    shared = pairs.withColumn("shared", F.array_intersect("grams", "right_grams")).where(F.element_at("shared", 1) == F.col("gram"))
    exact = F.size("shared") / (F.col("size") + F.col("right_size") - F.size("shared"))
    return shared.select(F.col("word").alias("left_word"), "right_word", exact.alias("jaccard")).where(F.col("jaccard") >= similarity)


def match_names(values: DataFrame, listed: DataFrame, value: str = "raw_id", accept: float = 0.7, similarity: float = 0.25) -> DataFrame:
    """Distinct values with the listed entity they spell: value, canonical_id, confidence; values without one are left out.

    listed: canonical_id, name. A word after one that links names to places or epithets in the list ("of", "the") hardly counts; a second
    name and a part of a word must be closer. Links, lengths of names and the words that stand before names are taken from the whole tables.
    """
    def cut_names(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(i, w, grams(fold(w)), [m.group() for m in _WORD.finditer(plain(n))][1:]) for i, n in zip(f["canonical_id"], f["name"]) if (w := own_name(n))]
            yield pd.DataFrame(rows, columns=["canonical_id", "own", "grams", "others"])

    names = listed.where(F.col("canonical_id").isNotNull() & F.col("name").isNotNull()).select("canonical_id", "name").mapInPandas(
        cut_names, "canonical_id string, own string, grams array<bigint>, others array<string>"
    )
    names = checkpointed(names)
    sizes = names.agg(F.min(F.length("own")).alias("low"), F.max(F.length("own")).alias("high"), F.count_if(F.size("others") > 0).alias("several")).first()
    shortest, longest = sizes["low"] or 1, sizes["high"] or 1
    # words in a share of all names: there are at most as many as a name has words, over that share
    common = names.select(F.explode(F.array_distinct("others")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(2.0, LINKING * sizes["several"]))
    links = frozenset(r["w"] for r in common.select("w").collect())

    def cut_values(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(v, w, c, b, p, grams(fold(w))) for v in f["v"] for w, c, b, p in name_words(v, shortest, longest, links)]
            yield pd.DataFrame(rows, columns=["v", "word", "cut", "before", "part", "grams"])

    distinct = values.where(F.col(value).isNotNull() & (F.trim(value) != "")).select(F.col(value).alias("v")).distinct()
    words = distinct.mapInPandas(cut_values, "v string, word string, cut boolean, before string, part boolean, grams array<bigint>")
    words = checkpointed(words)
    left = words.groupBy("word").agg(F.first("grams").alias("grams"))
    right = names.groupBy(F.col("own").alias("word")).agg(F.first("grams").alias("grams"))
    pairs = similar_words(left, right, similarity)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            sure = [tuple(map(max, spelling(w, n, accept), spelling(fold(w), fold(n), accept))) for w, n in zip(f["left_word"], f["right_word"])]
            yield pd.DataFrame({"word": f["left_word"], "own": f["right_word"], "whole": [a for a, _ in sure], "short": [b for _, b in sure]})

    # few bytes but much work a pair: by number, so that adaptive planning doesn't gather them in one task
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scored = pairs.repartition(tasks).mapInPandas(score, "word string, own string, whole double, short double").where(F.greatest("whole", "short") >= accept)
    ids = names.groupBy("own").agg(F.min("canonical_id").alias("canonical_id"))
    # words that stand before a listed name as a rule, as titles and kinds do, don't make what follows a second name
    owned = words.where("before IS NOT NULL AND NOT part").join(ids.select(F.col("own").alias("word"), F.lit(1).alias("is_name")).hint("merge"), "word", "left")
    counted = owned.groupBy("before").agg(F.count(F.lit(1)).alias("n"), F.count("is_name").alias("named"))
    leading = counted.where((F.col("named") >= LEADING_VALUES) & (F.col("named") >= LEADING * F.col("n"))).select("before", F.lit(True).alias("leads"))
    found = words.drop("grams").join(scored.hint("merge"), "word").join(ids.hint("merge"), "own").join(leading.hint("merge"), "before", "left")
    off = F.when(F.col("before").isin(*links), PLACED).when(F.col("before").isNotNull() & F.col("leads").isNull(), SECOND).otherwise(0.0)
    off = off + F.when(F.col("part"), PART).otherwise(0.0)
    sure = F.when(F.col("cut"), F.col("short")).otherwise(F.col("whole")) - off
    best = found.withColumn("sure", F.round(sure, 4)).where(F.col("sure") >= accept).groupBy("v").agg(F.min(F.struct((-F.col("sure")).alias("s"), "canonical_id")).alias("b"))
    return best.select(F.col("v").alias(value), F.col("b.canonical_id").alias("canonical_id"), (-F.col("b.s")).alias("confidence"))


def match_patterns(values: DataFrame, patterns: DataFrame, form: str) -> DataFrame:
    """Distinct ``form`` values with the pattern that is most specific: form, canonical_id, confidence.

    patterns: raw_id with * and ?, canonical_id, confidence. Of several that match: fewest wildcards, then
    longest, then smallest. The pattern table is joined by its literal beginning (what stands before the first
    wildcard), so values meet only patterns that begin like them.
    """
    literal = F.regexp_extract("raw_id", r"^[^*?]*", 0)
    regex = F.concat(F.lit("(?s)^"), F.replace(F.replace(F.regexp_replace("raw_id", r"([^A-Za-z0-9_*?])", r"\\$1"), F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))
    known = patterns.where(F.col("raw_id").isNotNull()).select(
        F.col("raw_id").alias("pattern"), "canonical_id", F.col("confidence").alias("c"), literal.alias("begin"), regex.alias("regex"),
        F.length(F.regexp_replace("raw_id", "[^*?]", "")).alias("wild"),
    )
    lengths = F.sequence(F.lit(0), F.length(form))
    begun = values.select(form).distinct().select(form, F.explode(lengths).alias("n")).select(form, F.substring(F.col(form), F.lit(1), F.col("n")).alias("begin"))
    hit = begun.join(known, "begin").where(F.rlike(F.col(form), F.col("regex")))
    best = hit.groupBy(form).agg(F.min(F.struct("wild", (-F.length("pattern")).alias("l"), "pattern", "canonical_id", "c")).alias("b"))
    return best.select(form, F.col("b.canonical_id").alias("canonical_id"), F.col("b.c").alias("confidence"))


def map_aliases(aliases: DataFrame, listed: DataFrame, patterns: DataFrame, speaker: str = "npc:carian_speaker_", accept: float = 0.7) -> DataFrame:
    """The open rows of an alias table with the entity each means: alias_id, canonical_id or ``unmatched``, confidence."""
    is_open = aliases.where(F.col("canonical_id").isNull()).select("alias_id", "raw_id")
    form = F.lower(F.regexp_replace("raw_id", r"^\s+|\s+$", ""))
    coded = form.startswith(speaker)
    distinct = is_open.where(F.col("raw_id").isNotNull()).select("raw_id").distinct().withColumn("form", form)
    codes = match_patterns(distinct.where(coded), patterns, "form")
    by_code = distinct.where(coded).join(codes, "form").select("raw_id", "canonical_id", "confidence")
    by_name = match_names(distinct.where(~coded), listed, "raw_id", accept)
    found = by_code.unionByName(by_name)
    return is_open.join(found, "raw_id", "left").select("alias_id", F.coalesce("canonical_id", F.lit(UNMATCHED)).alias("canonical_id"), "confidence")
