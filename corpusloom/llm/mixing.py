"""Mixing sources to target weights: each source contributes its share of all tokens, or as near as its repeats allow.

1. Documents are counted by source and exact token length (one aggregate; a few numbers per length).
2. The budget: the largest total at which every source that has documents reaches its share, its
   documents used up to ``max_repeat`` times; or a given total, of which a short source gives what it can.
3. Each source first uses all its documents as many times as fit in its share. For what remains, lengths are
   taken in proportion, and the last stretch is fitted exactly by bounded-knapsack dynamic programming
   over the lengths left (subset sums as bits of one integer).
4. Documents are picked by a seeded hash: so many of each length as the fit says. A length that many
   documents have isn't sorted in one task: hashes fall in bands, whole bands are taken by their counts, and only
   the one band where the count is reached is ranked.

Defined cases: documents of sources without target, or without source, take no part; a target source
without documents has share 0 and the others' shares are of what there is; null and empty texts have no tokens and
are used 0 times; weights that are null or not positive give nothing; equal hashes are broken by key; empty
tables give no rows; max_repeat below 1 or null uses nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .encode import FOLDER, count_tokens

#: Tokens fitted by dynamic programming; what a proportional pick leaves is brought below by adding long documents.
STRETCH = 1 << 17

#: Bands of the selection hash.
BANDS = 1024


@dataclass(frozen=True)
class Target:
    """What one source has and is to give."""

    source: str
    weight: float
    max_repeat: int
    available: int


def budgets(targets: list[Target], total: int | None = None) -> dict[str, int]:
    """Tokens each source is to give."""
    able = [t for t in targets if t.weight > 0 and t.available > 0 and t.max_repeat > 0]
    if not able:
        return {t.source: 0 for t in targets}
    if total is None:
        scale = min(t.available * t.max_repeat / t.weight for t in able)
    else:
        scale = total / math.fsum(t.weight for t in able)
    return {t.source: min(int(scale * t.weight + 1e-6), t.available * t.max_repeat) if t in able else 0 for t in targets}


def fit(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take (at most ``counts``) for a token sum as near ``budget`` from below as can be.

    Exact over the choices left to the last stretch.
    """
    have = sum(n * length for length, n in counts.items())
    if budget >= have:
        return dict(counts)
    share = budget / have if have else 0.0
    taken = {length: int(n * share) for length, n in counts.items()}
    left = budget - sum(n * length for length, n in taken.items())
    for length in sorted(counts, reverse=True):
        if left <= STRETCH:
            break
        more = min(counts[length] - taken[length], (left - STRETCH) // length)
        taken[length] += more
        left -= more * length
    # subset sums of what remains, each length's number split in powers of two
    mask, sums, parts = (1 << (left + 1)) - 1, 1, []
    for length in sorted(counts):
        free, size = min(counts[length] - taken[length], left // length), 1
        while free > 0:
            use = min(size, free)
            parts.append((length, use, sums))
            sums |= (sums << (length * use)) & mask
            free, size = free - use, size * 2
            if sums >> left:
                break
        if sums >> left:
            break
    at = sums.bit_length() - 1
    for length, use, before in reversed(parts):
        if not before >> at & 1:
            taken[length] += use
            at -= length * use
    return taken


def plan(counted: DataFrame, targets: DataFrame, total: int | None = None) -> list[tuple[str, int, dict[int, int]]]:
    """For each target source: full uses of all its documents, and documents more of each length. Lengths by source are small data."""
    goals = {r["source"]: r for r in targets.where("source IS NOT NULL").collect()}
    rows = counted.where("n_tokens > 0").groupBy("source", "n_tokens").count().collect()
    by_source: dict[str, dict[int, int]] = {s: {} for s in goals}
    for r in rows:
        by_source[r["source"]][r["n_tokens"]] = r["count"]
    ask = [
        Target(s, g["target_weight"] or 0.0, g["max_repeat"] or 0, sum(k * n for k, n in by_source[s].items())) for s, g in sorted(goals.items())
    ]
    give = budgets(ask, total)
    out = []
    for t in ask:
        full = min(give[t.source] // t.available, t.max_repeat) if t.available else 0
        rest = give[t.source] - full * t.available if full < t.max_repeat else 0
        out.append((t.source, full, {k: n for k, n in fit(by_source[t.source], rest).items() if n} if rest else {}))
    return out


def select(documents: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, total: int | None = None, folder: str = FOLDER) -> DataFrame:
    """Documents used: key, source, n_tokens, times (at least 1)."""
    spark = documents.sparkSession
    wanted = documents.select(F.col(key).cast("long").alias(key), "source", text).join(targets.select("source").where("source IS NOT NULL").distinct(), "source", "left_semi")
    counted = checkpointed(count_tokens(wanted, text, folder=folder))
    chosen = plan(counted, targets, total)
    full = spark.createDataFrame([(s, f) for s, f, _ in chosen] or [], "source string, full int")
    extra = spark.createDataFrame([(s, k, n) for s, _, more in chosen for k, n in more.items()], "source string, n_tokens long, more long")
    hashed = counted.where("n_tokens > 0").withColumn("h", F.xxhash64(F.lit(seed), F.col(key))).withColumn("band", F.pmod("h", F.lit(BANDS)).cast("int"))
    asked = hashed.join(F.broadcast(extra), ["source", "n_tokens"])
    bands = asked.groupBy("source", "n_tokens", "more", "band").count()
    run = Window.partitionBy("source", "n_tokens").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    starts = bands.withColumn("before", F.coalesce(F.sum("count").over(run), F.lit(0))).where("before < more")
    whole = starts.where("before + count <= more").select("source", "n_tokens", "band")
    edge = starts.where("before + count > more").select("source", "n_tokens", "band", (F.col("more") - F.col("before")).alias("need"))
    at = ["source", "n_tokens", "band"]
    ranked = asked.join(edge, at).withColumn("r", F.row_number().over(Window.partitionBy(*at).orderBy("h", key))).where("r <= need")
    picked = asked.join(whole, at, "left_semi").select(key).unionByName(ranked.select(key)).withColumn("again", F.lit(1))
    used = counted.where("n_tokens > 0").join(F.broadcast(full), "source").join(picked, key, "left")
    times = (F.col("full") + F.coalesce("again", F.lit(0))).cast("int")
    return used.select(key, "source", "n_tokens", times.alias("times")).where("times > 0")


def shares(selected: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: target_weight, max_repeat, n_documents, n_uses, n_tokens (times uses), actual_share."""
    used = selected.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_documents"), F.sum("times").alias("n_uses"), F.sum(F.col("n_tokens") * F.col("times")).alias("n_tokens"), F.max("times").alias("most_uses")
    )
    joined = targets.where("source IS NOT NULL").join(used, "source", "left").fillna(0, ["n_documents", "n_uses", "n_tokens", "most_uses"])
    total = F.sum("n_tokens").over(Window.partitionBy())  # a row per target source
    return joined.withColumn("actual_share", F.when(total > 0, F.round(F.col("n_tokens") / total, 6)).otherwise(0.0))


def repeated(selected: DataFrame, documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The mixed corpus: each used document as often as it is used, with copy_no from 1."""

    copies = selected.select(key, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy_no"))
    return copies.join(documents.select(F.col(key).cast("long").alias(key), "source", text), key)


