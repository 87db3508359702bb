"""Mixing of sources to target weights by temperature (operator 5, DataFrame functions only).

The token shares p of the sources are raised to one exponent and normalised: weight = p^a / sum(p^a). The exponent is
bisected in [0, 1] to the smallest value, the flattest mixture, whose entropy is at most ``entropy`` and under which no
source is repeated more than ``most_repeats`` times. The budget in tokens then gives each source its number of passes;
without a budget it is the smallest one under which every document appears at least once. Whole passes take every
document, the last one those that come first in its permutation, as far as the source's quota reaches and never beyond.

Each pass of a source is a permutation by hash. Copies get a place in [0, 1): (pass + rank in the pass) / passes, so that
every stretch of places, and every one of the equal ``block``s, holds the sources in their weights. The rank is the hash
itself, which needs no ordering of a source. The place where the last pass ends is found by three rounds of token sums
over 4096 ranges of hashes each, so a source may hold any share of the rows.

Cases: a null source is a source of its own, and null or empty texts have no tokens; a source without tokens has weight 0
and one pass. Rows that repeat a doc_id share their ranks. A table without tokens passes once, unchanged. An empty table
gives no rows. All columns are kept as they are; ``copies`` puts underscores in front of the name of an input column that is
called like one of the columns it adds, until the name is free.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import small, stage

LEVELS_AT_ONCE, STEPS = 5, 8
DIGIT_BITS, DIGITS = 12, 3


@dataclass
class Mixture:
    """``sources``: _mix_source, _mix_tokens, _mix_weight, _mix_passes, _mix_full, _mix_below, one row for each source."""

    exponent: float
    budget: float
    sources: DataFrame


def n_tokens(text: str):
    """Blank-separated words of a text."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def rank(number, doc_id: str = "doc_id"):
    """63-bit hash that orders the documents in pass ``number``."""
    return F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.lit("pass"), number.cast("int")), 1)


def _facts(totals: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy and largest number of passes of the covering budget under each exponent, in one aggregate."""
    p = F.col("p")
    parts = []
    for i, a in enumerate(exponents):
        parts += [F.sum(F.pow(p, F.lit(a))).alias(f"z{i}"), F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"s{i}")]
    row = totals.filter("p > 0").agg(F.min("p").alias("least"), F.max("p").alias("most"), *parts).first()
    out = []
    for i, a in enumerate(exponents):
        z, s = row[f"z{i}"], row[f"s{i}"]
        out.append((math.log(z) - a * s / z, (row["most"] / row["least"]) ** (1 - a)))
    return out


def bisect(totals: DataFrame, entropy: float | None, most_repeats: float | None) -> float:
    """The smallest exponent in [0, 1] that meets both limits; 1 where not even that does. Entropy and repeats fall as it
    grows. Five levels of the bisection are looked at in one pass over the table of sources."""
    low, high, points = 0.0, 1.0, 2**LEVELS_AT_ONCE

    def meets(fact):
        return (entropy is None or fact[0] <= entropy) and (most_repeats is None or fact[1] <= most_repeats)

    if meets(_facts(totals, [0.0])[0]):
        return 0.0
    for _ in range(STEPS):
        inner = [low + (high - low) * i / points for i in range(1, points)]
        first = next((i for i, f in enumerate(_facts(totals, inner)) if meets(f)), len(inner))
        low, high = ([low] + inner)[first], (inner + [high])[first]
    return high


def mixture(
    docs: DataFrame, entropy: float | None = None, most_repeats: float | None = 2.0, budget: float | None = None, source: str = "source", text: str = "text"
) -> Mixture:
    """Weights and numbers of passes, and for the last pass of each source the rank below which documents are taken."""
    light = stage(docs.select("doc_id", F.col(source).alias("source"), n_tokens(text).alias("tokens")), "tokens")
    totals = stage(light.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    total = totals.agg(F.sum("tokens")).first()[0]
    if not total:
        plain = totals.select(F.col("source").alias("_mix_source"), F.col("tokens").alias("_mix_tokens"), F.lit(0.0).alias("_mix_weight"), F.lit(1.0).alias("_mix_passes"))
        return Mixture(1.0, 0.0, plain.select("*", F.lit(1).alias("_mix_full"), F.lit(0).cast("bigint").alias("_mix_below")))
    totals = totals.withColumn("p", F.col("tokens") / F.lit(float(total)))
    exponent = bisect(totals, entropy, most_repeats)
    scale = totals.filter("p > 0").agg(F.sum(F.pow("p", F.lit(exponent))).alias("z"), F.max("p").alias("most")).first()
    if budget is None:
        budget = total * scale["most"] ** (1 - exponent) * scale["z"]
    weight = F.when(F.col("p") > 0, F.pow("p", F.lit(exponent)) / F.lit(scale["z"])).otherwise(0.0)
    passes = F.when(F.col("p") > 0, F.col("weight") * F.lit(float(budget)) / F.col("tokens")).otherwise(1.0)
    # A billionth hides the rounding of the quotient where a source passes a whole number of times.
    rates = totals.withColumn("weight", weight).withColumn("passes", passes).withColumn("full", F.floor(F.col("passes") + 1e-9).cast("int"))
    rates = rates.withColumn("quota", F.greatest(F.lit(0.0), (F.col("passes") - F.col("full")) * F.col("tokens")))
    rates = stage(rates, "rates")
    # The last pass: its end is looked for among ever smaller ranges of hashes.
    found = rates.select("source", "full", F.col("quota").alias("left"), F.lit(0).cast("bigint").alias("below"))
    bits = 63
    for _ in range(DIGITS):
        ends_at = small(found.withColumnRenamed("source", "at"))
        near = light.join(ends_at, F.col("source").eqNullSafe(F.col("at")))
        near = near.withColumn("rank", rank(F.col("full")))
        if bits < 63:
            near = near.filter(F.shiftright("rank", bits) == F.shiftright("below", bits))
        bits -= DIGIT_BITS
        sums = near.groupBy("source", F.shiftright("rank", bits).alias("range")).agg(F.sum("tokens").alias("tokens"), F.first("left").alias("left"))
        running = F.sum("tokens").over(Window.partitionBy("source").orderBy("range"))
        ends = sums.withColumn("until", running).groupBy("source").agg(
            F.max(F.when(F.col("until") <= F.col("left"), F.col("until"))).alias("taken"),
            F.min(F.when(F.col("until") > F.col("left"), F.col("range"))).alias("range"),
        )
        ends = ends.withColumnRenamed("source", "at")  # one row for each source
        joined = found.join(ends, found["source"].eqNullSafe(ends["at"]), "left")
        # Where all that is there fits in, the end is that of the range looked through.
        end = F.coalesce(F.shiftleft("range", bits), F.col("below"))
        found = stage(joined.select("source", "full", (F.col("left") - F.coalesce("taken", F.lit(0))).alias("left"), end.alias("below")), "ends")
    names = found.select(F.col("source").alias("at"), "below")
    final = rates.join(names, rates["source"].eqNullSafe(names["at"]), "left")
    columns = {"source": "source", "tokens": "tokens", "weight": "weight", "passes": "passes", "full": "full", "below": "below"}
    return Mixture(exponent, float(budget), stage(final.select(*[F.col(c).alias(f"_mix_{n}") for n, c in columns.items()]), "mixture"))


def free_names(columns: list[str]) -> list[str]:
    """The names of input columns, with underscores in front of those that begin like the added ones."""
    taken, out = {c.lower() for c in columns}, []
    for name in columns:
        free = name
        if name.lower().startswith("_mix_"):
            while free.lower() in taken or free.lower().startswith("_mix_"):
                free = "_" + free
            taken.add(free.lower())
        out.append(free)
    return out


def copies(docs: DataFrame, mix: Mixture, block_tokens: float = 1e9, source: str = "source") -> DataFrame:
    """``docs`` once for each pass that takes the row, with _mix_epoch, _mix_place and _mix_block."""
    names = dict(zip(docs.columns, free_names(docs.columns)))
    docs, source = docs.toDF(*names.values()), names.get(source, source)
    rates = small(mix.sources)
    rated = docs.join(rates, F.col(source).eqNullSafe(F.col("_mix_source")))
    last = F.when(rank(F.col("_mix_full")) < F.col("_mix_below"), 1).otherwise(0)
    times = F.sequence(F.lit(0), F.col("_mix_full") + last - 1)
    taken = rated.filter(F.col("_mix_full") + last > 0).withColumn("_mix_epoch", F.explode(times))
    place = (F.col("_mix_epoch") + rank(F.col("_mix_epoch")) / F.lit(2.0**63)) / F.greatest(F.col("_mix_passes"), F.col("_mix_epoch") + F.lit(1e-9))
    blocks = max(1, math.ceil(mix.budget / block_tokens))
    placed = taken.withColumn("_mix_place", F.least(place, F.lit(1 - 2.0**-53)))
    return placed.withColumn("_mix_block", F.floor(F.col("_mix_place") * blocks))


def mixed_rows(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it."""
    taken = copies(docs, mixture(docs, **limits), source=limits.get("source", "source"))
    return taken.drop(*[c for c in taken.columns if c.startswith("_mix_")]).toDF(*docs.columns)
