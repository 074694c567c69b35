"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

Every source is split into shards of bounded size by a seeded hash of the document id. The words of a shard form a
line, documents in seeded order. The mix consists of blocks of ``block_words`` words; shards get whole numbers of
blocks by the highest quotients of their targets over 1, 3, 5, ...; a shard's blocks are a seeded run on its line,
which goes round when a source is repeated.

Nothing but sums over sources or shards ever reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscout.llm.common import WORD, picked, ranked, staged

BLOCK_WORDS = 16
SHARD_WORDS = 1 << 20
SEED = "mix-1"


def seeded(seed: str, *parts: Column) -> Column:
    """A non-negative 60-bit number that depends on the seed and the parts only."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def fill_level(sources: DataFrame, budget: float) -> float:
    """The level L at which the sum of min(cap, L * weight) over all sources is the budget.

    ``sources`` has ``cap`` and ``weight``. Each round shares what the sources at their cap leave over; a round is
    one small aggregate, and there are at most as many as there are steps at which sources reach their cap.
    """
    level, reached = 0.0, -1
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight") if reached >= 0 else F.lit(False)
        row = sources.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
            F.sum(full.cast("long")),
        ).first()
        if not row[1]:
            return math.inf
        if row[2] == reached:
            return level
        level, reached = (budget - row[0]) / row[1], row[2]


def divisor(units: DataFrame, seats: int, start: float) -> float:
    """A divisor at which rounding ``goal`` / divisor gives at most ``seats``, and a hair less would give as many.

    Sixteen candidates are tried in one aggregate over the shards.
    """

    def counts(candidates: list[float]) -> list[int]:
        row = units.agg(*[F.sum(F.floor(F.col("goal") / F.lit(d) + F.lit(0.5))) for d in candidates]).first()
        return [x or 0 for x in row]

    low, high = start / 2, start * 2
    while counts([high])[0] > seats:
        low, high = high, high * 4
    while low > 1e-9 and counts([low])[0] < seats:
        low, high = low / 4, low
    while high - low > high * 1e-13:
        tries = [low + (high - low) * i / 17 for i in range(1, 17)]
        found = counts(tries)
        if seats in found:
            return tries[found.index(seats)]
        above = [d for d, n in zip(tries, found) if n > seats]
        below = [d for d, n in zip(tries, found) if n < seats]
        low, high = max([low, *above]), min([high, *below])
        if not above and not below:
            break
    return high


def apportion(units: DataFrame, seats: int, start: float) -> DataFrame:
    """``units`` (``src``, ``shard``, ``goal``) with ``quota``: the Sainte-Laguë seats of each."""
    if not seats:
        return units.withColumn("quota", F.lit(0).cast("long"))
    d = divisor(units, seats, start)
    sure = units.withColumn("quota", F.floor(F.col("goal") / F.lit(d) + F.lit(0.5)).cast("long"))
    left = seats - (sure.agg(F.sum("quota")).first()[0] or 0)
    if left <= 0:
        return sure
    # Only quotients that are equal to within the divisor's precision are still open.
    sure = staged(sure)
    best = sure.where("goal > 0").orderBy(F.desc(F.col("goal") / (2 * F.col("quota") + 1)), "src", "shard").limit(left)
    won = best.select("src", "shard", F.lit(1).alias("_won"))
    return sure.join(won, ["src", "shard"], "left").withColumn("quota", F.expr("quota + coalesce(_won, 0)")).drop("_won")


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """How many words of each document the mix takes: ``doc_id, size, source_size, target, taken, quota``.

    Sources by code point, a null source last, weigh ``weights`` in turn and share ``share`` times all words; no
    source gets more than ``repeats`` times its words, nor does a document. ``quota`` is the blocks of the
    document's shard. Other columns are ignored. Empty and null texts have size 0 and are kept with 0 taken; a null
    id is an id like any other; rows with the same id are documents of their own, equal rows share what their places
    on the line get; without rows the result is empty.
    """
    # The digit in front keeps the order of code points and puts null last.
    src = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    place = seeded(seed, F.col("doc_id"))
    sized = staged(picked(docs, "doc_id", "text", "source").select("doc_id", src.alias("src"), size.alias("size"), place.alias("place")))

    sources = sized.groupBy("src").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = ranked(sources, "src").withColumn("weight", weight).withColumn("cap", F.col("source_size") * repeats)
    sources = staged(sources)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = fill_level(sources, share * total)
    target = F.when(F.col("cap") <= F.lit(level) * F.col("weight"), F.col("cap").cast("double"))
    shards = F.ceil((F.col("source_size") + F.col("rows")) / shard_words)
    sources = sources.select(
        "src", "source_size", target.otherwise(F.lit(level) * F.col("weight")).alias("target"), shards.alias("shards")
    )

    # The hint makes the small side explicit only to adaptive execution: sources are shuffled when they are many.
    parts = sized.join(sources, "src").withColumn("shard", F.col("place") % F.col("shards")).drop("shards")
    goal = F.when(F.col("source_size") > 0, F.col("target") * F.col("unit_size") / F.col("source_size"))
    units = parts.groupBy("src", "shard", "source_size", "target").agg(F.sum("size").alias("unit_size"))
    units = staged(units.select("src", "shard", "unit_size", F.coalesce(goal, F.lit(0.0)).alias("goal")))
    wanted = sources.agg(F.sum("target")).first()[0] or 0.0
    units = apportion(units, math.floor(wanted / block_words + 0.5), float(block_words))
    words = F.least(F.col("quota") * block_words, F.col("unit_size") * repeats)
    blocks = F.greatest(F.ceil(F.col("unit_size") / block_words), F.lit(1))
    first = seeded(seed, F.col("src"), F.col("shard")) % blocks * block_words
    units = units.select("src", "shard", "unit_size", "quota", words.alias("words"), first.alias("first"))

    line = "sum(size) OVER (PARTITION BY src, shard ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size"
    laid = parts.withColumn("at", F.expr(line)).join(units, ["src", "shard"])
    overlap = "greatest(0, least(at + {0} + size, first + words % unit_size) - greatest(at + {0}, first))"
    taken = f"(words div unit_size) * size + {overlap.format('0')} + {overlap.format('unit_size')}"
    return laid.selectExpr(
        "doc_id",
        "size",
        "source_size",
        "target",
        f"cast(CASE WHEN unit_size > 0 THEN {taken} ELSE 0 END AS bigint) AS taken",
        "quota",
    )
