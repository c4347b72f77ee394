"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airsight.llm.common import whole
from airsight.session import sized, stage

#: Words of a block.
BLOCK_WORDS = 64
#: Words a shard has at least on average, and shards there are at most, besides one per source.
SHARD_WORDS = 2_000_000
MAX_SHARDS = 65_536
#: Times a source, and so any of its documents, may be taken.
MAX_REPEATS = 3
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
SEED = 20_240


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def water_fill(sizes: list[int], weights: list[float], limit: float = MAX_REPEATS) -> list[float]:
    """Share the sum of ``sizes`` by weight; no share above ``limit`` times its size, the excess reshared until none is."""
    left, targets, open_ = float(sum(sizes)), [0.0] * len(sizes), list(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > limit * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = unit * weights[i]
            break
        for i in full:
            targets[i] = float(limit * sizes[i])
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def sainte_lague(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Give ``seats`` to the highest quotients votes / (2 * seats so far + 1); ``most`` limits each. Ties go to the first.

    All but the last seats of each entry come from one division: with d votes a seat, an entry has at least
    its rounded quotient less one, so those are given at once and only the rest is dealt seat by seat.
    """
    seats = min(seats, sum(most))
    total = sum(v for v, m in zip(votes, most) if m)
    given = [min(m, max(0, int(v * seats / total) - 1)) if total else 0 for v, m in zip(votes, most)]
    while sum(given) > seats:  # only rounding of very large counts can come here
        given[max(range(len(given)), key=given.__getitem__)] -= 1
    heap = [(-v / (2 * g + 1), i) for i, (v, g, m) in enumerate(zip(votes, given, most)) if g < m]
    heapq.heapify(heap)
    rest = seats - sum(given)
    while rest and heap:
        quotient, i = heap[0]
        given[i] += 1
        rest -= 1
        if given[i] < most[i]:
            heapq.heapreplace(heap, (-votes[i] / (2 * given[i] + 1), i))
        else:
            heapq.heappop(heap)
    return given


@dataclass(frozen=True)
class Plan:
    """Per source its size, target and number of shards; sources in code point order, null last."""

    sources: list[str | None]
    sizes: list[int]
    targets: list[float]
    shards: list[int]


def plan_sources(totals: list[tuple[str | None, int]], shard_words: int = SHARD_WORDS) -> Plan:
    """``totals`` has one row per source, the unit for which mixing weights are given."""
    totals = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    sizes = [t[1] for t in totals]
    per_shard = max(shard_words, sum(sizes) // MAX_SHARDS)
    weights = [float(WEIGHTS[i % len(WEIGHTS)]) for i in range(len(sizes))]
    return Plan([t[0] for t in totals], sizes, water_fill(sizes, weights), [1 + s // per_shard for s in sizes])


def _stride(blocks: int) -> int:
    """A step that visits every block once, near the golden section of their number."""
    step = max(1, int(blocks * 0.6180339887))
    while gcd(step, blocks) != 1:
        step += 1
    return step


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``.

    1. Words are counted once, into a staged table without the texts.
    2. The targets of the sources follow from their totals (one row per source): shares by weight, limited to three
       times the source's size, the excess reshared.
    3. Blocks of ``BLOCK_WORDS`` words are apportioned to the sources by highest Sainte-Laguë quotients, and the blocks of a source to its
       shards in the same way. A shard is a hash class of a source's documents; a source has as many as its size
       needs, so a source with a third of all words is spread over many tasks.
    4. In a shard the documents stand in an order drawn from the seed. Their running totals place them on a line of words
       that is cut into blocks, the last of them partial. The quota of a shard is the words of its seats, up to the limit of repeats. Each full
       repeat takes every block once; the remaining words take blocks by a seeded stride, the last of them from its front, and reach the quota
       to the word. ``taken`` adds up the words of a document that lie in taken blocks.

    Nothing depends on partitioning, so reruns agree. A document without words, or with a null text, has size 0 and is not
    taken; a source without words has target 0. A null source comes last. Rows that repeat an id are placed one by one.
    Other columns are ignored, whatever their names.
    """
    sized_docs = stage(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"), words(F.col(text)).alias("size")), "doc-words"
    )
    spark = docs.sparkSession
    totals = sized_docs.groupBy("source").agg(F.sum("size").alias("n")).collect()  # one row per source
    plan = plan_sources([(r["source"], r["n"]) for r in totals], shard_words)
    per_source = [(i, s, n, t, k) for i, (s, n, t, k) in enumerate(zip(plan.sources, plan.sizes, plan.targets, plan.shards))]
    sources = spark.createDataFrame(per_source, "source_no int, of_source string, source_size long, target double, shards int")
    drawn = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("size"))
    placed = sized_docs.join(sized(sources), F.col("source").eqNullSafe(F.col("of_source")))
    placed = placed.select(
        "doc_id", "source", "size", "source_no", "source_size", "target", drawn.alias("drawn"),
        F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("doc_id"), F.col("size")), F.col("shards").cast("long")).cast("int").alias("shard"),
    )
    shard_sizes: dict[int, list[tuple[int, int]]] = {}
    for r in placed.groupBy("source_no", "shard").agg(F.sum("size").alias("n")).collect():  # at most MAX_SHARDS and one per source
        shard_sizes.setdefault(r["source_no"], []).append((r["shard"], r["n"]))
    most_seats = lambda n: -(-MAX_REPEATS * n // BLOCK_WORDS)
    seats = sainte_lague(plan.targets, round(sum(plan.sizes) / BLOCK_WORDS), [most_seats(n) for n in plan.sizes])
    quotas = []
    for i, shards in sorted(shard_sizes.items()):
        shards.sort()
        for (shard, n), q in zip(shards, sainte_lague([n for _, n in shards], seats[i], [most_seats(n) for _, n in shards])):
            b, quota_words = -(-n // BLOCK_WORDS), min(q * BLOCK_WORDS, MAX_REPEATS * n)
            stride, shift = (_stride(b), (SEED * (i + 1) + shard) % b) if b else (1, 0)
            last = ((b - 1) * stride + shift) % b if b else 0
            quotas.append((i, shard, b, quota_words // n if n else 0, quota_words % n if n else 0, stride, shift, last, b * BLOCK_WORDS - n))
    columns = "source_no int, shard int, blocks long, repeats long, rest long, stride long, shift long, last long, missing long"
    quota = spark.createDataFrame(quotas, columns)
    line = W.partitionBy("source_no", "shard").orderBy("drawn", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    on_line = placed.withColumn("stop", F.sum("size").over(line)).join(sized(quota), ["source_no", "shard"])
    start = F.col("stop") - F.col("size")

    def overlap(block: Column) -> Column:
        turn = F.pmod(block * F.col("stride") + F.col("shift"), F.col("blocks"))
        before = turn * BLOCK_WORDS - F.when(turn > F.col("last"), F.col("missing")).otherwise(F.lit(0).cast("long"))  # words of earlier turns
        end = block * BLOCK_WORDS + F.least(F.lit(BLOCK_WORDS).cast("long"), F.col("rest") - before)
        return F.greatest(F.lit(0).cast("long"), F.least(F.col("stop"), end) - F.greatest(start, block * BLOCK_WORDS))

    touched = F.sequence(F.floor(start / BLOCK_WORDS), F.floor((F.col("stop") - 1) / BLOCK_WORDS))
    extra = F.aggregate(touched, F.lit(0).cast("long"), lambda total, block: total + overlap(block))
    taken = F.when(F.col("size") > 0, F.col("repeats") * F.col("size") + extra).otherwise(F.lit(0).cast("long"))
    return on_line.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
