"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are dealt into blocks. In a schedule of one block a slot, block i (1, 2, ...) of a source
of weight w may not start before slot floor((i-1)/w) and is due by ceil(i/w); slots go to the released block with the
earliest deadline. At every slot each source then stands less than one block from its share.

Weights are exact fractions. The schedule repeats after their common denominator, so one period stands for all; where the
denominator is larger than the mix, every block is scheduled once, in about two microseconds. When a source runs out, the
others start a schedule of their own from that slot, with their exact weights.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import islice
from math import gcd, lcm

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sensorloom.session import scratch_dir

#: Documents in a block.
BLOCK = 32
#: Rows of the schedule that the driver holds at once; longer ones are written in pieces.
PIECE = 500_000
#: Rows of a source numbered in one task, about: texts of some ten megabytes.
BUCKET_ROWS = 5_000


def parts(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole parts of the period for each source, one at least, by largest remainders (ties: by name)."""
    total = sum(weights.values())
    free = period - len(weights)
    exact = {s: Fraction(w).limit_denominator(10**9) / Fraction(total).limit_denominator(10**9) * period for s, w in weights.items()}
    got = {s: max(1, int(x)) for s, x in exact.items()}
    assert free >= 0
    while (left := period - sum(got.values())) != 0:
        step = 1 if left > 0 else -1
        able = [s for s in got if step > 0 or got[s] > 1]
        s = max(able, key=lambda s: (step * (exact[s] - got[s]), s))
        got[s] += step
    return got


def target_weight(source: str) -> float:
    """The target weights of the query and of the pipeline: 1 to 5 parts, by crc32 of the name, so new sources have one too."""
    return float(1 + zlib.crc32(source.encode()) % 5)


def exact_parts(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in the very proportion of the weights as they are written in decimals."""
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    common = lcm(*(x.denominator for x in exact.values()))
    whole = {s: int(x * common) for s, x in exact.items()}
    least = gcd(*whole.values())
    return {s: n // least for s, n in whole.items()}


def period_schedule(share: dict[str, int]) -> list[str]:
    """The source of each slot of a period, see ``_slots``."""
    return list(_slots(share))


def _slots(share: dict[str, int]) -> Iterator[str]:
    """The source of each slot of a period: earliest deadline first among released blocks.

    Ties are Pfair ties: a deadline at which the next block is released already (overlapping windows) goes first,
    then larger weight, then the name."""
    q = sum(share.values())
    waiting: list[tuple[int, int, int, str, int]] = []
    released: dict[int, list[tuple[str, int]]] = {}
    for s in share:
        released.setdefault(0, []).append((s, 1))
    slot = -1
    while (slot := slot + 1) < q:
        for s, i in released.pop(slot, []):
            due = -(-i * q // share[s])
            overlap = (i * q) % share[s] != 0
            heapq.heappush(waiting, (due, 0 if overlap else 1, -share[s], s, i))
        _, _, _, s, i = heapq.heappop(waiting)
        yield s
        if i < share[s]:
            released.setdefault(max(slot + 1, i * q // share[s]), []).append((s, i + 1))


def phases(blocks: dict[str, int], weights: dict[str, float], period: int | None = None) -> list[tuple[str, int, int, int, int, int]]:
    """Rows (source, first block, blocks a period, slot of it, times, length of the period), see ``_phases``."""
    return list(_phases(blocks, weights, period))


def _phases(blocks: dict[str, int], weights: dict[str, float], period: int | None) -> Iterator[tuple[str, int, int, int, int, int]]:
    """Each row stands for ``times`` blocks of a source, one a period. A phase ends with the slot in which a source runs out.

    Whole periods are one row for each slot of the period; where a phase is shorter than a period, a row is one block."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done, slot = dict.fromkeys(left, 0), 0
    while left:
        now = {s: weights[s] for s in left}
        share = parts(now, max(period, len(left))) if period else exact_parts(now)
        q = sum(share.values())
        if times := min(left[s] // share[s] for s in left):
            index = dict.fromkeys(left, 0)
            for at, s in enumerate(_slots(share)):
                yield s, done[s] + index[s], share[s], slot + at, times, q
                index[s] += 1
            for s in left:
                left[s] -= share[s] * times
                done[s] += share[s] * times
            slot += q * times
        if all(left.values()):
            for s in _slots(share):
                yield s, done[s], 1, slot, 1, 1
                done[s] += 1
                left[s] -= 1
                slot += 1
                if not left[s]:
                    break
        left = {s: n for s, n in left.items() if n}


def _schedule(spark: SparkSession, rows: Iterator[tuple]) -> DataFrame:
    """Slot of every block, from the rows of ``_phases``."""
    kind = "_s string, _first bigint, _each bigint, _slot bigint, _times bigint, _length bigint"
    piece = list(islice(rows, PIECE))
    table = spark.createDataFrame(piece, kind)
    if len(piece) == PIECE:
        path = scratch_dir(spark, "schedule")
        while piece:
            spark.createDataFrame(piece, kind).write.mode("append").parquet(path)
            piece = list(islice(rows, PIECE))
        table = spark.read.schema(kind).parquet(path)
    turns = table.filter("_times > 0").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_times") - 1)).alias("_turn"))
    return turns.select("_s", (F.col("_first") + F.col("_turn") * F.col("_each")).alias("mix_block"), (F.col("_slot") + F.col("_turn") * F.col("_length")).alias("mix_slot"))


def placed(docs: DataFrame, schedule: DataFrame, key: str, block: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds mix_block, mix_place and mix_slot: rows of each source (``_s``) numbered from 0 in a shuffled but fixed order, by hash
    of the id, and cut into blocks, whose slots the schedule (_s, mix_block, mix_slot) has.

    A source is cut into buckets by hash of the id, numbered bucket by bucket; a bucket's first number is the sum of
    the buckets before it. So a source with a third of all rows is spread over many tasks. Slots come to the rows as
    one array a bucket: the rows are dealt out by source and bucket, and only once.
    """
    count = docs.count()
    buckets = max(1, -(-count // bucket_rows))
    # rows without an id are dealt by what else they hold
    cells = [F.col(f"`{f.name}`") for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    dealt = docs.withColumn("_mix_cells", F.xxhash64(*cells))
    deal = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.col("_mix_cells").cast("string")), F.lit("deal"))
    dealt = dealt.withColumn("_bucket", F.pmod(deal, F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy("_s", "_bucket").agg(F.count("*").alias("_c"))
    before = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_s", "_bucket", "_c", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_first"))
    begin, end = F.floor(F.col("_first") / block), F.floor((F.col("_first") + F.col("_c") - 1) / block)
    spans = first.select("_s", "_bucket", "_first", F.explode(F.sequence(begin, end)).alias("mix_block"))
    slots = spans.join(schedule, ["_s", "mix_block"]).groupBy("_s", "_bucket").agg(
        F.min("_first").alias("_first"), F.sort_array(F.collect_list(F.struct("mix_block", "mix_slot"))).alias("_slots")
    )
    order = Window.partitionBy("_s", "_bucket").orderBy(F.xxhash64(F.col(key)), F.col(key), "_mix_cells")
    rows = dealt.withColumn("_at", F.row_number().over(order) - 1).join(slots, ["_s", "_bucket"])
    rows = rows.withColumn("_n", F.col("_first") + F.col("_at")).withColumn("mix_block", F.floor(F.col("_n") / block))
    nth = (F.col("mix_block") - F.col("_slots")[0]["mix_block"]).cast("int")
    return rows.withColumns({"mix_place": F.pmod("_n", F.lit(block)), "mix_slot": F.col("_slots")[nth]["mix_slot"]})


def _positive(weights: dict) -> dict[str, float]:
    weights = {str(k): float(v) for k, v in weights.items()}
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    return weights


def mixed(
    docs: DataFrame,
    weights: dict[str, float] | Callable[[str], float] | None = None,
    key: str = "doc_id",
    source: str = "source",
    block: int = BLOCK,
    period: int | None = None,
) -> DataFrame:
    """Every row with its place in the mix: columns of the table plus mix_source, mix_block, mix_slot, mix_place.

    mix_slot numbers the blocks of the whole mix from 0 without gaps, mix_place the rows of a block; the mix is the
    order by (mix_slot, mix_place). The last block of a source may be short. ``weights`` maps sources to target
    weights, or is a function that gives one for each name; a source without one, and all where none are given, gets the
    mean weight (1). Weights are relative; zero or less is an error. With ``period`` they are first rounded to so many parts. Null is a source like any other (mix_source ""). No row is dropped or repeated. Rows of equal
    ids and source follow each other in any order. An empty table gives an empty one. The number of sources is taken
    to fit the driver (one count each). Columns of the table that have the names of the new ones are replaced.
    """
    if not callable(weights):
        weights = _positive(weights or {})
    docs = docs.drop("mix_source", "mix_block", "mix_slot", "mix_place")
    rows = docs.withColumn("_s", F.coalesce(F.col(source).cast("string"), F.lit("")))
    counts = {r["_s"]: r["c"] for r in rows.groupBy("_s").agg(F.count("*").alias("c")).collect()}
    if callable(weights):
        weights = _positive({s: weights(s) for s in counts})
    mean = sum(weights.values()) / len(weights) if weights else 1.0
    plan = _phases({s: -(-c // block) for s, c in counts.items()}, {s: weights.get(s, mean) for s in counts}, period)
    schedule = _schedule(docs.sparkSession, plan)
    found = placed(rows, schedule, key, block)
    return found.select(*[F.col(c) for c in docs.columns], F.col("_s").alias("mix_source"), "mix_block", "mix_slot", "mix_place")
