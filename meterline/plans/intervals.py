"""Joining moments with the rules that are valid at them, without trying every rule of a key.

An interval of whole numbers is the disjoint union of few aligned blocks (level, block): block ``b`` of level ``l`` covers
``b * 2**l`` up to ``(b + 1) * 2**l``.  A number lies in one block of each level.  So whether a number is in an interval is
an equality of blocks, which a hash join finds, and an interval without end needs no more blocks than any other.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions import records
from meterline.plans.asof import as_of
from meterline.plans.rules import with_rules

#: Blocks up to which a rule table is sent to every task; at some 60 bytes each about 25 MB.
COVER_ROWS = 400_000
#: Segments up to which each record is tried against all of its key: fewer than a record has levels of blocks.
FEW_SEGMENTS = 16
#: Lengths, in microseconds, of which the largest that divides all borders becomes the unit of time.
UNITS = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)


def _level(number: Column, level: Column) -> Column:
    """``number // 2**level`` for a number that is not negative."""
    return F.call_function("shiftright", number, level.cast("int"))


def cover(low: Column, high: Column, levels: int) -> Column:
    """The blocks of ``low <= x < high`` as an array of (level, block), levels 0 to ``levels``; ``0 <= low``."""

    def of_level(level: Column) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), level.cast("int"))
        first, end = _level(low + one - 1, level), _level(high, level)
        left = (first % 2 == 1) & (first < end)
        rest = first + F.when(left, 1).otherwise(0)
        right = (end % 2 == 1) & (rest < end)
        blocks = F.array(F.when(left, first), F.when(right, end - 1))
        return F.transform(F.array_compact(blocks), lambda block: F.struct(level.alias("level"), block.alias("block")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), of_level))


def path(number: Column, levels: int) -> Column:
    """The block of each level in which ``number`` lies."""
    every = F.sequence(F.lit(0), F.lit(levels))
    return F.transform(every, lambda level: F.struct(level.alias("level"), _level(number, level).alias("block")))


def _levels(numbers: int) -> int:
    """Levels that blocks of the numbers below ``numbers`` can have."""
    return max(numbers - 1, 0).bit_length()


def strongest_segments(rules: DataFrame, key: str, start: str, end: str, value: str) -> DataFrame:
    """Rules of a key as segments (key, start, end, value) that do not overlap, with the largest value valid in each.

    Borders of a key are numbered; a rule is an interval of numbers, a segment one number, and they meet by blocks: with
    ``n`` rules that is a join of ``n log n`` rows, not of ``n`` squared.  Counts the borders while the plan is built.
    """
    borders = rules.select(key, F.explode(F.array(start, end)).alias("_border")).distinct()
    ordered = Window.partitionBy(key).orderBy("_border")
    ranked = borders.withColumns(
        {"_rank": F.row_number().over(ordered).cast("bigint") - 1, "_next": F.lead("_border").over(ordered)}
    )
    levels = _levels(ranked.agg(F.max("_rank")).first()[0] or 0) + 1
    low = ranked.select(key, F.col("_border").alias(start), F.col("_rank").alias("_low"))
    high = ranked.select(key, F.col("_border").alias(end), F.col("_rank").alias("_high"))
    numbered = rules.join(low, [key, start]).join(high, [key, end])
    blocks = numbered.select(key, value, F.inline(cover(F.col("_low"), F.col("_high"), levels)))
    blocks = blocks.groupBy(key, "level", "block").agg(F.max(value).alias(value))
    pieces = ranked.where("_next IS NOT NULL").select(
        key, F.col("_border").alias(start), F.col("_next").alias(end), F.inline(path(F.col("_rank"), levels))
    )
    return pieces.join(blocks, [key, "level", "block"]).groupBy(key, start, end).agg(F.max(value).alias(value))


def _without_gaps(segments: DataFrame, key: str, start: str, end: str, values: list[str]) -> DataFrame:
    """Segments by start alone, each valid until the next: after one that no other follows at once there is one of NULLs."""
    nothing = [F.lit(None).cast(segments.schema[name].dataType).alias(name) for name in values]
    own = segments.select(key, F.col(start).alias("_from"), *values, F.lit(0).alias("_gap"))
    gaps = segments.where(F.col(end).isNotNull()).select(key, F.col(end).alias("_from"), *nothing, F.lit(1).alias("_gap"))
    first = Window.partitionBy(key, "_from").orderBy("_gap")
    both = own.unionByName(gaps).withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return both.drop("_gap", "_n")


def with_valid(
    usage: DataFrame,
    segments: DataFrame,
    key: str,
    usage_key: Column,
    at: str,
    start: str,
    end: str,
    cover_rows: int = COVER_ROWS,
    few_segments: int = FEW_SEGMENTS,
) -> DataFrame:
    """Usage with the values of the segment of its key in which ``at`` lies, or NULL: one row for each.

    ``segments``: the key, ``start`` (included), ``end`` (excluded; NULL: none) and values; those of a key do not overlap and
    their names do not occur in the usage.  Times are counted in the largest unit that divides all borders; gaps between
    segments are covered, too, so a record meets exactly one block.  The blocks are counted while the plan is built and sent
    to all tasks, which look each record up once a level.  Beyond ``cover_rows`` blocks usage and segments are sorted
    together instead (:func:`meterline.plans.asof.as_of`).  Segments are read several times: give a stored table.
    """
    values = [name for name in segments.columns if name not in (key, start, end)]
    starts = _without_gaps(segments.where(F.col(key).isNotNull()), key, start, end, values)
    micros = records.micros("_from")
    fits = [F.bool_and(micros % unit == 0).alias(f"unit{i}") for i, unit in enumerate(UNITS)]
    found = starts.agg(F.min(micros).alias("first"), F.max(micros).alias("last"), F.count(F.lit(1)).alias("n"), *fits).first()
    if found["first"] is None:
        nothing = {name: F.lit(None).cast(segments.schema[name].dataType) for name in values}
        return usage.withColumns(nothing)
    if found["n"] <= few_segments:
        within = (F.col(at) >= F.col("_start")) & (F.col("_end").isNull() | (F.col(at) < F.col("_end")))
        few = segments.withColumnsRenamed({key: "_of", start: "_start", end: "_end"})
        return with_rules(usage, few, {"_of": usage_key}, within).drop("_start", "_end")
    unit = next(unit for i, unit in enumerate(UNITS) if found[f"unit{i}"])
    # Number 0 is all time before the first border, and the last one all time from the last border on.
    last = (found["last"] - found["first"]) // unit + 1
    levels = _levels(last + 1)

    def number(moment: str) -> Column:
        passed = records.micros(moment) - F.lit(found["first"])
        inside = F.least(F.call_function("div", passed, F.lit(unit)) + 1, F.lit(last))
        return F.when(passed >= 0, inside).otherwise(F.lit(0).cast("bigint"))

    following = Window.partitionBy(key).orderBy("_low")
    listed = starts.withColumn("_low", number("_from"))
    early = listed.groupBy(F.col(key)).agg(F.min("_low").alias("_high"))
    early = early.select(key, F.lit(0).cast("bigint").alias("_low"), "_high", *[F.lit(None).cast(segments.schema[n].dataType).alias(n) for n in values])
    later = listed.withColumn("_high", F.coalesce(F.lead("_low").over(following), F.lit(last + 1)))
    every = early.unionByName(later.select(key, "_low", "_high", *values))
    blocks = every.select(F.col(key).alias("_key"), F.inline(cover(F.col("_low"), F.col("_high"), levels)), F.lit(True).alias("_hit"), *values)
    blocks = blocks.withColumnsRenamed({"level": "_level", "block": "_block"})
    if blocks.limit(cover_rows + 1).count() > cover_rows:
        return as_of(usage, starts, key, usage_key, at, "_from")
    known = F.broadcast(every.select(F.col(key).alias("_known")).distinct())
    sought = usage.join(known, usage_key == F.col("_known"), "left")
    nowhere = F.array(F.struct(F.lit(-1).alias("level"), F.lit(-1).cast("bigint").alias("block")))
    places = F.when(F.col("_known").isNotNull(), path(number(at), levels)).otherwise(nowhere)
    probed = sought.withColumn("_place", F.explode(places))
    match = (F.col("_known") == F.col("_key")) & (F.col("_place.level") == F.col("_level")) & (F.col("_place.block") == F.col("_block"))
    met = probed.join(F.broadcast(blocks), match, "left").where("_hit OR _place.level < 0")
    return met.drop("_known", "_place", "_key", "_level", "_block", "_hit")
