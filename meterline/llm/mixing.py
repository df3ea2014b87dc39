"""Mixing sources to target weights by Poisson replication.

A source whose share should be ``w`` and which holds ``n`` of ``N`` texts repeats each text ``w N / n`` times on average.
How often one row is taken is drawn from the Poisson distribution with that mean, by inverting it at a number between
0 and 1 that a hash of seed, all its columns and its number among equal rows gives; a mean above ``MOST_RATE`` is the sum of several such draws, which has the same
distribution.  Copies are then put in the order of another hash.  Everything is made of
Spark's own functions, and the same table gives the same copies in the same order, whatever its partitions.

Rows: NULL is a source of its own; every row draws by itself, whether it shares its key, or all it holds, with others; which of
equal rows is taken how often cannot be seen, their numbers can; a table without rows gives none.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import let, partitions, small, written

SEED = "mix-1"
#: Larger means are drawn as the sum of several equal smaller ones: ``exp(-rate)`` must not be zero.
MOST_RATE = 700
COPIES_AT_ONCE = 10_000


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) of 48 bits from the MD5 of the parts, joined by colons."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_rates(docs: DataFrame, source: str, weights: dict[str | None, float] | None) -> DataFrame:
    """(source, rate): the mean number of copies of a text of each source.

    ``weights`` gives the target share of each source by name, ``None`` standing for NULL; shares are scaled to a sum of
    1 over the sources found, and sources without one get none.  Without ``weights`` the target share is proportional to
    the square root of a source's number of texts: small sources gain, large ones lose.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).cast("double").alias("texts"))
    if weights is None:
        share = F.sqrt("texts")
    else:
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name).cast("string")), F.lit(float(weight))).otherwise(share)
    shares = written(sizes.withColumn("share", share), "shares")
    total = shares.agg(F.sum("share").alias("share"), F.sum("texts").alias("texts")).first()
    rate = F.col("share") / F.lit(total["share"] or 1.0) * F.lit(total["texts"] or 0.0) / F.col("texts")
    return shares.select("source", rate.alias("rate"))


def thresholds(rate: Column) -> Column:
    """Poisson probabilities of at most 0, 1, 2, ... copies, as far as they differ from 1 in 48 bits."""
    most = F.ceil(rate + 9 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("sums"))

    def further(state: Column, k: Column) -> Column:
        term = state["term"] * rate / k
        return F.struct(
            term.alias("term"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + term)).alias("sums")
        )

    return F.aggregate(F.sequence(F.lit(1), most), start, further, lambda state: state["sums"])


def drawn_copies(sums: Column, parts: Column, seed: str, key: Column, drawn: Column) -> Column:
    """How many copies: the sum of ``parts`` draws, the first at ``drawn``, each further one at a hash of its own."""

    def draw(total: Column, part: Column) -> Column:
        at = F.when(part == 1, drawn).otherwise(unit_hash(F.lit(seed), key, part, F.lit("part")))
        return total + let(at, lambda one: F.size(F.filter(sums, lambda most: most <= one)))

    return F.aggregate(F.sequence(F.lit(1).cast("bigint"), parts), F.lit(0).cast("bigint"), draw)


def row_digest(columns: list[str]) -> Column:
    """MD5 of all columns as text, each with its length, so that no two rows give the same input; NULL is ``-``."""

    def field(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.md5(F.concat(*[field(name) for name in columns]).cast("binary"))


def numbered_rows(docs: DataFrame) -> DataFrame:
    """(row, identity): each row as a struct, and its digest with its number among equal rows.

    Digests that occur once need no number.  The others are counted before the shuffle, one row for each, and unfolded again
    in steps of ``COPIES_AT_ONCE``, so a row repeated a billion times is no single task's.
    """
    rows = docs.select(F.struct("*").alias("row"), row_digest(docs.columns).alias("digest"))
    counts = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    repeated = small(written(counts, "repeated-rows"))
    one = rows.join(repeated, "digest", "left_anti").select("row", F.concat("digest", F.lit(":1")).alias("identity"))
    several = rows.join(repeated, "digest").groupBy("digest").agg(F.first("row").alias("row"), F.first("many").alias("many"))
    steps = several.withColumn("first", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("many"), F.lit(COPIES_AT_ONCE))))
    steps = steps.repartition(partitions(docs.sparkSession), "digest", "first")
    number = F.explode(F.sequence("first", F.least(F.col("first") + (COPIES_AT_ONCE - 1), F.col("many"))))
    each = steps.withColumn("number", number).select("row", F.concat("digest", F.lit(":"), "number").alias("identity"))
    return one.unionByName(each)


def mix(docs: DataFrame, source: str, weights: dict[str | None, float] | None = None, seed: str = SEED) -> DataFrame:
    """(row, copy, place): each row of ``docs``, whole as a struct, as often as drawn.

    ``copy`` counts from 1, ``place`` is in [0, 1).  Copies are dealt out to partitions by ``place`` and ordered by it
    there, so that any run of rows is a random sample.
    """
    rates = written(source_rates(docs, source, weights), "rates")
    parts = F.greatest(F.ceil(F.col("rate") / MOST_RATE), F.lit(1)).cast("bigint")
    table = rates.select("source", parts.alias("parts"), thresholds(F.col("rate") / parts).alias("sums"))
    table = small(written(table, "thresholds"))
    rows = numbered_rows(docs).withColumn("of", F.col(f"row.`{source}`"))
    rows = rows.withColumn("drawn", unit_hash(F.lit(seed), F.col("identity")))
    counted = rows.join(table, F.col("of").eqNullSafe(F.col("source"))).select(
        "row", "identity", drawn_copies(F.col("sums"), F.col("parts"), seed, F.col("identity"), F.col("drawn")).alias("count")
    )
    # In two steps, so that no array is longer than COPIES_AT_ONCE.
    starts = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("count"), F.lit(COPIES_AT_ONCE))).alias("start")
    last = F.least(F.col("start") + (COPIES_AT_ONCE - 1), F.col("count"))
    copies = counted.where("count > 0").select("row", "identity", "count", starts)
    copies = copies.select("row", "identity", F.explode(F.sequence("start", last)).alias("copy"))
    place = unit_hash(F.lit(seed), F.col("identity"), F.col("copy"), F.lit("place"))
    return (
        copies.select("row", "copy", place.alias("place"))
        .repartition(partitions(docs.sparkSession), "place")
        .sortWithinPartitions("place")
    )
