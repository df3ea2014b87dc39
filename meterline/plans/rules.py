"""Joining usage with rule tables: tariffs, promotions, hour bands, cells, quotas.

Rule tables have few rows and few distinct keys.  A shuffle join would send all usage to as many tasks as there are
record types or hours, and Spark cannot know the size of a table that comes from a database.  So the rules are counted.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to which a rule table is sent to every task; at some 100 bytes each about 2 MB.
RULE_ROWS = 20_000
#: Parts into which usage of one key is split when a rule table is larger.
SALTS = 256


def with_rules(
    usage: DataFrame,
    rules: DataFrame,
    keys: dict[str, Column],
    also: Column | None = None,
    rule_rows: int = RULE_ROWS,
) -> DataFrame:
    """Usage left-joined with the rules whose columns equal the ``keys`` (rule column -> value of the usage).

    ``also`` restricts the match further.  No column may occur on both sides; the key columns are dropped.  Rules are
    counted while the plan is built, and broadcast below ``rule_rows``.  Larger tables are repeated once for each salt,
    and usage is spread over the salts by its ``record_id``, so that a key with a third of all usage is no single task.
    """
    match = [F.col(name) == value for name, value in keys.items()] + ([] if also is None else [also])
    if rules.limit(rule_rows + 1).count() <= rule_rows:
        return usage.join(F.broadcast(rules), reduce(and_, match), "left").drop(*keys)
    salted = rules.withColumn("_rule_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = usage.withColumn("_salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
    match.append(F.col("_rule_salt") == F.col("_salt"))
    return spread.join(salted, reduce(and_, match), "left").drop(*keys, "_rule_salt", "_salt")
