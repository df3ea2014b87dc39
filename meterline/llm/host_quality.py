"""Quality rules whose failures are judged by host.

Each text is measured and tested by fixed rules.  Failures are counted by host, a host's rate is shrunk towards the
common rate by a beta prior fitted to all hosts, and hosts that mostly fail lose all their texts.  Everything is made of
Spark's own functions.

Rows: a NULL text has no words and fails; NULL is a host of its own; repeated rows are measured and counted each; a table
without rows gives none.  Texts are measured whole.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import let, small, words, written

#: A text with fewer words fails.
LEAST_WORDS = 50
#: A text fails if more than this percentage of its words lie in three-word windows that it repeats.
MOST_REPEATED = 50
#: A text fails if it has more symbols than this percentage of its words.
MOST_SYMBOLS = 30
#: A host is rejected if its shrunk failure rate is above this percentage.
MOST_FAILED = 50
#: The prior weighs at least as much as this many texts.
LEAST_PRIOR = 1.0

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(found: Column) -> Column:
    """Words inside three-word windows that occur at least twice among the words ``found``."""
    starts = F.sequence(F.lit(0), F.size(found) - 3)
    windows = F.transform(
        starts,
        lambda i: F.struct(
            F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)).alias("window"), i.alias("at")
        ),
    )

    def repeated(ordered: Column) -> Column:
        """Starts, in the order of the text, of windows with an equal neighbour in the sorted array."""
        same = lambda one, other: F.get(ordered, one)["window"] == F.get(ordered, other)["window"]
        equal = lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False))
        chosen = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), equal)
        return F.array_sort(F.transform(chosen, lambda k: F.get(ordered, k)["at"]))

    def covered(at: Column) -> Column:
        """A window covers three words, or as many as there are before the next one starts."""
        each = F.transform(at, lambda start, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - start, F.lit(3))))
        return F.aggregate(each, F.lit(0), lambda a, b: a + b)

    count = let(F.sort_array(windows), lambda ordered: let(repeated(ordered), covered))
    return F.when(F.size(found) < 4, F.lit(0)).otherwise(count)


def measure(docs: DataFrame, text: str, *carried: str) -> DataFrame:
    """The carried columns and the five measures of each text, as bigint."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    found = F.col("_words")
    measures = {
        "n_words": F.size(found),
        "word_chars": F.length(F.array_join(found, "")),
        "n_symbols": F.length(F.regexp_replace(whole, f"[^{SYMBOLS}]+", "")),
        "n_dup_lines": let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))),
        "n_repeat_words": _repeat_words(found),
    }
    carrying = list(dict.fromkeys([*carried, text]))
    with_words = docs.select(*[F.col(name) for name in carrying], words(F.col(text)).alias("_words"))
    return with_words.select(*carried, *[value.cast("bigint").alias(name) for name, value in measures.items()])


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def rule_failed() -> Column:
    """Any rule failed: too few words, too much repeated, or too many symbols."""
    return base_failed() | (100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("n_words"))


def host_verdicts(judged: DataFrame, host: str, failed: str) -> DataFrame:
    """(host, texts, failures, shrunk_rate, host_rejected) for each host, of which NULL is one.

    The prior has the mean of the hosts' rates and the strength that explains their variance (method of moments).  One
    row with both comes back to the driver.
    """
    hosts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("texts"), F.sum(F.col(failed).cast("bigint")).alias("failures")
    )
    hosts = written(hosts, "hosts")
    rate = F.col("failures") / F.col("texts")
    row = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("variance")).first()
    mean, variance = row["mean"] or 0.0, row["variance"] or 0.0
    if variance > 0:
        strength = max(mean * (1 - mean) / variance - 1, LEAST_PRIOR)
        shrunk = (F.col("failures") + F.lit(strength * mean)) / (F.col("texts") + F.lit(strength))
    else:
        shrunk = F.lit(mean)
    hosts = hosts.withColumn("shrunk_rate", shrunk)
    return hosts.withColumn("host_rejected", 100 * F.col("shrunk_rate") > F.lit(float(MOST_FAILED)))


def judge_by_host(docs: DataFrame, text: str, host: str, *carried: str) -> DataFrame:
    """The carried columns, the measures, ``base_failed``, ``rule_failed``, ``host_rejected`` and ``kept``.

    Measured once into a table in the shared folder.  Host verdicts are broadcast while they are few; beyond that they
    are joined by shuffle, where adaptive execution splits the texts of a hot host.  Carried columns must not be named
    like the results.
    """
    carrying = list(dict.fromkeys([*carried, host]))
    measured = measure(docs, text, *carrying)
    judged = written(measured.withColumns({"base_failed": base_failed(), "rule_failed": rule_failed()}), "measured")
    verdicts = written(host_verdicts(judged, host, "rule_failed").select("host", "host_rejected"), "verdicts")
    joined = judged.join(small(verdicts), judged[host].eqNullSafe(verdicts["host"]))
    kept = ~F.col("rule_failed") & ~F.col("host_rejected")
    return joined.withColumn("kept", kept).select(
        *carried, *MEASURES, "base_failed", "rule_failed", "host_rejected", "kept"
    )
