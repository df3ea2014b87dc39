"""Usage against the client table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions import charges


def _payer(usage: DataFrame) -> DataFrame:
    return usage.withColumn("payer", charges.paying_user())


def _client_keys(clients: DataFrame) -> DataFrame:
    return clients.select(F.col("user_id").alias("payer"))


def usage_of_known_clients(usage: DataFrame, clients: DataFrame) -> DataFrame:
    """Usage is the left side, whose skewed partitions adaptive execution may split."""
    return _payer(usage).join(_client_keys(clients), "payer", "left_semi")


def usage_of_unknown_clients(usage: DataFrame, clients: DataFrame) -> DataFrame:
    return _payer(usage).join(_client_keys(clients), "payer", "left_anti")


def clients_without_usage(usage: DataFrame, clients: DataFrame) -> DataFrame:
    """Payers are reduced to one row each before the shuffle: a skewed right side could not be split."""
    payers = _payer(usage).select(F.col("payer").alias("user_id")).distinct()
    return clients.join(payers, "user_id", "left_anti")
