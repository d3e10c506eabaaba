"""Names of trade streams and messages about them."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def stream_name(symbol: Column) -> Column:
    return F.concat(F.lower(symbol), F.lit("@trade"))


def stream_symbol(stream: Column) -> Column:
    return F.upper(F.split_part(stream, F.lit("@"), F.lit(1)))


def short_id(identifier: Column) -> Column:
    return F.left(identifier, F.lit(8))


def subscribe_message(symbols: Column) -> Column:
    """Reply to a subscribe request that lists ``symbols``."""
    upper = F.transform(symbols, F.upper)
    return F.concat(F.lit("Subscribed to "), F.array_join(upper, ", "))


def unsubscribe_message(symbols: Column) -> Column:
    upper = F.transform(symbols, F.upper)
    return F.concat(F.lit("Unsubscribed from "), F.array_join(upper, ", "))
