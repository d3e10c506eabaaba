"""The exchange's trade feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.decimals import exact_decimal, required, whole_number
from tickloom.functions.streams import stream_symbol
from tickloom.schema import PRICE

# A map and not a struct: trade time ``T`` and trade id ``t`` differ by case only.
_MESSAGE = "stream STRING, data MAP<STRING, STRING>"


def normalize_trades(messages: DataFrame, raw: str = "raw", arrival: Column | None = None) -> DataFrame:
    """Trade messages to ticks, batch or streaming; acknowledgements carry no ``stream`` and go.

    ``routing_symbol`` comes from the stream name, ``symbol`` from the trade itself.
    """
    parsed = F.array(F.from_json(raw, _MESSAGE, {"mode": "FAILFAST"}))
    # A filter on the parsed column would be pushed below it and parse every message twice.
    columns = [F.explode(F.filter(parsed, lambda m: m["stream"].isNotNull())).alias("m")]
    if arrival is not None:
        columns.append(arrival.cast("long").alias("arrival"))
    trades = messages.select(*columns)

    def field(name: str, typed: Callable[[Column], Column] = lambda text: text, data_type="string") -> Column:
        return required(typed(F.try_element_at(F.col("m.data"), F.lit(name))), name, data_type)

    return trades.select(
        stream_symbol(F.col("m.stream")).alias("routing_symbol"),
        field("s").alias("symbol"),
        field("p", exact_decimal, PRICE).alias("price"),
        field("q", exact_decimal, PRICE).alias("quantity"),
        field("T", whole_number, "long").alias("timestamp"),
        field("t", whole_number, "long").alias("trade_id"),
        *(["arrival"] if arrival is not None else []),
    )
