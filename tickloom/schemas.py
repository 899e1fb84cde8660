"""Canonical table schemas and the column names other sources use for the same things."""

from pyspark.sql import types as T

D, L, S, TS = T.DoubleType(), T.LongType(), T.StringType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


BARS = _struct(date=T.DateType(), tic=S, open=D, high=D, low=D, close=D, volume=D)
NEWS = _struct(published_at=TS, source_name=S, headline=S, description=S, api_source=S, url=S, raw_data=S)
ARTICLES = _struct(id=S, ticker=S, date=S, headline=S, summary=S, content=S)
INSTRUCTIONS = _struct(instruction=S, input=S, output=S)
ACCOUNT = _struct(date=T.DateType(), account_value=D)
METRICS = _struct(run=S, key=S, value=D, step=L)

PRIMARY_PAYLOAD = _struct(
    publishedAt=S, source=_struct(name=S), title=S, description=S, url=S
)
SECONDARY_PAYLOAD = _struct(datetime=L, source=S, headline=S, summary=S, url=S, id=L)

# Other names of canonical columns.
ALIASES = {"symbol": "tic", "ticker": "tic", "time": "date", "adj close": "adj_close"}
OHLCV = ("open", "high", "low", "close", "volume")
