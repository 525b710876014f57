"""Time expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970; a time without zone is counted as it stands."""
    if not isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.unix_micros(name)
    # Field by field, since differences would be taken in the session's time zone.
    day = F.unix_date(F.to_date(name)).cast("long")
    minutes = (day * 24 + F.hour(name)) * 60 + F.minute(name)
    seconds = F.extract(F.lit("SECOND"), F.col(name))
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("long")


def epoch_millis(df: DataFrame, name: str) -> Column:
    if not isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.unix_millis(name)
    return F.floor(epoch_micros(df, name) / F.lit(1000)).cast("long")
