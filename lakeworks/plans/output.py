"""Report shaping shared by every registered query.

Measures leave the lake as DOUBLE (money rounded to its scale), integral
columns as BIGINT and string arrays as comma-joined strings, so the results
hash the same in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StringType):
            c = F.concat_ws(",", c)
        cols.append(c.alias(f.name))
    return df.select(*cols)
