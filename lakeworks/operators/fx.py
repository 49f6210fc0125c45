"""Currency normalisation (F1).

The FX frame holds one row per (currency pair, calendar day). It is shuffled on
its own first, so that its measured size, not an estimate, decides whether the
join broadcasts it; the fact is shuffled only beyond the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize_currency(df: DataFrame, fx: DataFrame, amounts: dict[str, str], ccy_col: str,
                       date_col: str, to: str = "USD", scale: int = 2, missing: str = "one",
                       rate_col: str = "fx_rate_to_usd") -> DataFrame:
    """Add ``out = CAST(in * COALESCE(rate, 1.0) AS DECIMAL(18, scale))``.

    ``missing="one"`` keeps the reference default (no rate -> 1.0, also for
    USD which has no USD->USD row); ``missing="null"`` leaves NULL.
    """
    rates = fx.filter(F.col("to_currency") == to).select(
        F.col("from_currency").alias("__fx_from"), F.col("rate_date").alias("__fx_date"),
        F.col("fx_rate").alias(rate_col)).repartition("__fx_from", "__fx_date")
    j = df.join(rates, (F.col(ccy_col) == F.col("__fx_from")) & (F.col(date_col) == F.col("__fx_date")),
                "left").drop("__fx_from", "__fx_date")
    rate = F.coalesce(F.col(rate_col), F.lit(1.0).cast("decimal(2,1)")) if missing == "one" else F.col(rate_col)
    for out, src in amounts.items():
        j = j.withColumn(out, (F.col(src) * rate).cast(f"decimal(18,{scale})"))
    return j
