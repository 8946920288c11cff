"""Trade classification: venue, side and retail status of each trade against the quote as of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import Classification
from tickloom.functions.market import is_lit, is_trade, is_trf, retail_status, sign, usd, venue
from tickloom.schema import DAY, UNDEFINED_PRICE


def with_classes(records: DataFrame, c: Classification = Classification()) -> DataFrame:
    """Adds is_trade, price (0 if undefined), venue, trf, lit, direction and retail; records have the quote columns."""
    nano = F.col("price_nano")
    priced = F.coalesce((nano != UNDEFINED_PRICE) & (nano > 0), F.lit(False))
    out = records.withColumns({"is_trade": is_trade(F.col("action")), "priced": priced, "price": F.when(priced, usd(nano)).otherwise(0.0), "venue": venue(F.col("publisher_id")), "trf": is_trf(F.col("publisher_id")), "lit": is_lit(F.col("publisher_id"))})
    seen = F.col("priced") & F.col("trf") & F.col("bbo_valid")
    direction = F.when(seen, sign(F.col("price"), F.col("mid"), F.col("spread"), F.col("bbo_valid"), c.exclusion_band)).otherwise("Unsigned")
    retail = F.when(~F.col("priced"), "Unknown").when(~F.col("trf"), "Institutional").when(~F.col("bbo_valid"), "Unknown").otherwise(retail_status(F.col("price"), c))
    return out.withColumns({"direction": direction, "retail": retail})


def class_counters(trades: DataFrame) -> DataFrame:
    """Per day: the classifier's nine counters and two rates."""
    n = F.count_if
    direction, retail = F.col("direction"), F.col("retail")
    sums = trades.groupBy(*DAY).agg(
        F.count("*").alias("total_trades"),
        n("trf").alias("trf_trades"),
        n(direction == "Buy").alias("signed_buy"),
        n(direction == "Sell").alias("signed_sell"),
        n(direction == "Unsigned").alias("unsigned"),
        n(retail == "Retail").alias("retail_count"),
        n(retail == "Institutional").alias("institutional_count"),
        n(retail == "Unknown").alias("unknown_count"),
        n(~F.col("priced")).alias("invalid_price_count"),
    )
    trf = F.greatest("trf_trades", F.lit(1)).cast("double")
    trf_unsigned = F.greatest(F.col("unsigned") - (F.col("total_trades") - F.col("trf_trades")), F.lit(0))
    return sums.withColumns({"retail_rate": F.col("retail_count") / trf, "trf_unsigned_rate": F.when(F.col("trf_trades") == 0, 0.0).otherwise(trf_unsigned / trf)})
