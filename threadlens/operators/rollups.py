"""Consumer-side aggregates of the decision output (an addition, not a
reference operator). Partial aggregation happens map-side, so hot groups
are combined before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sentiment_shares(df: DataFrame, by: Sequence[str],
                     pred_col: str = "final_sentiment_prediction",
                     subtotals: bool = False) -> DataFrame:
    """Counts per sentiment and the positive/negative shares per group.

    ``subtotals=True`` adds ROLLUP rows (NULL in the rolled-up keys, plus a
    ``grouping_level`` bit mask) in the same single aggregation.
    """
    p = F.col(pred_col)
    grouped = df.rollup(*by) if subtotals else df.groupBy(*by)
    aggs = [F.count(F.lit(1)).alias("n"),
            F.count_if(p == 1).alias("n_positive"),
            F.count_if(p == 0).alias("n_neutral"),
            F.count_if(p == -1).alias("n_negative")]
    if subtotals:
        aggs.append(F.grouping_id(*by).alias("grouping_level"))
    out = grouped.agg(*aggs)
    return out.withColumns({
        "share_positive": F.round(F.col("n_positive") / F.col("n"), 6),
        "share_negative": F.round(F.col("n_negative") / F.col("n"), 6)})
