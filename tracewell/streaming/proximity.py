"""The proximity join over a stream of trades against a table of votes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tracewell.operators.proximity import band_join, gap_columns


def near_votes_stream(trades: DataFrame, votes: DataFrame, window: int = 180) -> DataFrame:
    """Pairs of streamed trades with stored votes of the same member within the window: a stream-static join, so no state is kept."""
    pairs = band_join(trades, votes, ["member_id"], "tx_date", "vote_date", window)
    return pairs.select("*", *gap_columns("tx_date", "vote_date"))


def write_near_votes(pairs: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append pairs to Parquet, each trade's once; runs until what has arrived is processed."""
    return pairs.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
