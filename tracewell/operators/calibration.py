"""Base-rate forecasts of votes and their calibration, all members and models in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEAST_VOTES, LEAST_TEST, TRAIN_SHARE, EPS = 20, 3, 0.7, 1e-6
#: The models, in the order that breaks ties.
MODELS = ("naive-half", "always-yes", "historical-rate", "laplace-smoothed", "party-class-rate")


def split(votes: DataFrame) -> DataFrame:
    """Binary votes with ``is_train``: a member's first 70 % by date, then vote id. Members with fewer than 20, or 3 to test, are left out."""
    binary = votes.where(F.col("position").isin("yea", "nay")).withColumn("actual", (F.col("position") == "yea").cast("int"))
    by = Window.partitionBy("member_id")
    n, nth = F.count("*").over(by), F.row_number().over(by.orderBy("vote_date", "vote_id"))
    rows = binary.withColumn("n", n).withColumn("nth", nth).withColumn("cut", F.floor(F.col("n") * TRAIN_SHARE))
    return rows.where((F.col("n") >= LEAST_VOTES) & (F.col("n") - F.col("cut") >= LEAST_TEST)).withColumn("is_train", F.col("nth") <= F.col("cut"))


def predictions(votes: DataFrame, members: DataFrame) -> DataFrame:
    """(member_id, model, p): the class rate blends a member's own rate with that of its party and chamber, the member left out."""
    own = split(votes).where("is_train").groupBy("member_id").agg(F.sum("actual").alias("yeas"), F.count("*").alias("total"))
    binary = votes.where(F.col("position").isin("yea", "nay"))
    each = members.select("member_id", "party", "chamber").join(
        binary.groupBy("member_id").agg(F.count_if(F.col("position") == "yea").alias("y"), F.count("*").alias("t")), "member_id", "left"
    )
    groups = each.groupBy(F.col("party").alias("_party"), F.col("chamber").alias("_chamber")).agg(F.sum(F.coalesce("y", F.lit(0))).alias("_y"), F.sum(F.coalesce("t", F.lit(0))).alias("_t"), F.count("*").alias("_n"))
    with_peers = each.join(groups, F.expr("party <=> _party and chamber <=> _chamber")).select(
        "member_id", (F.col("_y") - F.coalesce("y", F.lit(0))).alias("peer_y"), (F.col("_t") - F.coalesce("t", F.lit(0))).alias("peer_t"), (F.col("_n") - 1).alias("n_peers")
    )
    rows = own.join(with_peers, "member_id")
    own_rate = F.col("yeas") / F.col("total")
    peer_rate = F.when(F.col("peer_t") > 0, F.col("peer_y") / F.col("peer_t")).otherwise(0.5)
    weight = F.least(F.col("total") / 50, F.lit(1.0))
    ps = (F.lit(0.5), F.lit(1.0), own_rate, (F.col("yeas") + 1) / (F.col("total") + 2), weight * own_rate + (1 - weight) * peer_rate)
    listed = F.array(*(F.struct(F.lit(i).alias("ordinal"), F.lit(m).alias("model"), p.cast("double").alias("p")) for i, (m, p) in enumerate(zip(MODELS, ps))))
    return rows.select("member_id", "n_peers", F.inline(listed)).where((F.col("model") != "party-class-rate") | (F.col("n_peers") > 0)).drop("n_peers")


def scored(votes: DataFrame, members: DataFrame) -> DataFrame:
    """(member_id, model, ordinal, test size, brier, log loss, accuracy, mean prediction, actual rate), rounded to 4."""
    p, actual = F.col("p"), F.col("actual")
    loss = -(actual * F.log(F.greatest(p, F.lit(EPS))) + (1 - actual) * F.log(F.greatest(1 - p, F.lit(EPS))))
    rows = split(votes).where("not is_train").join(predictions(votes, members), "member_id")
    r = lambda c: F.round(F.avg(c), 4)
    return rows.groupBy("member_id", "model", "ordinal").agg(
        F.count("*").alias("sample_size"),
        r((p - actual) * (p - actual)).alias("brier_score"),
        r(loss).alias("log_loss"),
        r(((p >= 0.5).cast("int") == actual).cast("int")).alias("accuracy"),
        r(p).alias("mean_prediction"),
        r(actual).alias("actual_rate"),
    )


def buckets(votes: DataFrame, members: DataFrame) -> DataFrame:
    """(model, bucket, actual_rate, n) over all members: ten buckets of the prediction, the last with its upper end; empty ones are left out."""
    rows = split(votes).where("not is_train").join(predictions(votes, members), "member_id")
    bucket = F.least(F.floor(F.col("p") * 10), F.lit(9)).cast("int").alias("bucket")
    return rows.groupBy("model", bucket).agg(F.round(F.avg("actual"), 3).alias("actual_rate"), F.count("*").alias("n"))


def best_model(scores: DataFrame) -> DataFrame:
    """(member_id, best_model): the lowest Brier score, the first of equal ones."""
    return scores.groupBy("member_id").agg(F.min_by("model", F.struct("brier_score", "ordinal")).alias("best_model"))


def skips(votes: DataFrame) -> DataFrame:
    """(member_id, binary_votes, warning) for members that are not scored."""
    n = votes.groupBy("member_id").agg(F.count_if(F.col("position").isin("yea", "nay")).alias("binary_votes"))
    few: Column = F.col("binary_votes") < LEAST_VOTES
    small = F.col("binary_votes") - F.floor(F.col("binary_votes") * TRAIN_SHARE) < LEAST_TEST
    return n.where(few | small).withColumn("warning", F.when(few, "insufficient sample").otherwise("test set too small"))
