"""Scoring spots for abnormal response."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotlift.functions.quantile import exact_quantile
from spotlift.functions.response import response_segment
from spotlift.operators.isolation_forest import Forest, fit_forest, with_raw_score
from spotlift.operators.scaling import Scaler
from spotlift.session import materialise

# Parameters of the forest.
TREES = 100
SAMPLE = 256
CONTAMINATION = 0.25
SEED = 42

KEY = ("spot_id", "campaign_id", "channel_id", "spot_ts")
FEATURES = (
    "pre_spot_sessions", "post_spot_sessions", "incremental_lift_pct", "attributed_sessions", "budget",
)
SCORE_COLUMNS = (*KEY, *FEATURES, "anomaly_score", "is_abnormal_response", "response_segment")


def ml_features(effectiveness: DataFrame) -> DataFrame:
    """Keys and features of every spot, nulls as zero."""
    types = dict(effectiveness.dtypes)
    return effectiveness.select(*KEY, *[F.coalesce(c, F.lit(0).cast(types[c])).alias(c) for c in FEATURES])


def with_segment(scored: DataFrame) -> DataFrame:
    return scored.withColumn("response_segment", response_segment("incremental_lift_pct", "is_abnormal_response"))


def _raw_scored(features: DataFrame, forest: Forest) -> DataFrame:
    return with_raw_score(features, forest).withColumn("raw_score", F.round("raw_score", 12))


@dataclass(frozen=True)
class ResponseModel:
    """Fitted forest, the scaling of its training data and the score that splits off abnormal spots."""

    forest: Forest
    scaler: Scaler
    offset: float

    def apply(self, raw_scored: DataFrame) -> DataFrame:
        # Rounded, and then free of a negative zero, so that the order of additions cannot move a spot across the border.
        score = F.round(F.col("raw_score") - F.lit(self.offset), 10) + F.lit(0.0)
        flagged = raw_scored.withColumn("anomaly_score", score).withColumn(
            "is_abnormal_response", F.when(F.col("anomaly_score") < 0, 1).otherwise(0)
        )
        return with_segment(flagged).select(*SCORE_COLUMNS)

    def score(self, features: DataFrame) -> DataFrame:
        return self.apply(_raw_scored(features, self.forest))

    def save(self, spark: SparkSession, folder: str) -> None:
        self.forest.to_spark(spark).write.mode("overwrite").parquet(f"{folder}/trees")
        parameters = [
            (i, c, self.scaler.mean[c], self.scaler.std[c], self.offset, self.forest.sample_size)
            for i, c in enumerate(self.forest.features)
        ]
        schema = "position int, feature string, mean double, std_pop double, offset double, sample_size int"
        spark.createDataFrame(parameters, schema).write.mode("overwrite").parquet(f"{folder}/parameters")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> ResponseModel:
        rows = spark.read.parquet(f"{folder}/parameters").orderBy("position").collect()
        nodes = spark.read.parquet(f"{folder}/trees").orderBy("tree_id", "node_id").toPandas()
        forest = Forest(tuple(r.feature for r in rows), rows[0].sample_size, nodes)
        scaler = Scaler({r.feature: r["mean"] for r in rows}, {r.feature: r.std_pop for r in rows})
        return cls(forest, scaler, rows[0].offset)


def score_responses(
    effectiveness: DataFrame,
    trees: int = TREES,
    sample: int = SAMPLE,
    contamination: float = CONTAMINATION,
    seed: int = SEED,
) -> tuple[ResponseModel, DataFrame]:
    """Fit on all spots and score them; the lowest ``contamination`` share is abnormal.

    The features and the raw scores are read several times and therefore materialised; both
    have one row per spot.
    """
    features = materialise(ml_features(effectiveness))
    if features.isEmpty():
        raise ValueError("No campaign effectiveness data to score.")
    forest = fit_forest(features, FEATURES, KEY, trees, sample, seed)
    raw = materialise(_raw_scored(features, forest))
    offset = exact_quantile(raw, "raw_score", contamination)
    model = ResponseModel(forest, Scaler.fit(features, FEATURES), offset)
    return model, model.apply(raw)
