"""One full refresh: ingest, transform, gate, export, score, export the scores.

Every stage hands its result on as a catalog table. A failed quality gate stops the run after
its results are stored and before anything is exported.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from spotlift.operators.staging import STAGING_VIEWS
from spotlift.plans import marts
from spotlift.plans.ingest import ingest
from spotlift.plans.quality_gate import dq_results, enforce
from spotlift.plans.scoring import ResponseModel, score_responses
from spotlift.sources.catalog import replace_table, replace_view, row_counts
from spotlift.sources.csv_files import write_csv

CANDIDATES = "intermediate.int_session_campaign_candidates"
ATTRIBUTED = "intermediate.int_attributed_sessions"
PRE_POST = "intermediate.int_pre_post_spot_sessions"
FACT = "marts.fact_campaign_sessions"
EFFECTIVENESS = "marts.mart_campaign_effectiveness"
ODEC = "marts.odec_ready_campaign_dataset"
DQ_RESULTS = "dq.dq_results"
SCORES = "ml.ml_campaign_response_scores"

#: Exported table and its folder under the output root.
EXPORTS = {
    ODEC: "odec_ready/odec_ready_campaign_dataset.csv",
    EFFECTIVENESS: "powerbi/campaign_effectiveness.csv",
    FACT: "powerbi/fact_campaign_sessions.csv",
}
SCORE_EXPORTS = ("ml/ml_campaign_response_scores.csv", "powerbi/ml_campaign_response_scores.csv")


@dataclass(frozen=True)
class RunConfig:
    source_root: str
    output_root: str
    model_folder: str
    #: The pairs table is not needed by any mart and can be far larger than its inputs.
    publish_candidates: bool = False


def stage(spark: SparkSession) -> dict[str, DataFrame]:
    return {v: replace_view(spark, v, table, columns) for v, (table, columns) in STAGING_VIEWS.items()}


def transform(spark: SparkSession, publish_candidates: bool = False) -> DataFrame:
    """Build staging views, intermediate tables and marts; returns their row counts.

    Without candidates, those that an earlier run left are dropped: they would no longer fit.
    """
    staged = stage(spark)
    spots, sessions = staged["staging.stg_grp_spots"], staged["staging.stg_sessions"]
    campaigns, channels = staged["staging.stg_campaign_master"], staged["staging.stg_odec_mapping"]

    built = {}
    if publish_candidates:
        built[CANDIDATES] = replace_table(marts.session_spot_candidates(sessions, spots), CANDIDATES)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {CANDIDATES}")
    attributed = marts.attributed_sessions(marts.nearest_spots(sessions, spots))
    built[ATTRIBUTED] = replace_table(attributed, ATTRIBUTED)
    built[PRE_POST] = replace_table(marts.pre_post_spot_sessions(sessions, spots), PRE_POST)
    fact = marts.fact_campaign_sessions(built[ATTRIBUTED], campaigns, channels)
    built[FACT] = replace_table(fact, FACT)
    effectiveness = marts.campaign_effectiveness(built[PRE_POST], built[FACT], campaigns, channels)
    built[EFFECTIVENESS] = replace_table(effectiveness, EFFECTIVENESS)
    built[ODEC] = replace_table(marts.odec_ready_dataset(built[FACT]), ODEC)
    return row_counts(built)


def gate(spark: SparkSession) -> DataFrame:
    """Store the data-quality results, then raise if any check failed."""
    tables = {t: spark.table(t) for t in ("raw.grp_spots", "raw.sessions", FACT, EFFECTIVENESS)}
    results = replace_table(dq_results(tables), DQ_RESULTS)
    enforce(results)
    return results


def export_marts(spark: SparkSession, output_root: str) -> None:
    for table, path in EXPORTS.items():
        write_csv(spark.table(table), f"{output_root}/{path}")


def score(spark: SparkSession, output_root: str, model_folder: str) -> ResponseModel:
    model, scores = score_responses(spark.table(EFFECTIVENESS))
    published = replace_table(scores, SCORES)
    model.save(spark, model_folder)
    for path in SCORE_EXPORTS:
        write_csv(published, f"{output_root}/{path}")
    return model


def run_daily(spark: SparkSession, config: RunConfig) -> None:
    ingest(spark, config.source_root)
    transform(spark, config.publish_candidates).show(truncate=False)
    gate(spark)
    export_marts(spark, config.output_root)
    score(spark, config.output_root, config.model_folder)
