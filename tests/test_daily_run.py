from __future__ import annotations

import datetime
import pathlib

import pytest
from conftest import RAW_FILES, write_raw_files
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from spotlift.plans import daily_run, qa_report
from spotlift.plans.daily_run import RunConfig, run_daily
from spotlift.plans.ingest import AUDIT_TABLE, ingest
from spotlift.plans.qa_report import QaConfig, QaError, run_qa
from spotlift.plans.quality_gate import QualityGateError, total_failures, worst_first
from spotlift.sources import catalog
from spotlift.sources.csv_files import discover, read_text_columns, require_paths, write_csv

# Results known for the bundled files.
EFFECTIVENESS = {
    "S001": (2, 4, 100.0, 4, 500000.0),
    "S002": (1, 2, 100.0, 2, 500000.0),
    "S003": (2, 1, -50.0, 1, 350000.0),
    "S004": (2, 5, 150.0, 5, 200000.0),
}
ATTRIBUTION = {
    "SESS003": ("S001", 1), "SESS004": ("S001", 4), "SESS005": ("S001", 7), "SESS006": ("S001", 13),
    "SESS008": ("S002", 5), "SESS009": ("S002", 10), "SESS012": ("S003", 6), "SESS015": ("S004", 1),
    "SESS016": ("S004", 4), "SESS017": ("S004", 8), "SESS018": ("S004", 11), "SESS019": ("S004", 14),
}
TABLE_ROWS = {
    "raw.campaign_master": 3, "raw.grp_spots": 4, "raw.odec_mapping": 3, "raw.sessions": 19,
    "staging.stg_campaign_master": 3, "staging.stg_grp_spots": 4, "staging.stg_odec_mapping": 3,
    "staging.stg_sessions": 19, "intermediate.int_session_campaign_candidates": 12,
    "intermediate.int_attributed_sessions": 12, "intermediate.int_pre_post_spot_sessions": 4,
    "marts.fact_campaign_sessions": 12, "marts.mart_campaign_effectiveness": 4,
    "marts.odec_ready_campaign_dataset": 12,
}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    config = RunConfig(write_raw_files(base / "raw"), str(base / "out"), str(base / "model"), publish_candidates=True)
    run_daily(spark, config)
    return config


def test_effectiveness_matches_known_results(spark, run):
    rows = spark.table(daily_run.EFFECTIVENESS).collect()
    got = {
        r.spot_id: (r.pre_spot_sessions, r.post_spot_sessions, r.incremental_lift_pct, r.attributed_sessions, r.budget)
        for r in rows
    }
    assert got == EFFECTIVENESS


def test_fact_matches_known_results(spark, run):
    rows = spark.table(daily_run.FACT).collect()
    assert {r.session_id: (r.spot_id, r.minutes_after_spot) for r in rows} == ATTRIBUTION
    first = next(r for r in rows if r.session_id == "SESS008")
    assert first.asDict() == {
        "session_id": "SESS008", "user_id": "U008", "session_ts": datetime.datetime(2026, 4, 20, 21, 5, 30),
        "spot_id": "S002", "campaign_id": "CAMP001", "campaign_name": "Festival Mega Sale", "brand": "BrandA",
        "channel_id": "TV01", "odec_channel_code": "ODEC_TV_001", "channel_name": "Star Plus", "channel_type": "TV",
        "spot_ts": datetime.datetime(2026, 4, 20, 21, 0), "minutes_after_spot": 5, "grp_value": 5.2,
        "attribution_flag": 1,
    }


def test_all_tables_have_their_rows(spark, run):
    counts = catalog.row_counts({t: spark.table(t) for t in TABLE_ROWS}).collect()
    assert {r.table_name: r.row_count for r in counts} == TABLE_ROWS


def test_mart_types(spark, run):
    types = dict(spark.table(daily_run.FACT).dtypes)
    assert types["spot_ts"] == types["session_ts"] == "timestamp_ntz"
    assert (types["minutes_after_spot"], types["grp_value"], types["attribution_flag"]) == ("bigint", "double", "int")
    types = dict(spark.table(daily_run.EFFECTIVENESS).dtypes)
    assert {types[c] for c in ("pre_spot_sessions", "post_spot_sessions", "attributed_sessions")} == {"bigint"}


def test_scores(spark, run):
    rows = spark.table(daily_run.SCORES).collect()
    assert len(rows) == 4
    abnormal = [r for r in rows if r.is_abnormal_response]
    assert len(abnormal) == 1
    # Linear interpolation at position 0.75 of four scores: the lowest is minus three times the next.
    scores = sorted(r.anomaly_score for r in rows)
    assert scores[0] == pytest.approx(-3 * scores[1])


def test_exports(spark, run):
    lines = set()
    for part in pathlib.Path(run.output_root, "powerbi/campaign_effectiveness.csv").glob("part-*"):
        lines |= set(part.read_text().splitlines())
    assert (
        "S003,CAMP002,Prime Time Awareness,BrandB,TV02,Zee TV,TV,2026-04-21 19:45:00,2,1,-50.0,1,350000.0" in lines
    )
    for path in (*daily_run.EXPORTS.values(), *daily_run.SCORE_EXPORTS):
        exported = read_text_columns(spark, f"{run.output_root}/{path}")
        table = {p: t for t, p in daily_run.EXPORTS.items()}.get(path, daily_run.SCORES)
        assert exported.columns == spark.table(table).columns
        assert exported.count() == spark.table(table).count()


def test_audit_log_and_gate_results(spark, run):
    log = spark.table(AUDIT_TABLE).where(F.col("file_path").startswith(run.source_root)).collect()
    assert {(r.table_name, r.row_count, r.status) for r in log} == {
        (t, n, "SUCCESS") for t, n in TABLE_ROWS.items() if t.startswith("raw.")
    }
    results = spark.table(daily_run.DQ_RESULTS)
    assert results.count() == 7
    assert total_failures(results).first().total_failures == 0


def test_qa_report_of_a_good_run(spark, run, tmp_path):
    report = run_qa(spark, run.source_root, str(tmp_path / "qa.csv"), QaConfig(expected_tables=qa_report.EXPECTED_TABLES))
    rows = {r.check_name: (r.status, r.details) for r in report.collect()}
    assert {s for s, _ in rows.values()} == {"PASSED"}
    assert rows["File not empty: grp_spots/grp_spots.csv"] == ("PASSED", "File exists and size=261 bytes")
    assert rows["File not empty: odec/odec_mapping.csv"] == ("PASSED", "File exists and size=149 bytes")
    assert rows["Raw row count: sessions/sessions.csv"] == ("PASSED", "Actual rows=19")
    for table, n in TABLE_ROWS.items():
        assert rows[f"Table exists: {table}"] == ("PASSED", f"Rows={n}")
    assert rows["Null check: raw.grp_spots.spot_id"] == ("PASSED", "No null primary keys")
    assert rows["Duplicate check: raw.sessions.session_id"] == ("PASSED", "No duplicate primary keys")
    assert rows["ML output row count"] == ("PASSED", "ml.ml_campaign_response_scores rows=4")
    assert "Attribution-window logic" in rows and "Incremental lift null check" in rows and "ML score bounds" in rows
    assert report.columns == ["check_name", "status", "details", "checked_at"]


def test_qa_failures_are_reported_before_the_run_fails(spark, run, tmp_path):
    numbers = {"spot_id": "number", "grp_value": "number", "campaign_id": "string", "absent": "number"}
    config = QaConfig(
        required_files=("grp_spots/grp_spots.csv", "nowhere/x.csv"),
        minimum_rows={"sessions/sessions.csv": 20, "nowhere/x.csv": 1},
        expected_schemas={"grp_spots/grp_spots.csv": numbers, "nowhere/x.csv": {"a": "string"}},
        expected_tables=("raw.sessions", "raw.nothing"),
        primary_keys={"raw.grp_spots": "campaign_id", "raw.nothing": "id"},
        attribution_tables=("marts.nothing",),
        rate_columns=("incremental_lift_pct",),
        score_bounds=(0.0, 1.0),
    )
    path = str(tmp_path / "qa.csv")
    with pytest.raises(QaError):
        run_qa(spark, run.source_root, path, config)
    rows = {r.check_name: (r.status, r.details) for r in read_text_columns(spark, path).collect()}
    assert rows["File exists: nowhere/x.csv"][0] == "FAILED"
    assert rows["Schema columns: grp_spots/grp_spots.csv"] == ("FAILED", "Missing columns: ['absent']")
    assert rows["Extra columns: grp_spots/grp_spots.csv"][0] == "WARNING"
    assert rows["Column type: grp_spots/grp_spots.csv.spot_id"] == ("FAILED", "Expected numeric, invalid values=4")
    assert rows["Column type: grp_spots/grp_spots.csv.grp_value"][0] == "PASSED"
    assert rows["Column type: grp_spots/grp_spots.csv.campaign_id"][0] == "PASSED"
    assert rows["Schema check: nowhere/x.csv"][0] == "FAILED"
    assert rows["Raw row count: sessions/sessions.csv"] == ("FAILED", "Expected at least 20, actual=19")
    assert rows["Raw row count: nowhere/x.csv"] == ("FAILED", "File missing")
    assert rows["Table exists: raw.nothing"] == ("FAILED", "Table missing")
    assert rows["Duplicate check: raw.grp_spots.campaign_id"] == ("FAILED", "Duplicate key groups=1")
    assert rows["Null check: raw.nothing.id"] == ("FAILED", "Table missing")
    assert rows["Attribution table exists"][0] == "WARNING"
    assert rows["Incremental lift rate bounds"] == ("FAILED", "Rates outside 0-1 range=4")
    assert rows["ML score bounds"][0] == "FAILED"


def test_qa_fail_fast_stops_after_the_first_bad_group(spark, run, tmp_path):
    path = str(tmp_path / "qa.csv")
    with pytest.raises(QaError):
        run_qa(spark, run.source_root, path, QaConfig(required_files=("nowhere/x.csv",)), fail_fast=True)
    assert [r.check_name for r in read_text_columns(spark, path).collect()] == ["File exists: nowhere/x.csv"]


def test_empty_file_and_missing_columns_are_flagged(spark, run, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    got = qa_report.file_checks(spark, str(tmp_path), ["empty.csv"]).first()
    assert (got.check_name, got.status) == ("File not empty: empty.csv", "FAILED")
    odd = QaConfig(impression_column="a", lift_column="b", score_tables=("raw.sessions",))
    assert qa_report.attribution_checks(spark, odd)[0].first().status == "WARNING"
    assert qa_report.lift_checks(spark, odd)[0].first().status == "WARNING"
    assert qa_report.score_checks(spark, odd)[0].first().check_name == "ML probability column exists"


def test_attribution_window_counts_early_and_late_rows(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
           (timestamp_ntz'2024-01-01 23:59:00', timestamp_ntz'2024-01-08 00:00:00'),
           (timestamp_ntz'2024-01-01 23:59:00', timestamp_ntz'2024-01-09 00:00:00'),
           (timestamp_ntz'2024-01-02 00:00:00', timestamp_ntz'2024-01-01 00:00:00'),
           (timestamp_ntz'2024-01-02 00:00:00', cast(null as timestamp_ntz)) AS t(a, b)"""
    )
    assert qa_report.attribution_failures(df, "a", "b").first().invalid_rows == 2


def test_bounds_treat_null_as_asked(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (-0.1,), (None,)], "x double")
    assert qa_report.rate_failures(df, ["x"]).first().invalid_rows == 2
    assert qa_report.score_failures(df, "x", 0, 1).first().invalid_rows == 3
    assert qa_report.null_lift(df, "x").first().invalid_rows == 1


def test_key_profile_counts_nulls_and_duplicate_groups(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), (None,), ("b",)], "k string")
    assert tuple(qa_report.key_profile(df, "k").first()) == (3, 2)
    assert tuple(qa_report.key_profile(df.where("false"), "k").first()) == (0, 0)


# The tests below load other sources and come last: they replace the tables of the good run.


def test_missing_source_is_logged_and_nothing_is_loaded(spark, run, tmp_path):
    root = pathlib.Path(write_raw_files(tmp_path / "raw"))
    (root / "odec/odec_mapping.csv").unlink()
    before = spark.table("raw.sessions").select(F.max("ingestion_ts")).first()[0]
    with pytest.raises(FileNotFoundError, match="odec_mapping"):
        ingest(spark, str(root))
    assert spark.table("raw.sessions").select(F.max("ingestion_ts")).first()[0] == before
    log = spark.table(AUDIT_TABLE).where(F.col("file_path").startswith(str(root))).collect()
    assert [(r.table_name, r.status) for r in log] == [("raw.odec_mapping", "FAILED")]


def test_failed_gate_blocks_publication(spark, tmp_path):
    key = "sessions/sessions.csv"
    bad = RAW_FILES[key] + ",U020,2026-04-21 22:25:00,mobile,direct\nSESS021,U021,,mobile,direct\n"
    out = tmp_path / "out"
    config = RunConfig(write_raw_files(tmp_path / "raw", **{key: bad}), str(out), str(tmp_path / "model"))
    with pytest.raises(QualityGateError, match="Total failed rows: 2"):
        run_daily(spark, config)
    assert not out.exists()
    results = [(r.check_name, r.failed_rows) for r in worst_first(spark.table(daily_run.DQ_RESULTS)).collect()]
    assert dict(results)["session_id_not_null"] == dict(results)["session_timestamp_not_null"] == 1
    assert [n for _, n in results] == sorted((n for _, n in results), reverse=True)


def test_unparsable_value_fails_the_run(spark, tmp_path):
    key = "grp_spots/grp_spots.csv"
    root = write_raw_files(tmp_path / "raw", **{key: RAW_FILES[key].replace("4.5,30", "high,30")})
    with pytest.raises(NumberFormatException):
        ingest(spark, root)
    log = spark.table(AUDIT_TABLE).where(F.col("file_path").startswith(root)).collect()
    assert [(r.table_name, r.status) for r in log] == [("raw.grp_spots", "FAILED")]


def test_columns_are_matched_by_name_and_extra_ones_kept(spark, tmp_path):
    text = "channel_type,note,channel_id,channel_name,odec_channel_code\nTV,hi,TV01,Star Plus,ODEC_TV_001\n"
    root = write_raw_files(tmp_path / "raw", **{"odec/odec_mapping.csv": text})
    row = ingest(spark, root)["raw.odec_mapping"].first()
    assert (row.channel_id, row.channel_type, row.note) == ("TV01", "TV", "hi")


def test_unknown_campaigns_and_channels_stay_with_nulls(spark, tmp_path):
    key = "grp_spots/grp_spots.csv"
    text = RAW_FILES[key].replace("S003,CAMP002,TV02", "S003,CAMP999,TV99")
    ingest(spark, write_raw_files(tmp_path / "raw", **{key: text}))
    daily_run.transform(spark)
    row = spark.table(daily_run.EFFECTIVENESS).where("spot_id = 'S003'").first()
    assert (row.campaign_name, row.channel_name, row.budget) == (None, None, None)
    assert row.incremental_lift_pct == -50.0
    assert spark.table(daily_run.FACT).where("spot_id = 'S003'").first().brand is None


def test_repeated_dimension_keys_multiply_rows(spark, tmp_path):
    key = "campaign_master/campaign_master.csv"
    text = RAW_FILES[key] + "CAMP001,Second Name,BrandA,2026-04-15,2026-04-30,1\n"
    ingest(spark, write_raw_files(tmp_path / "raw", **{key: text}))
    daily_run.transform(spark, publish_candidates=False)
    assert spark.table(daily_run.FACT).count() == 18
    rows = spark.table(daily_run.EFFECTIVENESS).where("spot_id = 'S001'").collect()
    assert [r.attributed_sessions for r in rows] == [4, 4]
    daily_run.stage(spark)
    with pytest.raises(QualityGateError):
        daily_run.gate(spark)


def test_csv_round_trip_keeps_nulls_quotes_and_fractions(spark, tmp_path):
    df = spark.sql(
        """SELECT 'a "quoted", text' AS s, cast(null AS string) AS n, 1.5D AS d,
                  timestamp_ntz'2024-01-01 00:00:07.25' AS t"""
    )
    write_csv(df, str(tmp_path / "out.csv"))
    assert tuple(read_text_columns(spark, str(tmp_path / "out.csv")).first()) == (
        'a "quoted", text', None, "1.5", "2024-01-01 00:00:07.25",
    )


def test_discovery_lists_relative_paths(spark, raw_root):
    found = {r.path: r.length for r in discover(spark, raw_root).collect()}
    assert found == {p: len(t) for p, t in RAW_FILES.items()}
    assert discover(spark, raw_root + "/nothing").count() == 0
    with pytest.raises(FileNotFoundError):
        require_paths(spark, [raw_root, raw_root + "/nothing"])


def test_catalog_lookup(spark, run):
    assert catalog.table_exists(spark, "raw.sessions")
    assert catalog.table_exists(spark, "stg_sessions")
    assert not catalog.table_exists(spark, "nowhere.sessions")
    assert not catalog.table_exists(spark, "raw.stg_sessions")
    assert catalog.first_available(spark, ["marts.nothing", "dq.dq_results"]) == "dq.dq_results"
    assert "staging.stg_sessions" in catalog.list_tables(spark)


def test_a_failed_load_leaves_the_old_table_and_a_log_of_each_source(spark, tmp_path):
    ingest(spark, write_raw_files(tmp_path / "good"))
    before = spark.table("raw.campaign_master").drop("ingestion_ts").collect()
    logged = spark.table(AUDIT_TABLE).count()
    bad = "campaign_id,campaign_name,brand,start_date,end_date,budget\nCAMP001,Sale,BrandA,2026-04-15,2026-04-30,much\n"
    with pytest.raises(Exception, match="much"):
        ingest(spark, write_raw_files(tmp_path / "bad", **{"campaign_master/campaign_master.csv": bad}))
    assert spark.table("raw.campaign_master").drop("ingestion_ts").collect() == before
    assert spark.table(AUDIT_TABLE).count() > logged
    assert spark.table(AUDIT_TABLE).schema["row_count"].dataType.simpleString() == "bigint"


def test_export_keeps_blanks(spark, tmp_path):
    write_csv(spark.createDataFrame([("  padded ", 1)], "a string, b int"), str(tmp_path / "out"))
    assert "  padded ,1" in "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))


@pytest.mark.parametrize("wrong", [
    {"a.csv": "k,v\n1,2\n3,4,5\n"}, {"a.csv": "k,v\n1,2\n3\n"}, {"a.csv": "k,v\n1,2\n", "b.csv": "v,k\n2,1\n"},
])
def test_rows_and_parts_that_do_not_fit_their_header_fail(spark, tmp_path, wrong):
    folder = tmp_path / "wrong"
    folder.mkdir()
    for name, text in wrong.items():
        (folder / name).write_text(text)
    for read in (lambda df: df.count(), lambda df: df.select("k").collect(), lambda df: df.collect()):
        with pytest.raises(Exception, match="CSV|MALFORMED|header"):
            read(read_text_columns(spark, str(folder)))


def test_ragged_source_keeps_the_old_table(spark, tmp_path):
    ingest(spark, write_raw_files(tmp_path / "good"))
    key = "odec/odec_mapping.csv"
    root = write_raw_files(tmp_path / "bad", **{key: RAW_FILES[key] + "TV09,CODE9,Star, Plus,TV\n"})
    with pytest.raises(Exception, match="MALFORMED"):
        ingest(spark, root)
    assert spark.table("raw.odec_mapping").where("channel_id = 'TV09'").isEmpty()
    assert spark.table("raw.odec_mapping").count() > 0


def test_export_writes_numbers_without_exponent(spark, tmp_path):
    values = [12000000.0, 0.0001, 1.5, -3.25e-7, 123456789012345.6, 100.0, None]
    write_csv(spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i int").coalesce(1), str(tmp_path / "out"))
    lines = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*")).split()[1:]
    assert [line.split(",")[0] for line in lines] == [
        "12000000.0", "0.0001", "1.5", "-0.000000325", "123456789012345.6", "100.0", "",
    ]


def test_booleans_count_as_numbers_only_on_their_own(spark):
    df = spark.createDataFrame([("True", "True", "0x1p3"), ("False", "x", "1"), (None, "1", "2")], "a string, b string, c string")
    got = {r.column_name: r.invalid_values for r in qa_report.numeric_columns(df, ["a", "b", "c"]).collect()}
    assert got == {"a": 0, "b": 2, "c": 1}


def test_steps_as_commands_equal_the_run(spark, tmp_path):
    from spotlift.__main__ import main

    root, out, model = write_raw_files(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "model")
    steps = (["ingest", root], ["transform"], ["gate"], ["export", out], ["score", out, model])
    assert [main(words, spark) for words in steps] == [0] * 5
    assert main(["qa", root, str(tmp_path / "qa.csv")], spark) == 0
    assert not catalog.table_exists(spark, daily_run.CANDIDATES)
    found = {t: sorted(map(tuple, spark.table(t).collect())) for t in (daily_run.FACT, daily_run.EFFECTIVENESS, daily_run.SCORES)}
    assert main(["run", root, out, model, "--candidates"], spark) == 0
    assert {t: sorted(map(tuple, spark.table(t).collect())) for t in found} == found
    assert main(["qa", root, str(tmp_path / "qa2.csv"), "--candidates"], spark) == 0
    spark.sql(f"DROP TABLE {daily_run.ODEC}")
    assert main(["qa", root, str(tmp_path / "qa3.csv"), "--fail-fast"], spark) == 1
