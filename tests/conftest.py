from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spotlift.session import build_session

# The bundled raw files.
RAW_FILES = {
    "grp_spots/grp_spots.csv": """\
spot_id,campaign_id,channel_id,spot_date,spot_time,grp_value,spot_duration_sec
S001,CAMP001,TV01,2026-04-20,20:30:00,4.5,30
S002,CAMP001,TV01,2026-04-20,21:00:00,5.2,30
S003,CAMP002,TV02,2026-04-21,19:45:00,3.8,20
S004,CAMP003,DIGI01,2026-04-21,22:10:00,2.5,15
""",
    "sessions/sessions.csv": """\
session_id,user_id,session_timestamp,device_type,session_source
SESS001,U001,2026-04-20 20:18:00,mobile,direct
SESS002,U002,2026-04-20 20:22:00,desktop,organic
SESS003,U003,2026-04-20 20:31:00,mobile,direct
SESS004,U004,2026-04-20 20:34:10,mobile,paid
SESS005,U005,2026-04-20 20:37:00,desktop,organic
SESS006,U006,2026-04-20 20:43:00,mobile,direct
SESS007,U007,2026-04-20 20:50:00,mobile,direct
SESS008,U008,2026-04-20 21:05:30,mobile,paid
SESS009,U009,2026-04-20 21:10:00,desktop,organic
SESS010,U010,2026-04-21 19:35:00,mobile,direct
SESS011,U011,2026-04-21 19:40:00,desktop,organic
SESS012,U012,2026-04-21 19:51:00,mobile,direct
SESS013,U013,2026-04-21 22:00:00,mobile,direct
SESS014,U014,2026-04-21 22:05:00,desktop,organic
SESS015,U015,2026-04-21 22:11:00,mobile,paid
SESS016,U016,2026-04-21 22:14:00,mobile,direct
SESS017,U017,2026-04-21 22:18:00,mobile,paid
SESS018,U018,2026-04-21 22:21:00,desktop,organic
SESS019,U019,2026-04-21 22:24:00,mobile,direct
""",
    "campaign_master/campaign_master.csv": """\
campaign_id,campaign_name,brand,start_date,end_date,budget
CAMP001,Festival Mega Sale,BrandA,2026-04-15,2026-04-30,500000
CAMP002,Prime Time Awareness,BrandB,2026-04-18,2026-04-28,350000
CAMP003,Digital Booster,BrandC,2026-04-20,2026-04-25,200000
""",
    "odec/odec_mapping.csv": """\
channel_id,odec_channel_code,channel_name,channel_type
TV01,ODEC_TV_001,Star Plus,TV
TV02,ODEC_TV_002,Zee TV,TV
DIGI01,ODEC_DIGI_001,YouTube,Digital
""",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "checkpoint"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def write_raw_files(root, **changes) -> str:
    for path, text in {**RAW_FILES, **changes}.items():
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text)
    return str(root)


@pytest.fixture
def raw_root(tmp_path):
    return write_raw_files(tmp_path / "raw")
