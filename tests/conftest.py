from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.schema import to_messages  # noqa: E402
from feedlens.session import build_session  # noqa: E402

AT = "2023-11-29 17:00:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Messages from dicts; what is left out gets a plain default."""

    def build(*rows: dict, translations=None, classifications=None):
        flat = "id_ string, datetime_ string, datetime_scraped_ string, country string, source string, `group` string, text string, reply boolean, reply_to string, translations array<struct<text:string,from_lang:string,to_lang:string>>, classifications array<struct<topic:string,score:double,agent:string>>, lon double, lat double"
        full = []
        for i, row in enumerate(rows):
            base = {
                "id_": str(i), "datetime_": AT, "datetime_scraped_": AT, "country": "NLD", "source": "Telegram",
                "group": "test", "text": "text", "reply": False, "reply_to": None, "translations": [],
                "classifications": [], "lon": None, "lat": None,
            }
            full.append(tuple({**base, **row}.values()))
        from pyspark.sql import functions as F

        from feedlens.schema import info_struct

        df = spark.createDataFrame(full, flat)
        return to_messages(df.withColumn("info", info_struct(lon=F.col("lon"), lat=F.col("lat"))))

    return build
