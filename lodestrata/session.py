"""SparkSession with the settings that the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "lodestrata", **conf: str) -> SparkSession:
    """A session in UTC with ANSI arithmetic, adaptive execution and last-wins maps; `conf` overrides, with __ for each dot."""
    builder = SparkSession.builder.appName(app)
    own = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.mapKeyDedupPolicy": "LAST_WIN", "spark.ui.showConsoleProgress": "false",
    }
    if not os.environ.get("SPARK_REMOTE") and not os.environ.get("MASTER"):
        own["spark.master"] = "local[*]"
    return builder.config(map=own | {k.replace("__", "."): v for k, v in conf.items()}).getOrCreate()
