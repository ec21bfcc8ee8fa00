"""Python steps on executors."""

import os
from pathlib import Path

from pyspark.sql import DataFrame


def with_package(rows: DataFrame) -> DataFrame:
    """rows, for a Python step: workers also look for this package where the driver has it, besides their own PYTHONPATH."""
    home, env = str(Path(__file__).resolve().parents[1]), rows.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, home])
    return rows
