import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from estatelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            # Tiny inputs: compiling stages would take longer than running them.
            "spark.sql.codegen.wholeStage": "false",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluate a column expression on a list of single values of one type."""

    def run(values, kind, expression):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, x {kind}")
        out = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in out]

    return run
