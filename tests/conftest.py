import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from cartwheel.session import build_session, pin  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(root / "checkpoints"),
        "spark.sql.warehouse.dir": str(root / "warehouse"),
    })
    session.sparkContext.setLogLevel("OFF")
    yield pin(session)
    session.stop()


def plan_of(df) -> str:
    """Physical plan, the final one if the frame has been run."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def scanned_rows(spark, df, column: str) -> int:
    """Rows that the scans of files with the column gave out when ``df`` ran: those of row groups that were not skipped."""
    df.collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    done = store.executionsList().last().executionId()
    values, nodes, total = store.executionMetrics(done), store.planGraph(done).allNodes(), 0
    for i in range(nodes.size()):
        node = nodes.apply(i)
        if node.name().startswith("Scan parquet") and f"{column}#" in node.desc():
            for j in range(node.metrics().size()):
                metric = node.metrics().apply(j)
                if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                    total += int(values.apply(metric.accumulatorId()).replace(",", ""))
    return total
