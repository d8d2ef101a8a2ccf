"""KPIs kept up to date as gate runs are committed."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from daybook.plans.kpi_run import run_kpis
from daybook.plans.workspace import Workspace
from daybook.schemas import GATE_LOG


def stream_kpis(
    spark: SparkSession,
    workspace: Workspace,
    checkpoint: str,
    recompute: bool = True,
    latest_only: bool = False,
) -> StreamingQuery:
    """Process every file once after its gate run is committed; stop when all are done.

    The stream follows the gate log: a new file there is one committed run. Each
    micro-batch then takes all files that wait, so an order file whose items come
    later goes with them. A batch may be delivered again after a failure; the
    ledger drops the files that were finished and the upsert replaces the rows
    of those that were not.
    """

    def process(batch: DataFrame, _batch_id: int) -> None:
        run_kpis(batch.sparkSession, workspace, latest_only=latest_only, recompute=recompute)

    return (
        spark.readStream.schema(GATE_LOG)
        .parquet(workspace.gate_log)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
