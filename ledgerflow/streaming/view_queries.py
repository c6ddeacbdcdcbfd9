"""I8 + I11 as streaming queries: every view is synced by a query of its own.

The query manager runs the queries side by side, each with its trigger (the view's
interval) and its checkpoint.  New source files are a query's batches; its batch
function ships what the view has after its cursor, by the batch cycle's protocol (one row
commits a batch), so a query that fails is started again and ships each row once.  A failing
view ends its own query only; its error is stored and the others go on.
"""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..registry import register
from ..session import scratch_path
from .state import BatchSink, SyncState
from .sync import DEFAULT_INTERVAL_MIN, VIEW_CONFIG, Step, sync_view


class ViewQueries:
    """Queries that sync ``views`` whenever files arrive in ``source`` (a folder of Parquet files)."""

    def __init__(self, t, as_of: str, state: SyncState, sink: BatchSink, source: str, schema: str, root: str, views: list[str]):
        self.t, self.as_of, self.state, self.sink = t, as_of, state, sink
        self.source, self.schema, self.root, self.views = source, schema, root, views

    def _ship(self, name: str, done: Step):
        def batch(files: DataFrame, batch_id: int) -> None:
            from ..plans.views import view
            try:
                sync_view(view(self.t, self.as_of, name), name, self.state, self.sink, done=done)
            except Exception as e:
                self.state.failed(name, f"{type(e).__name__}: {str(e)[:300]}")
                raise
        return batch

    def start(self, name: str, available_now: bool = False, done: Step = lambda step, view: None) -> StreamingQuery:
        """The view's query; triggered by its interval, or once for the files that are there."""
        minutes = VIEW_CONFIG.get(name, (DEFAULT_INTERVAL_MIN, "FULL"))[0]
        trigger = {"availableNow": True} if available_now else {"processingTime": f"{minutes} minutes"}
        return (self.t.spark.readStream.schema(self.schema).parquet(self.source).writeStream.queryName(f"sync-{name}-{uuid.uuid4().hex}")
                .foreachBatch(self._ship(name, done)).option("checkpointLocation", f"{self.root}/checkpoint/{name}")
                .trigger(**trigger).start())

    def run_available(self, done: Step = lambda step, view: None) -> dict[str, str | None]:
        """All queries to the end of the files that are there: per view its error, or None."""
        running = {name: self.start(name, True, done) for name in self.views}
        ended = {}
        for name, query in running.items():
            try:
                query.awaitTermination()
                ended[name] = None
            except StreamingQueryException as e:
                ended[name] = str(e)
        return ended


# a view with equal cursors, one with a whole-set window, one without a cursor, and one that does not exist
QUERY_VIEWS = {"VW_STOCKS": "stock_status", "VW_TRESORERIE": "treasury_flows", "VW_KPI_SYNTESE": "kpi_summary", "VW_NOT_DEPLOYED": None}


@register("view_queries", " UNION ALL ".join(
    f"SELECT '{v}' AS view_name, {'count(*)' if k else '0::BIGINT'} AS rows_shipped, "
    f"{'max(watermark_sync)' if k and v != 'VW_KPI_SYNTESE' else '0::BIGINT'} AS cursor, {'false' if k else 'true'} AS failed"
    + (f" FROM ({{KEY:{k}}})" if k else "") for v, k in QUERY_VIEWS.items()))
def view_queries(t, as_of: str) -> DataFrame:
    """I8 + I11: a query per view, one of which fails; what each shipped, read from the sink."""
    spark: SparkSession = t.spark
    root = scratch_path(spark, f"view-queries-{uuid.uuid4().hex}")
    state = SyncState(spark, f"{root}/state")
    sink = BatchSink(spark, f"{root}/sink", state)
    t.src.events.select("event_id").write.parquet(f"{root}/arrivals")
    ended = ViewQueries(t, as_of, state, sink, f"{root}/arrivals", "event_id long", root, list(QUERY_VIEWS)).run_available()
    failed = state.errors().select(F.col("view_name").alias("__v")).distinct()
    out = None
    for name in ended:
        rows = sink.read(name).agg(F.count(F.lit(1)).alias("rows_shipped")) if QUERY_VIEWS[name] else spark.range(1).select(F.lit(0).cast("long").alias("rows_shipped"))
        one = rows.select(F.lit(name).alias("view_name"), "rows_shipped")
        out = one if out is None else out.unionByName(one)
    return (out.join(state.cursors(), "view_name", "left").join(failed, F.col("view_name") == F.col("__v"), "left")
            .select("view_name", "rows_shipped", F.coalesce("cursor", F.lit(0).cast("long")).alias("cursor"), F.col("__v").isNotNull().alias("failed")))
