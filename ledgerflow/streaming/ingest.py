"""K1 as a data source: rows are pushed in chunks of at most 5 000, and a call counts once all
its chunks have arrived.

Every task writes the chunks it holds, one file each under a name of its own; its commit
message lists them.  When all tasks are done the driver writes the manifest of the call, and
readers take the files of manifests only: a task that fails, or runs twice, leaves no half
chunk and no second one.  An aborted call removes what its finished tasks have written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import register
from ..session import scratch_path
from .sync import chunked_rows, normalize_records

FORMAT = "ledger_ingest"
MANIFEST = "call string, view_name string, chunk_index long, row_count long, file string"


def ingest_source():
    """The data source's class, made here so that executors get it with the query."""
    from dataclasses import dataclass

    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    def filesystem(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    @dataclass
    class Written(WriterCommitMessage):
        chunks: list

    class Writer(DataSourceArrowWriter):
        def __init__(self, path: str, call: str, view_name: str):
            self.path, self.call, self.view_name = path, call, view_name

        def write(self, iterator):
            import json
            import uuid

            store, root = filesystem(self.path)
            store.create_dir(f"{root}/chunks", recursive=True)
            chunks, held = [], []

            def send() -> None:
                if held:
                    number, file = held[0]["chunk_index"], f"chunk-{uuid.uuid4().hex}.json"
                    held.sort(key=lambda r: r["chunk_pos"])
                    body = "\n".join(json.dumps(r, ensure_ascii=False, default=str) for r in held)
                    with store.open_output_stream(f"{root}/chunks/{file}", compression=None) as out:
                        out.write(body.encode())
                    chunks.append((number, len(held), file))
                    held.clear()

            for batch in iterator:  # rows of a chunk come one after the other
                for row in batch.to_pylist():
                    if held and held[0]["chunk_index"] != row["chunk_index"]:
                        send()
                    held.append(row)
            send()
            return Written(chunks)

        def commit(self, messages) -> None:
            import json

            store, root = filesystem(self.path)
            store.create_dir(f"{root}/manifests", recursive=True)
            rows = sorted(c for m in messages if m is not None for c in m.chunks)
            lines = [json.dumps({"call": self.call, "view_name": self.view_name, "chunk_index": i, "row_count": n, "file": f}) for i, n, f in rows]
            # under another name until it is whole
            with store.open_output_stream(f"{root}/manifests/_{self.call}", compression=None) as out:
                out.write("\n".join(lines).encode())
            store.move(f"{root}/manifests/_{self.call}", f"{root}/manifests/{self.call}.json")

        def abort(self, messages) -> None:
            store, root = filesystem(self.path)
            for m in messages:
                for _, _, file in m.chunks if m is not None else ():
                    store.delete_file(f"{root}/chunks/{file}")

    class Ingest(DataSource):
        @classmethod
        def name(cls) -> str:
            return "ledger_ingest"

        def writer(self, schema, overwrite):
            return Writer(self.options["path"], self.options["call"], self.options["viewname"])

    return Ingest


class IngestFolder:
    """Calls that have arrived in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        spark.dataSource.register(ingest_source())

    def push(self, view_name: str, rows: DataFrame, call: str | None = None) -> str:
        """Push ``rows`` (as of ``chunked_rows``) as one call; its name."""
        call = call or uuid.uuid4().hex
        # a chunk is one task's, its rows together
        dealt = rows.repartition("chunk_index").sortWithinPartitions("chunk_index")
        dealt.write.format(FORMAT).mode("append").option("path", self.path).option("call", call).option("viewName", view_name).save()
        return call

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).json(f"{self.path}/manifests")

    def rows(self, schema: str) -> DataFrame:
        """The rows of all calls, with ``call``, ``chunk_index`` and ``chunk_pos``."""
        sent = self.spark.read.schema(f"{schema}, chunk_index long, chunk_pos long").json(f"{self.path}/chunks")
        sent = sent.withColumn("__file", F.element_at(F.split(F.input_file_name(), "/"), -1))
        return sent.join(self.manifest().select("call", F.col("file").alias("__file")), "__file").drop("__file")


@register("ingest_calls", """
WITH r AS (SELECT *, row_number() OVER (ORDER BY numero_piece, type_piece) - 1 AS place FROM ({KEY:client_invoices_flat}))
SELECT place // 5000 AS chunk_index, count(*) AS row_count, min(numero_piece) AS first_piece, max(numero_piece) AS last_piece,
    max(place % 5000) AS last_pos, count(DISTINCT place % 5000) AS places, sum(montant_ht::DECIMAL(18,2))::DOUBLE AS amount
FROM r GROUP BY 1
""")
def ingest_calls(t, as_of: str) -> DataFrame:
    """K1: the invoices view pushed as one call, read back from the chunks of its manifest."""
    from ..plans.commerce import client_invoices_flat
    view = normalize_records(client_invoices_flat(t, as_of))
    folder = IngestFolder(t.spark, scratch_path(t.spark, f"ingest-{uuid.uuid4().hex}"))
    folder.push("VW_FINANCES_CLIENTS_FLAT", chunked_rows(view, [F.col("numero_piece"), F.col("type_piece")]))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in view.schema)
    return folder.rows(schema).groupBy("chunk_index").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("numero_piece").alias("first_piece"), F.max("numero_piece").alias("last_piece"),
        F.max("chunk_pos").alias("last_pos"), F.count_distinct("chunk_pos").alias("places"), F.sum(F.col("montant_ht").cast("decimal(18,2)")).cast("double").alias("amount"))
