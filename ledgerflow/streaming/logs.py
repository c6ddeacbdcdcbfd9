"""S4 as a stream: daily log files, plain or compressed once they are rotated, parsed as they arrive.

A day's file is read once it is complete (rotated); its lines are parsed as in
``plans.governance`` and appended to a table partitioned by the file's day.  The checkpoint
remembers the files that were read.  Retention drops whole days: they are no longer read
(``days``), and files whose batch is done can be moved away (``archive``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.governance import LOG_LINES_SQL, log_lines, parse_log
from ..registry import register
from ..session import scratch_path

#: Days that logs are kept (fixed value of the reference).
RETENTION_DAYS = 30
#: A file's day, from its name or folder.
FILE_DAY = r"(\d{4}-\d{2}-\d{2})[^/]*(?:/[^/]*)?$"
LINES = "line string, day string, timestamp string, level string, message string"


class LogStream:
    """Parsed lines of the log files in a folder."""

    def __init__(self, spark: SparkSession, folder: str, root: str, archive: str | None = None, files_per_trigger: int = 100):
        self.spark, self.folder, self.root, self.archive, self.files_per_trigger = spark, folder, root, archive, files_per_trigger

    def run(self) -> None:
        """Take all rotated files that are there and were not read yet."""
        source = self.spark.readStream.option("maxFilesPerTrigger", self.files_per_trigger).option("recursiveFileLookup", "true")
        if self.archive:
            source = source.option("cleanSource", "archive").option("sourceArchiveDir", self.archive)
        lines = source.text(self.folder).select(F.col("value").alias("line"), F.regexp_extract(F.input_file_name(), FILE_DAY, 1).alias("day"))
        parsed = parse_log(lines).select("line", "day", "timestamp", "level", "message")
        (parsed.writeStream.format("parquet").option("path", f"{self.root}/lines").partitionBy("day")
         .option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start().awaitTermination())

    def lines(self, today: str | None = None, days: int = RETENTION_DAYS) -> DataFrame:
        """The parsed lines; with ``today`` only those of files of the last ``days`` days."""
        rows = self.spark.read.schema(LINES).parquet(f"{self.root}/lines")
        if today:
            rows = rows.where(F.col("day") > F.date_format(F.date_sub(F.lit(today).cast("date"), days), "yyyy-MM-dd"))
        return rows


def write_daily(lines: DataFrame, folder: str, compressed: bool) -> None:
    """``line, day`` as text files in a folder a day."""
    (lines.select("line", "day").repartition("day").write.mode("append").partitionBy("day")
     .option("compression", "gzip" if compressed else "none").text(folder))


@register("log_stream_counts", f"""WITH {LOG_LINES_SQL}
SELECT level, count(*) AS n_lines FROM parsed GROUP BY level""")
def log_stream_counts(t, as_of: str) -> DataFrame:
    """Daily files, the older half rotated to .gz before the stream starts and the rest after a restart."""
    root = scratch_path(t.spark, f"log-stream-{uuid.uuid4().hex}")
    lines = log_lines(t).where("line is not null and line <> ''").select(
        F.regexp_replace("line", "[\\r\\n]", " ").alias("line"),
        F.coalesce(F.date_format(F.try_to_timestamp(F.substring("line", 1, 10), F.lit("yyyy-MM-dd")), "yyyy-MM-dd"), F.lit("1970-01-01")).alias("day"))
    middle = lines.agg(F.percentile_approx(F.unix_date(F.col("day").cast("date")), 0.5)).first()[0]
    older = F.unix_date(F.col("day").cast("date")) <= F.lit(middle)
    stream = LogStream(t.spark, f"{root}/logs", f"{root}/stream")
    for rows, compressed in ((lines.where(older), True), (lines.where(~older), False)):
        write_daily(rows, f"{root}/logs", compressed)
        stream.run()
    return stream.lines().groupBy("level").agg(F.count(F.lit(1)).alias("n_lines"))
