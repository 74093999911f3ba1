"""Incremental bronze landing with Structured Streaming.

The same CSV -> Parquet landing as ``sources.bronze.land_csv`` (SRC-1/SNK-1),
but only files not landed before are read: the checkpoint records processed
files, so a re-run (or a run after executor loss) lands each file exactly once.
``availableNow`` processes the backlog and stops, so it runs as a batch job.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from adlake.sources.bronze import PART, RAW, csv_options, declared, split_rejects


def land_csv_incremental(spark: SparkSession, csv_dir: str, bronze_path: str, checkpoint: str,
                         schema: str | StructType, max_files_per_trigger: int | None = None, multiline: bool = False,
                         quarantine: bool = False, rfc: bool = False) -> None:
    """Land every new CSV file under ``csv_dir`` into Parquet at ``bronze_path``.

    Records are read by the options of the batch landing: one that does not fit the schema stops the run, and its
    files stay unlanded, or with ``quarantine`` goes to the folder of rejected records (read both by ``bronze.landed``).
    ``checkpoint`` must be a shared, durable folder (e.g. under
    ``spark.checkpoint.dir`` on a cluster).  A schema is required: streaming
    file sources do not infer one.
    """
    schema = declared(schema)
    reader = spark.readStream.options(**csv_options(multiline, quarantine, rfc))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if quarantine:
        rows = split_rejects(reader.schema(StructType([*schema.fields, StructField(RAW, StringType())])).csv(csv_dir), schema)
    else:
        rows = reader.schema(schema).csv(csv_dir)
    sink = rows.writeStream.format("parquet").option("path", bronze_path).option("checkpointLocation", checkpoint)
    q = (sink.partitionBy(PART) if quarantine else sink).trigger(availableNow=True).start()
    q.awaitTermination()
