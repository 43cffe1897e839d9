"""Run once per drop of new raw files: a file stream that stops when it has caught up."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.scalars import numbered_key, quoted
from panelloom.operators.state import stored_values
from panelloom.sources.bronze import ROW_ID, SOURCE, first_numbers, numbered, tagged
from panelloom.sources.tables import CSV_READ, read_headered_csv

BATCH = "landing_batch"


def land_new_files(
    spark: SparkSession,
    landing_path: str,
    bronze_path: str,
    checkpoint_path: str,
    edition: str,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Append every file not landed before to the edition's Bronze folder; return the stored table.

    Row numbers continue after the rows landed earlier. A batch owns one partition of the folder, named after the stream's
    own lasting id and the batch number, and overwrites just that: a batch repeated after a failure writes the same
    rows under the same keys, and a stream with a new checkpoint never touches what another one has landed.
    """
    target = f"{bronze_path.rstrip('/')}/{edition}"
    schema = read_headered_csv(spark, landing_path).schema
    reader = spark.readStream.schema(schema).options(**CSV_READ).option("multiLine", True)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    names = [F.col("`" + c.replace("`", "``") + "`") for c in schema.names]
    rows = tagged(reader.csv(landing_path).select(F.col("_metadata.file_name").alias("source_file"), *names, "_metadata"))
    landed: dict[str, int] = {}

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        partition = f"{BATCH}={stream}-{batch_id}"
        earlier = landed.get("rows")
        if earlier is None:  # once per run; later batches know what they have added
            earlier = _rows_of_others(session, target, partition)
        # Written by the tasks that read the files and never moved again: the numbers follow from what is stored.
        batch.withColumn("ingestion_timestamp", F.current_timestamp()).write.mode("overwrite").parquet(f"{target}/{partition}")
        stored = session.read.parquet(f"{target}/{partition}")
        first_numbers(stored, earlier).write.mode("overwrite").parquet(f"{target}/_numbers/{partition}")
        landed["rows"] = earlier + stored.count()

    query = (
        rows.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_landed(spark, bronze_path, edition)


def read_landed(spark: SparkSession, bronze_path: str, edition: str, batch: str | None = None) -> DataFrame:
    """Landed rows of an edition with their lineage and keys: all of them, or one batch, whose folder alone is read then."""
    target = f"{bronze_path.rstrip('/')}/{edition}"
    part = "" if batch is None else f"/{BATCH}={batch}"
    stored = spark.read.option("basePath", target).parquet(f"{target}{part}")
    names = [c for c in stored.columns if c not in ("source_file", "ingestion_timestamp", BATCH, *SOURCE)]
    return numbered(stored, spark.read.parquet(f"{target}/_numbers{part}").drop(BATCH), "__row").select(
        F.lit(edition).alias("survey_year"), "source_file", "ingestion_timestamp", numbered_key(F.lit(edition), F.col("__row")).alias(ROW_ID),
        *[quoted(c) for c in names], BATCH,
    )


def landed_batches(spark: SparkSession, bronze_path: str, edition: str) -> list[str]:
    return stored_values(spark, f"{bronze_path.rstrip('/')}/{edition}", BATCH)


def _rows_of_others(spark: SparkSession, target: str, partition: str) -> int:
    try:
        stored = spark.read.parquet(target)
    except AnalysisException:  # nothing landed yet
        return 0
    return stored.where(F.concat(F.lit(f"{BATCH}="), F.col(BATCH)) != partition).count()
