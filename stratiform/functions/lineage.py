"""Technical columns that say where a row came from and when it was processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the technical columns.
INGEST_TS = "_bronze_ingest_ts"
EXTRACT_TS = "_source_extract_ts"
SOURCE_SYSTEM = "_source_system"
ENTITY = "_entity"
INGEST_METHOD = "_ingest_method"
FILE_PATH = "_file_path"
FILE_MODIFIED = "_file_modification_time"
RUN_ID = "_run_id"
STAGED_TABLE = "_connect_source_table"
SILVER_TS = "_silver_processed_ts"
GOLD_TS = "gold_processed_ts"


def _now(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def _origin(source: str, entity: str, method: str, run_id: str, now: Column) -> dict[str, Column]:
    return {
        INGEST_TS: now,
        SOURCE_SYSTEM: F.lit(source),
        ENTITY: F.lit(entity),
        INGEST_METHOD: F.lit(method),
        RUN_ID: F.lit(run_id),
    }


def from_files(
    df: DataFrame,
    source: str,
    entity: str,
    method: str = "file",
    run_id: str = "unknown",
    as_of: Column | None = None,
) -> DataFrame:
    """Add lineage to a file scan or file stream, taking path and time from the hidden ``_metadata``."""
    now = _now(as_of)
    return df.withColumns(
        {
            **_origin(source, entity, method, run_id, now),
            EXTRACT_TS: now,
            FILE_PATH: F.col("_metadata.file_path"),
            FILE_MODIFIED: F.col("_metadata.file_modification_time"),
        }
    )


def from_staged(
    df: DataFrame,
    source: str,
    entity: str,
    staged_table: str,
    method: str = "connector",
    run_id: str = "unknown",
    as_of: Column | None = None,
) -> DataFrame:
    """Add lineage to a staged snapshot; an extract time the connector wrote is kept."""
    now = _now(as_of)
    added = {**_origin(source, entity, method, run_id, now), STAGED_TABLE: F.lit(staged_table)}
    if EXTRACT_TS not in df.columns:
        added[EXTRACT_TS] = now
    return df.withColumns(added)


def stamp(df: DataFrame, column: str = SILVER_TS, as_of: Column | None = None) -> DataFrame:
    """Add the processing time."""
    return df.withColumn(column, _now(as_of))


def with_provenance(
    df: DataFrame, values: dict[str, str], applied_column: str = "last_applied_ts", as_of: Column | None = None
) -> DataFrame:
    """Add constant provenance columns and the time they were applied."""
    return df.withColumns({**{k: F.lit(v) for k, v in values.items()}, applied_column: _now(as_of)})
