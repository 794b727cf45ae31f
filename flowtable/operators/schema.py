"""Schema capture and drift: schemas as rows, compared with a full outer join on the name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# Drift texts, kept word for word as the original tool prints them.
DRIFT_MESSAGES = {
    "removed": "Column '{column}' was removed from source",
    "added": "New column '{column}' not in stored schema",
    "type_changed": "Column '{column}' type changed: {stored} → {incoming}",
}
DRIFT_HEADER = "Schema drift detected:"
DRIFT_BULLET = "  - "

SCHEMA_ROW = StructType(
    [
        StructField("column_name", StringType()),
        StructField("column_type", StringType()),
        StructField("ordinal", IntegerType()),
    ]
)


def schema_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """One row per column: name, Spark type name (``simpleString``), position (1-based).

    The input is the frame's schema (catalog metadata, one entry per column), never its data.
    """
    rows = [(f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, SCHEMA_ROW)


def schema_compare(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Full outer join of two schema-row frames on the column name; ``change`` is
    ``removed``, ``added``, ``type_changed`` or NULL (unchanged)."""
    s = stored.select("column_name", F.col("column_type").alias("stored_type"), F.col("ordinal").alias("stored_ordinal"))
    i = incoming.select("column_name", F.col("column_type").alias("incoming_type"), F.col("ordinal").alias("incoming_ordinal"))
    change = (
        F.when(F.col("incoming_type").isNull(), "removed")
        .when(F.col("stored_type").isNull(), "added")
        .when(F.col("stored_type") != F.col("incoming_type"), "type_changed")
    )
    joined = s.join(i, "column_name", "full_outer").withColumn("change", change)
    return joined.select("column_name", "change", "stored_type", "incoming_type", "stored_ordinal", "incoming_ordinal")


def schema_drift(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Only the drifted columns.  An empty ``stored`` (first run) gives no drift."""
    drift = schema_compare(stored, incoming).where(F.col("change").isNotNull())
    if stored.isEmpty():  # first run: nothing stored, nothing to compare against
        drift = drift.limit(0)
    return drift.select("column_name", "change", "stored_type", "incoming_type")


def _line_order(r) -> tuple:
    """Removed columns first in stored order, then added / retyped ones in incoming order."""
    if r["change"] == "removed":
        return (0, r.get("stored_ordinal") or 0, r["column_name"])
    return (1, r.get("incoming_ordinal") or 0, r["column_name"])


def drift_lines(rows) -> list[str]:
    rows = [r.asDict() if hasattr(r, "asDict") else dict(r) for r in rows]
    return [
        DRIFT_MESSAGES[r["change"]].format(column=r["column_name"], stored=r["stored_type"], incoming=r["incoming_type"])
        for r in sorted(rows, key=_line_order)
    ]


def drift_error_text(lines: list[str]) -> str:
    return DRIFT_HEADER + "\n" + "\n".join(DRIFT_BULLET + line for line in lines)
