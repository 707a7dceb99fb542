"""JSON records with a declared schema, broken ones kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

BROKEN = "_broken_record"
SEGMENTS = "segment string, embeddings string, id_mapping string"


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of a file or folder of JSON lines, with ``_broken_record``: the line itself where it does not fit the
    schema, else null. Fields the schema does not name are left out, missing ones are null."""
    columns = StructType.fromDDL(schema).add(BROKEN, "string")
    reader = spark.read.schema(columns).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    return reader.json(path)


def whole_records(records: DataFrame) -> DataFrame:
    return records.filter(F.col(BROKEN).isNull()).drop(BROKEN)


def read_segments(spark: SparkSession, path: str) -> list[tuple[DataFrame, DataFrame]]:
    """(vectors, id mapping) of every embedding segment that a JSON file of table paths lists, by segment name.

    A file of a few lines, which reach the driver; a broken or incomplete line raises.
    """
    found = sorted(read_json(spark, path, SEGMENTS).collect(), key=lambda r: str(r.segment))
    wrong = [r for r in found if r[BROKEN] is not None or None in (r.segment, r.embeddings, r.id_mapping)]
    if wrong:
        raise ValueError(f"{path} has incomplete segments: {[r[BROKEN] or r.asDict() for r in wrong]}")
    return [(spark.read.parquet(r.embeddings), spark.read.parquet(r.id_mapping)) for r in found]
