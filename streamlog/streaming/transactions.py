"""Records and source offsets published as one unit.

Layout: ``data/batch_id=N/part=K``, ``offsets/batch_id=N`` and, written last,
``manifest/batch_id=N``. A batch counts only with its manifest row. Sending a
batch again overwrites what a failed attempt left, so each is there once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog.model import OFFSETS_SCHEMA, TOPIC_PARTITION, struct_of
from streamlog.operators.offsets import BROADCAST_LIMIT
from streamlog.session import read_or_empty

MANIFEST_SCHEMA = struct_of(parts=T.IntegerType(), batch_id=T.LongType())


def claim(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Tie an output path to one checkpoint.

    Batch numbers start again with a new checkpoint; on the same path its first
    batches would be taken for ones already written, and be lost.
    """
    owner = struct_of(checkpoint=T.StringType())
    found = read_or_empty(spark, f"{path}/owner", owner).first()
    if found is None:
        spark.range(1).coalesce(1).select(F.lit(checkpoint).alias("checkpoint")).write.parquet(f"{path}/owner")
    elif found["checkpoint"] != checkpoint:
        raise ValueError(f"{path} belongs to the checkpoint {found['checkpoint']}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The committed batches."""
    return read_or_empty(spark, f"{path}/manifest", MANIFEST_SCHEMA)


class Transaction:
    """One unit of output. Nothing of it is visible to committed readers before ``commit``."""

    def __init__(self, spark: SparkSession, path: str, batch_id: int):
        self.spark = spark
        self.path = path
        self.batch_id = batch_id
        self.parts = 0
        self.open = True

    def _require_open(self) -> None:
        if not self.open:
            raise RuntimeError(f"transaction {self.batch_id} has ended")

    def send(self, records: DataFrame) -> None:
        self._require_open()
        records.write.mode("overwrite").parquet(
            f"{self.path}/data/batch_id={self.batch_id}/part={self.parts}"
        )
        self.parts += 1

    def send_offsets(self, offsets: DataFrame, group_id: str = "") -> None:
        self._require_open()
        offsets.select(F.lit(group_id).alias("group_id"), *OFFSETS_SCHEMA.names).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/offsets/batch_id={self.batch_id}")

    def commit(self) -> None:
        self._require_open()
        row = self.spark.range(1).select(F.lit(self.parts).alias("parts")).coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.path}/manifest/batch_id={self.batch_id}")
        self.open = False

    def abort(self) -> None:
        """End without a manifest row."""
        self._require_open()
        self.open = False


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Looks at the folder of this batch only, however many there are."""
    return not read_or_empty(spark, f"{path}/manifest/batch_id={batch_id}", struct_of(parts=T.IntegerType())).isEmpty()


def write_once(records: DataFrame, offsets: DataFrame, path: str, batch_id: int, group_id: str = "") -> bool:
    """Publish one batch unless it already is; False if it was."""
    spark = records.sparkSession
    if is_committed(spark, path, batch_id):
        return False
    unit = Transaction(spark, path, batch_id)
    unit.send(records)
    unit.send_offsets(offsets, group_id)
    unit.commit()
    return True


def _published(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    committed = manifest(spark, path)
    # Small files make the manifest look larger than its rows are, so count them.
    fits = committed.limit(BROADCAST_LIMIT + 1).count() <= BROADCAST_LIMIT
    return rows.join(F.broadcast(committed) if fits else committed, "batch_id")


def read(
    spark: SparkSession, path: str, schema: T.StructType, isolation: str = "read_committed"
) -> DataFrame:
    """Records of the committed batches, or of all with ``read_uncommitted``."""
    stored = T.StructType(schema.fields + struct_of(batch_id=T.LongType(), part=T.IntegerType()).fields)
    rows = read_or_empty(spark, f"{path}/data", stored)
    if isolation == "read_committed":
        rows = _published(rows, spark, path).filter(F.col("part") < F.col("parts"))
    elif isolation != "read_uncommitted":
        raise ValueError(f"unknown isolation level {isolation!r}")
    return rows.select(*schema.names)


def committed_offsets(spark: SparkSession, path: str, group_id: str | None = None) -> DataFrame:
    """``group_id, topic, partition, offset``: source offsets of each group's last committed batch that has them.

    With ``group_id`` the offsets of that group only, without the column.
    """
    stored = T.StructType(
        [T.StructField("group_id", T.StringType())] + OFFSETS_SCHEMA.fields
        + [T.StructField("batch_id", T.LongType())]
    )
    rows = _published(read_or_empty(spark, f"{path}/offsets", stored), spark, path)
    if group_id is not None:
        rows = rows.filter(F.col("group_id") == group_id)
    found = rows.groupBy("group_id", *TOPIC_PARTITION).agg(F.max_by("offset", "batch_id").alias("offset"))
    return found if group_id is None else found.drop("group_id")
