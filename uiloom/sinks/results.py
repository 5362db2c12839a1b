"""Sealed results in a content-addressed table, written in two phases, so that a batch that is repeated changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from uiloom.functions.text import canonical_json

# The largest result in bytes, and the revision of the envelope.
MOST, REVISION = 64 << 20, 1


def sealed(results: DataFrame, protocol: str) -> tuple[DataFrame, DataFrame]:
    """Results (task_id, digest, size, body) and refused ones (task_id, code) of rows (task_id, materialization_target_digest, catalog as JSON text).
    The body is the canonical JSON of the envelope around the catalog; the digest is its SHA-256."""
    catalog = canonical_json("catalog")
    head = F.to_json(F.struct("materialization_target_digest", F.lit(protocol).alias("protocol"), F.lit(REVISION).alias("revision")))
    body = F.concat(F.lit('{"result":'), head, F.lit(',"source_catalog":'), catalog, F.lit("}")).cast("binary")
    rows = results.select("task_id", F.when(F.col("materialization_target_digest").isNotNull(), body).alias("body"))
    code = F.when(F.col("body").isNull(), "catalog-invalid").when(F.octet_length("body") > MOST, "result-too-large")
    judged = rows.withColumn("code", code)
    fine = judged.where("code IS NULL").select("task_id", F.sha2("body", 256).alias("digest"), F.octet_length("body").cast("long").alias("size"), "body")
    return fine, judged.where("code IS NOT NULL").select("task_id", "code")


class ResultStore:
    """Objects (digest, size, body), each digest once, and receipts (task_id, digest, batch), one folder for each batch.

    Phase 1 writes a batch under `staged`, overwriting what an attempt that died has left there; phase 2 renames the folder into `objects`, where a folder that exists already means that
    an earlier attempt got through. A batch holds no object that an earlier batch has, so a digest that exists is a success without a write. The folder must be a shared one whose store renames folders at once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def objects(self) -> DataFrame:
        return self._read("objects", "digest string, size bigint, body binary, batch bigint").drop("batch")

    def receipts(self) -> DataFrame:
        return self._read("receipts", "task_id bigint, digest string, batch bigint")

    def _read(self, name: str, schema: str) -> DataFrame:
        if not self._exists(f"{self.folder}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def stage(self, results: DataFrame, batch: int) -> None:
        """Phase 1, of sealed results."""
        before = self._read("objects", "digest string, batch bigint").where(F.col("batch") != batch).select("digest")
        one = results.groupBy("digest").agg(F.min("size").alias("size"), F.min("body").alias("body"))  # equal digests have equal bodies
        one.join(before, "digest", "left_anti").write.mode("overwrite").parquet(f"{self.folder}/staged/objects/batch={batch}")
        results.select("task_id", "digest").distinct().write.mode("overwrite").parquet(f"{self.folder}/staged/receipts/batch={batch}")

    def commit(self, batch: int) -> None:
        """Phase 2. Objects come before the receipts that name them."""
        for name in ("objects", "receipts"):
            staged, final = (f"{self.folder}/{top}{name}/batch={batch}" for top in ("staged/", ""))
            if not self._exists(final):
                self._fs.mkdirs(self._path(f"{self.folder}/{name}"))
                if not self._fs.rename(self._path(staged), self._path(final)):
                    raise OSError(f"{staged} can't be renamed to {final}")

    def committed(self, batch: int) -> bool:
        return self._exists(f"{self.folder}/receipts/batch={batch}")

    def write(self, results: DataFrame, batch: int) -> None:
        """Both phases; for foreachBatch."""
        if not self.committed(batch):
            if not self._exists(f"{self.folder}/objects/batch={batch}"):
                self.stage(results, batch)
            elif not self._exists(f"{self.folder}/staged/receipts/batch={batch}"):
                results.select("task_id", "digest").distinct().write.mode("overwrite").parquet(f"{self.folder}/staged/receipts/batch={batch}")
            self.commit(batch)

    def publish(self, results: DataFrame, protocol: str, checkpoint: str) -> StreamingQuery:
        """Seals and stores what is there of a stream of results, then stops; refused rows are left to the caller, by `sealed`."""
        return results.writeStream.foreachBatch(lambda rows, n: self.write(sealed(rows, protocol)[0], n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
