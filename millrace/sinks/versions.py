"""Tables in versions: a new version is written beside the old one and takes its place by one row of a manifest.

Readers look up the last version that the manifest names, so they see the old rows or the new ones, never a part
of either, and a writer that dies leaves only a folder that no row names. All names published together are one
file of the manifest and change together.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import delete_folder

MANIFEST = "number long, run string, name string, path string"


class Versions:
    """The versioned tables of one folder. One writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def manifest(self) -> DataFrame:
        """number, run, name, path of every version published so far."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/_manifest")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def write(self, name: str, df: DataFrame) -> str:
        """Write rows to a folder of their own, which no reader sees yet."""
        path = f"{self.folder}/{name}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def publish(self, paths: Mapping[str, str], run: str) -> None:
        """Make written folders the current versions of their names, all at once."""
        last = self.manifest().agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        rows = [(last + 1, run, name, path) for name, path in paths.items()]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.folder}/_manifest")

    def current(self, run: str | None = None) -> dict[str, str]:
        """Path of the last version of each name, of all runs or of one; as many rows as there are names reach the driver."""
        rows = self.manifest() if run is None else self.manifest().where(F.col("run") == run)
        last = Window.partitionBy("name").orderBy(F.desc("number"))
        kept = rows.withColumn("place", F.row_number().over(last)).where("place = 1")
        return {r["name"]: r["path"] for r in kept.collect()}

    def read(self, name: str) -> DataFrame:
        path = self.current().get(name)
        if path is None:
            raise ValueError(f"no version of {name} in {self.folder}")
        return self.spark.read.parquet(path)

    def sweep(self, name: str, keep: int = 1) -> int:
        """Delete all but the last ``keep`` versions of a name; how many went. For when no reader uses them."""
        rows = self.manifest().where(F.col("name") == name).orderBy(F.desc("number")).select("path").collect()
        gone = [r["path"] for r in rows[keep:]]
        for path in gone:
            delete_folder(self.spark, path)
        return len(gone)
