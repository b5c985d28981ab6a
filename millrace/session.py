"""Session settings and the shared folder that lineage is cut into."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A method of more bytecode than this is never compiled by the JVM. A wide projection generated as
    # one such method runs several times slower than the same projection split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

# The most that one task should read of a file, and of a shuffle while there are partitions to spare. What a task keeps
# in hash tables and sorts is a multiple of it: 8 MB of shuffled pairs of integers are about 200 MB there.
MOST_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20}


def build_session(app_name: str = "millrace", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the settings that change the speed and memory of a query and not its result."""
    for key in ("spark.sql.codegen.hugeMethodLimit", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, SETTINGS[key])
    for key, most in MOST_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    return spark


def _bytes(size: str) -> int:
    """A size as Spark's settings write it: digits, and a unit of 1024, its square and so on."""
    digits, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(digits) << (10 * " kmgtp".index(unit or " "))


def shared_folder(spark: SparkSession) -> str:
    """The reliable folder named by the cluster; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="millrace-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder


def new_folder(spark: SparkSession) -> str:
    """The path of a folder of this application that is not there yet."""
    return f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Written:
    """A table written to the shared folder, so that partition numbers in it stay as they are."""

    rows: DataFrame
    path: str

    def delete(self) -> None:
        delete_folder(self.rows.sparkSession, self.path)


def write_once(df: DataFrame) -> Written:
    """Write ``df`` and read it back: its lineage ends at files that any executor can read again.

    Readers fetch only the columns and, by the files' statistics, only the partition numbers they need.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession)
    df.write.parquet(path)
    return Written(spark.read.schema(df.schema).parquet(path), path)


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_written(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder, once no result needs it any more."""
    delete_folder(spark, f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}")


class Tables(Mapping):
    """Tables by name, each opened when first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._makers[name]()
        return self._opened[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_tables(spark: SparkSession, folder: str) -> Tables:
    """The parquet tables of one data folder by name."""
    return Tables({name: (lambda name=name: load_table(spark, folder, name)) for name in TABLES})
