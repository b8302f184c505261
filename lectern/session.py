"""Session helpers: tuned local sessions and the shared folder for lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Temporary folders of local sessions, by application.
_LOCAL: dict[str, str] = {}


def local_session(app: str = "lectern", cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own configuration."""
    builder = SparkSession.builder.config("spark.checkpoint.dir", shared) if shared else SparkSession.builder
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder serves, but only in local
    mode, in which driver and executors are one machine; elsewhere it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    app = spark.sparkContext.applicationId
    if app in _LOCAL:
        return _LOCAL[app]
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    _LOCAL[app] = tempfile.mkdtemp(prefix="lectern-")
    return _LOCAL[app]


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back.

    Columnar and compressed, hence smaller than a checkpoint for wide or textual
    rows; like a checkpoint it survives the loss of executors.
    """
    spark = df.sparkSession
    at = f"{shared_dir(spark).rstrip('/')}/lectern/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def dropped(table: DataFrame) -> None:
    """Delete a table that ``stored`` gave and that nothing reads any more."""
    spark = table.sparkSession
    for at in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(at))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan that yields fewer splits than there are cores.

    Only small inputs (one file, one row group) come in so few splits, so what is
    shuffled here is bounded by cores x split size; large inputs pass unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Applications whose workers have the package.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's code to the Python workers, once in an application.

    Workers then need neither the driver's path nor its working directory. The archive
    is code only and goes through Spark's file server.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="lectern-code-")) / "lectern.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(at))
    _SHIPPED.add(sc.applicationId)
