"""Tables kept in buckets of their key, changed by rewriting the buckets concerned."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of a change that one file of a bucket takes; a bucket with a hot key is spread over more files, hence tasks.
ROWS_A_FILE = 2_000_000


class Folder:
    """Files under a path of whatever file system Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._at(name))) if self.fs.exists(self._at(name)) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(b & 0xFF for b in stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Put a small file in place whole: written beside it, then renamed. An existing one is an error."""
        beside = self._at(f"_{name}.part")
        stream = self.fs.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self._at(name)) or not self.fs.rename(beside, self._at(name)):
            raise RuntimeError(f"{name} was published by another writer")

    def drop(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


class BucketedTables:
    """Tables under one folder, published together in numbered generations.

    Each table has its bucket expression, a hash of the stated columns. A change writes
    rows by bucket, adding to a bucket or replacing it, and then one small manifest that
    says which generations make up each bucket. So readers see whole generations only, a
    failed change is not seen, and earlier generations stay readable until :meth:`vacuum`.
    There is one writer at a time; a second one fails when it publishes. Other sessions
    open the same folder.
    """

    def __init__(self, spark: SparkSession, path: str, tables: Mapping[str, tuple[str, Sequence[str]]], buckets: int = 16):
        self.spark, self.path, self.tables, self.buckets = spark, path.rstrip("/"), dict(tables), buckets
        self.folder = Folder(spark, path)

    def generation(self) -> int:
        """The latest published generation; 0 if there is none."""
        return max((int(n[9:-5]) for n in self.folder.names() if n.startswith("manifest-") and n.endswith(".json")), default=0)

    def _manifest(self, generation: int) -> dict[str, dict[str, list[int]]]:
        return json.loads(self.folder.read(f"manifest-{generation}.json")) if generation else {}

    def bucket(self, table: str) -> Column:
        return F.pmod(F.xxhash64(*self.tables[table][1]), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame, table: str) -> list[int]:
        """The buckets that ``rows`` fall into: at most ``buckets`` numbers."""
        return sorted(r.b for r in rows.select(self.bucket(table).alias("b")).distinct().collect())

    def read(self, table: str, buckets: Iterable[int] | None = None, generation: int | None = None) -> DataFrame:
        """The table, or those buckets of it, as of a generation (by default the latest)."""
        kept = self._manifest(self.generation() if generation is None else generation).get(table, {})
        wanted = None if buckets is None else {str(b) for b in buckets}
        paths = [f"{self.path}/{table}/g{g}/_bucket={b}" for b, made in kept.items() if wanted is None or b in wanted for g in made]
        schema = self.tables[table][0]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def publish(self, changes: Mapping[str, tuple[DataFrame, Sequence[int]]]) -> int:
        """Add rows to each table, after emptying the buckets named with them; the number of the new generation."""
        now = self.generation()
        manifest, new = self._manifest(now), now + 1
        for table, (rows, emptied) in changes.items():
            columns = StructType.fromDDL(self.tables[table][0]).names
            marked = rows.select(*columns, self.bucket(table).alias("_bucket"))
            parts = 1 + marked.count() // ROWS_A_FILE
            spread = marked.repartition("_bucket", F.pmod(F.xxhash64(*columns), F.lit(parts))) if parts > 1 else marked.repartition("_bucket")
            spread.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/{table}/g{new}")
            there = [n[8:] for n in self.folder.names(f"{table}/g{new}") if n.startswith("_bucket=")]
            made = {b: g for b, g in manifest.get(table, {}).items() if int(b) not in set(emptied)}
            manifest[table] = made | {b: [*made.get(b, []), new] for b in there}
        self.folder.write(f"manifest-{new}.json", json.dumps(manifest))
        return new

    def vacuum(self) -> None:
        """Drop what only earlier generations use."""
        now = self.generation()
        used = self._manifest(now)
        for n in range(1, now):
            self.folder.drop(f"manifest-{n}.json")
        for table in self.tables:
            live = {f"g{g}" for made in used.get(table, {}).values() for g in made}
            for name in self.folder.names(table):
                if name not in live:
                    self.folder.drop(f"{table}/{name}")
