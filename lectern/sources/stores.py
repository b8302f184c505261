"""Readers and writers of files, and stores kept as parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern.operators import dedup
from lectern.session import stored
from lectern.sources.buckets import BucketedTables

# Cells that mean nothing.
EMPTY = ("", "nan", "none", "null", "n/a", "na", "-")


def cell(c: Column) -> Column:
    """A cell's text, "" for null and for marks of emptiness."""
    t = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(F.lower(t).isin(*EMPTY), "").otherwise(t)


def read_sheet(spark: SparkSession, path: str, columns: dict[str, Sequence[str]], header_rows: int = 0, width: int = 64) -> DataFrame:
    """A sheet saved as CSV: columns found by any of their names (case ignored), missing ones "", rows numbered.

    Columns beyond ``width`` are not read.

    ``header_rows`` lines above the header are skipped; they must be the same in every
    file. ``row_number`` is 1 for the first row after the header of a file and is
    unique with ``file``.
    """
    raw = spark.read.schema(", ".join(f"c{n} string" for n in range(width))).option("header", False).option("multiLine", True).option("escape", '"').csv(path)
    names = raw.columns
    placed = raw.withColumn("file", F.col("_metadata.file_path")).withColumn("_at", F.monotonically_increasing_id())
    from pyspark.sql.window import Window

    numbered = placed.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy("_at")))
    head = numbered.where(F.col("_n") == header_rows + 1).limit(1).collect()
    if not head:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns) + ", row_number int, file string")
    where = {str(head[0][n] or "").strip().lower(): n for n in names}
    body = numbered.where(F.col("_n") > header_rows + 1)
    picked = []
    for out, tries in columns.items():
        found = next((where[t.lower()] for t in [out, *tries] if t.lower() in where), None)
        picked.append((cell(F.col(found)) if found else F.lit("")).alias(out))
    return body.select(*picked, (F.col("_n") - header_rows - 1).cast("int").alias("row_number"), "file")


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """Links of a text file, one a line; blank lines and those that start with # are skipped."""
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url <> '' and not startswith(url, '#')")


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records of a JSON-lines log; lines that don't parse are dropped, missing fields are null."""
    marked = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_bad = StructType(list(marked.fields)).add("_bad", "string")
    rows = spark.read.schema(with_bad).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    return rows.where(F.col("_bad").isNull()).drop("_bad")


def read_json_tree(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON document a file, with the file's place."""
    return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path).withColumn("file", F.input_file_name())


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, kind, text) of files: the kind by the first bytes, text decoded as UTF-8 or else Latin-1; null for other kinds."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    start = F.hex(F.substring("content", 1, 4))
    kind = F.when(start == "25504446", "pdf").when(start.startswith("504B"), "zip").when(start == "D0CF11E0", "ole").otherwise("text")
    text = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", "ISO-8859-1"))
    return files.select("path", kind.alias("kind"), F.when(kind == "text", text).alias("text"))


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def write_sections(chunks: DataFrame, path: str, key: str = "profile_id", section: str = "section") -> None:
    """One JSON record a key, with its chunks nested by section."""
    nested(chunks, key, section).write.mode("overwrite").json(path)


def nested(chunks: DataFrame, key: str = "profile_id", section: str = "section") -> DataFrame:
    """(key, sections): a map from section to its chunks, in the order of their columns."""
    rest = [c for c in chunks.columns if c not in (key, section)]
    by_section = chunks.groupBy(key, section).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("c"))
    return by_section.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(section, "c"))).alias("sections"))


def flattened(nested_rows: DataFrame, key: str = "profile_id", section: str = "section") -> DataFrame:
    """The rows of :func:`nested` again, with their place in the section."""
    at = nested_rows.select(key, F.explode("sections").alias(section, "c"))
    return at.select(key, section, F.posexplode("c").alias("place", "x")).select(key, section, "place", "x.*")


class TableStore:
    """A keyed table in buckets of its key; a change rewrites the buckets of the keys it names."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, buckets: int = 16):
        self.spark, self.key, self.schema = spark, key, schema
        self.store = BucketedTables(spark, path, {"rows": (schema, [key])}, buckets)

    def read(self) -> DataFrame:
        return self.store.read("rows")

    def upsert(self, changes: DataFrame, order: Sequence[str] = ()) -> None:
        """Put rows in by key; of several changes of a key the greatest by ``order``, then by all columns, counts."""
        columns = self.read().columns
        rest = [c for c in columns if c != self.key and c not in order]
        one = stored(dedup.latest_by(changes.where(F.col(self.key).isNotNull()), [self.key], [*order, *rest]).select(*columns), "changes")
        touched = self.store.touched(one, "rows")
        if touched:
            self.store.publish({"rows": (dedup.upsert(self.store.read("rows", touched), one, self.key), touched)})

    def delete(self, keys: DataFrame) -> None:
        gone = stored(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct(), "gone")
        touched = self.store.touched(gone, "rows")
        if touched:
            self.store.publish({"rows": (dedup.delete(self.store.read("rows", touched), gone, self.key), touched)})

    def archive(self, keep: Column, to: TableStore) -> tuple[int, int]:
        """Move the rows that don't fit ``keep`` to another store; (kept, moved), checked against the whole."""
        table = self.read()
        before = table.count()
        fits = F.coalesce(keep, F.lit(False))
        to.upsert(table.where(~fits))
        self.delete(table.where(~fits))
        kept = self.read().count()
        if to.read().join(self.read().select(self.key), self.key, "left_semi").limit(1).count():
            raise RuntimeError("a key is in the table and in its archive")
        return kept, before - kept

    def page(self, after, size: int) -> DataFrame:
        """The next ``size`` rows by key after ``after`` (None: from the start): keyset pagination."""
        rows = self.read()
        return (rows if after is None else rows.where(F.col(self.key) > F.lit(after))).orderBy(self.key).limit(size)
