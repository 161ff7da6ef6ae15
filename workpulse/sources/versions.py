"""Tables whose refresh commits or leaves the former state.

A table is a folder with one data folder for each version and ``_commits/``. A refresh writes a new data
folder and then creates the commit file of the next number, which must not exist yet: that one step is the
switch. Readers take the highest commit that is whole, so that nothing of a refresh which fails half way, loses
its driver or loses a race is ever read. The last ``keep`` versions stay readable.

A commit holds the data folder, the schema, the counts that were observed while writing, and the run that
made it. No data passes through the driver: it reads and writes commit files only, one for each refresh.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workpulse.sources.layout import Layout, arranged, writer

COMMITS = "_commits"
#: Versions that stay readable after a refresh, the new one included.
KEEP = 2


class ConcurrentRefresh(RuntimeError):
    """Another refresh of the table has committed since this one began."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    columns: list[str]
    schema: str
    counts: dict[str, int | None] = field(default_factory=dict)
    run: str | None = None


class Folder:
    """A folder of the file system that Spark's executors share, by Hadoop's interface."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        if not self._fs.exists(self._at(name)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def create(self, name: str, text: str) -> bool:
        """A new file; False if there is one of that name."""
        try:
            out = self._fs.create(self._at(name), False)
        except Py4JJavaError as fault:
            if self._fs.exists(self._at(name)):
                return False
            raise fault
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        return True

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def move(self, name: str, to: str) -> bool:
        """Rename; False if there is nothing of that name or the file system refuses."""
        return self._fs.exists(self._at(name)) and self._fs.rename(self._at(name), self._at(to))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def list_versions(spark: SparkSession, path: str) -> list[Version]:
    """The committed versions that are still kept, oldest first. A commit that isn't whole counts as none."""
    folder = Folder(spark, path)
    data = set(folder.names())
    found = []
    for name in folder.names(COMMITS):
        if not name.endswith(".json"):
            continue
        try:
            version = Version(**json.loads(folder.read(f"{COMMITS}/{name}")))
        except (ValueError, TypeError):
            continue
        if version.folder in data:
            found.append(version)
    return sorted(found, key=lambda v: v.number)


def current_version(spark: SparkSession, path: str) -> Version | None:
    found = list_versions(spark, path)
    return found[-1] if found else None


def read_published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table's current version, or the one of that ``number``, with the columns in their published order."""
    found = [v for v in list_versions(spark, path) if number is None or v.number == number]
    if not found:
        raise FileNotFoundError(f"no committed version {'' if number is None else number} of {path}")
    version = found[-1]
    schema = T.StructType.fromJson(json.loads(version.schema))
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{version.folder}").select(*version.columns)


def read_in_order(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """A table of an ordered layout with each row's place, from 1, in the files as they follow each other.

    Nothing is sorted: a row's place is its place in its file and the rows of the files before it, which are
    counted from one number for each file.
    """
    table = read_published(spark, path)
    names = table.columns
    version = current_version(spark, path)
    rows = (
        spark.read.schema(T.StructType.fromJson(json.loads(version.schema)))
        .parquet(f"{path.rstrip('/')}/{version.folder}")
        .select(*names, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    )
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(files), "_file").select(*names, (F.col("_before") + F.col("_row") + 1).alias(position))


def _nullable(schema: T.StructType) -> str:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]).json()


def _taken(folder: Folder) -> int:
    """The highest number that a commit file has, whole or not."""
    return max([int(n.split(".")[0]) for n in folder.names(COMMITS) if n.split(".")[0].isdigit()], default=0)


def refresh(
    df: DataFrame,
    path: str,
    layout: Layout = Layout(),
    counts: dict[str, Column] | None = None,
    run: str | None = None,
    keep: int = KEEP,
    histogram_of: DataFrame | None = None,
    catalog_name: str | None = None,
) -> Version:
    """Write ``df`` as the next version of the table at ``path`` and commit it.

    ``counts`` are aggregates (name to column) that Spark observes on the rows as they are written, after the last
    shuffle, so that a task run twice counts once; ``rows`` is always among them. Columns that ``counts`` alone
    needs start with ``_`` and aren't written. ``run`` names what made the version. If writing fails, the data folder is removed and the
    former version stays; if another refresh committed meanwhile, ``ConcurrentRefresh`` is raised and its
    version stays. With ``catalog_name`` a view of that name is pointed to the new version after the commit.
    """
    spark = df.sparkSession
    folder = Folder(spark, path)
    number = _taken(folder) + 1
    data = f"v{number:08d}-{uuid.uuid4().hex}"
    seen = Observation(f"refresh-{data}")
    out = arranged(df, layout, histogram_of)
    wanted = {"rows": F.count(F.lit(1)), **(counts or {})}
    out = out.observe(seen, *(c.cast("bigint").alias(n) for n, c in wanted.items()))
    out = out.select(*(c for c in df.columns if not c.startswith("_")))
    try:
        writer(out, layout).save(f"{folder.path}/{data}")
        version = Version(number, data, out.columns, _nullable(out.schema), dict(seen.get), run)
        if not folder.create(f"{COMMITS}/{number:08d}.json", json.dumps(asdict(version))):
            raise ConcurrentRefresh(f"version {number} of {path} has been committed by another refresh")
    except BaseException:
        folder.delete(data)
        raise
    _remove_old(folder, number, keep)
    if catalog_name:
        point_view(spark, catalog_name, path)
    return version


def _remove_old(folder: Folder, number: int, keep: int) -> None:
    """Data of versions before the last ``keep``, and what refreshes of those numbers have left, committed or not."""
    for name in folder.names():
        if name.startswith("v") and name[1:9].isdigit() and int(name[1:9]) <= number - keep:
            folder.delete(name)
    for name in folder.names(COMMITS):
        if name.split(".")[0].isdigit() and int(name.split(".")[0]) <= number - keep:
            folder.delete(f"{COMMITS}/{name}")


def point_view(spark: SparkSession, name: str, path: str) -> None:
    """Create or replace the catalog view ``name`` over the table's current version."""
    version = current_version(spark, path)
    columns = ", ".join(f"`{c}`" for c in version.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{path.rstrip('/')}/{version.folder}`")


def committed_counts(spark: SparkSession, tables: dict[str, str], columns: Sequence[str] = ("rows",)) -> DataFrame:
    """(table_name, *columns) from the commits of the tables (name to path): what was counted while they were written."""
    rows = []
    for name, path in tables.items():
        version = current_version(spark, path)
        if version:
            rows.append((name, *(version.counts.get(c) for c in columns)))
    # one row for each table
    return spark.createDataFrame(rows, "table_name string, " + ", ".join(f"`{c}` bigint" for c in columns))
