"""Loading the raw CSV layer and counting tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workpulse.sources.schemas import RAW_SCHEMAS

# Raw table name -> CSV file name.
RAW_FILES: dict[str, str] = {
    "raw_dim_accounts": "dim_accounts.csv",
    "raw_dim_users": "dim_users.csv",
    "raw_dim_applications": "dim_applications.csv",
    "raw_dim_projects": "dim_projects.csv",
    "raw_dim_tasks": "dim_tasks.csv",
    "raw_fact_activity_sessions": "fact_activity_sessions.csv",
}


_NOTHING_TO_READ = ("UNABLE_TO_INFER_SCHEMA",)


def _first_line(spark: SparkSession, path: str) -> list[str]:
    """The column names of a CSV as they stand in its first line (of its first file); none for an empty one."""
    try:
        return spark.read.option("header", True).csv(path).columns
    except AnalysisException as fault:
        if fault.getCondition() in _NOTHING_TO_READ:
            return []
        raise


def _names(line: list[str]) -> list[str]:
    # white space and a byte order mark are not part of a name
    return [n.removeprefix("\ufeff").strip() for n in line]


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The column names of a CSV, from its first line (of its first file, if it is a folder)."""
    return _names(_first_line(spark, path))


def _by_header(spark: SparkSession, path: str | list[str], line: list[str], table: str, malformed: str | None) -> DataFrame:
    """Files that share a header line, read with the declared types by name, in the declared order."""
    declared = RAW_SCHEMAS[table]
    kinds = {f.name: f.dataType for f in declared.fields}
    where = dict(reversed(list(zip(_names(line), line, strict=True))))  # the first of columns of one name counts
    in_file = [T.StructField(c, kinds.get(n, T.StringType()) if where[n] == c else T.StringType(), True)
               for c, n in zip(line, _names(line), strict=True)]
    extra = [T.StructField(malformed, T.StringType(), True)] if malformed else []
    # a file whose header is another one is refused, not read by position
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False).option(
        "timestampFormat", "yyyy-MM-dd HH:mm:ss")
    if malformed:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    df = reader.schema(T.StructType([*in_file, *extra])).csv(path)
    quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")
    return df.select(
        *(quoted(where[f.name]).alias(f.name) if f.name in where else F.lit(None).cast(f.dataType).alias(f.name)
          for f in declared.fields),
        *(F.col(f.name) for f in extra))


def read_csv_table(
    spark: SparkSession, path: str, table: str, malformed: str | None = None, each_file: bool = False
) -> DataFrame:
    """Read one raw CSV by the names in its header, with the declared types: the order of its columns doesn't
    matter, a declared column that it lacks is NULL, one that isn't declared is left out (``header_drift`` tells).
    An empty field is NULL, a bad value is NULL.

    The files of a folder share the header of the first one; one with another header fails the read. With
    ``each_file`` every file is read by its own header (one line of each file is read to plan that, and files with
    the same header share a scan). With ``malformed`` a column of that name holds the line of a row
    with a bad value, else NULL.
    """
    if each_file:
        by_header: dict[tuple[str, ...], list[str]] = {}
        for file in sorted(spark.read.text(path).inputFiles()):
            by_header.setdefault(tuple(_first_line(spark, file)), []).append(file)
        found = [(files, list(line)) for line, files in by_header.items() if line]
    else:
        line = _first_line(spark, path)
        found = [(path, line)] if line else []
    parts = [_by_header(spark, files, line, table, malformed) for files, line in found]
    if not parts:
        extra = [T.StructField(malformed, T.StringType(), True)] if malformed else []
        return spark.createDataFrame([], T.StructType([*RAW_SCHEMAS[table].fields, *extra]))
    return reduce(DataFrame.unionByName, parts)


def load_raw(
    spark: SparkSession, raw_dir: str, files: dict[str, str] | None = None
) -> tuple[dict[str, DataFrame], list[tuple[str, str, str]]]:
    """Load the raw layer from ``raw_dir``.

    Returns the tables that exist and a load report ``[(table, path, 'loaded'|'missing')]``. A path
    that does not exist is reported and skipped, the others load; any other fault (no permission, a
    wrong format) is raised. Columns are matched by the header's names (``read_csv_table``); nothing but the first
    line of each table is read here. ``header_drift`` lists the columns that differ from the declared ones, ``value_drift``
    those whose values don't fit, ``malformed_rows`` counts the rows with such values.
    """
    tables: dict[str, DataFrame] = {}
    report: list[tuple[str, str, str]] = []
    for table, name in (files or RAW_FILES).items():
        path = f"{raw_dir.rstrip('/')}/{name}"
        try:
            tables[table] = read_csv_table(spark, path, table)
            report.append((table, path, "loaded"))
        except AnalysisException as fault:
            if fault.getCondition() != "PATH_NOT_FOUND":
                raise
            report.append((table, path, "missing"))
    return tables, report


def header_drift(spark: SparkSession, report: list[tuple[str, str, str]]) -> DataFrame:
    """(table_name, column_name, drift, declared_at, found_at) for the loaded files of a load report.

    ``drift`` is ``missing`` (declared, not in the header), ``added`` (in the header, not declared) or
    ``reordered`` (in both, at another place among the columns that both have); places count from 1.
    """
    rows = []
    for table, path, status in report:
        if status != "loaded":
            continue
        declared, found = RAW_SCHEMAS[table].fieldNames(), csv_header(spark, path)
        both = [c for c in declared if c in found]
        order = {c: i for i, c in enumerate(x for x in found if x in declared)}
        for i, name in enumerate(declared, 1):
            if name not in found:
                rows.append((table, name, "missing", i, None))
            elif order[name] != both.index(name):
                rows.append((table, name, "reordered", i, found.index(name) + 1))
        rows += [(table, name, "added", None, i) for i, name in enumerate(found, 1) if name not in declared]
    # one row for each column that differs
    return spark.createDataFrame(rows, "table_name string, column_name string, drift string, declared_at int, found_at int")


#: Types that a retyped column is tried against, the narrowest first.
CANDIDATES = ("int", "bigint", "double", "boolean", "date", "timestamp")


def value_drift(spark: SparkSession, report: list[tuple[str, str, str]]) -> DataFrame:
    """(table_name, column_name, declared, filled, bad, fits) for each declared column that isn't text and has a
    value that is not of its type: filled fields, those that can't be read, and the narrowest type that fits all.

    One scan and one aggregate for each table.
    """
    parts = []
    for table, path, status in report:
        header = csv_header(spark, path) if status == "loaded" else []
        typed = [f for f in RAW_SCHEMAS[table].fields if f.name in header and not isinstance(f.dataType, T.StringType)]
        if not typed:
            continue
        raw = spark.read.option("header", True).csv(path)
        raw = raw.toDF(*header).select(*(F.trim(f"`{f.name}`").alias(f.name) for f in typed))
        fails = lambda name, kind: F.count(F.when(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull(), 1))
        counted = raw.agg(F.array(*(
            F.struct(
                F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("declared"),
                F.count(f.name).alias("filled"), fails(f.name, f.dataType.simpleString()).alias("bad"),
                F.array(*(fails(f.name, kind) for kind in CANDIDATES)).alias("by_kind"),
            ) for f in typed
        )).alias("_columns"))
        first = F.array_position("by_kind", F.lit(0).cast("bigint"))
        fits = F.when(first > 0, F.element_at(F.array(*map(F.lit, CANDIDATES)), first.cast("int"))).otherwise("string")
        parts.append(counted.select(F.inline("_columns")).where("bad > 0").select(
            "table_name", "column_name", "declared", "filled", "bad", fits.alias("fits")))
    if not parts:
        return spark.createDataFrame([], "table_name string, column_name string, declared string, filled bigint, bad bigint, fits string")
    return reduce(DataFrame.unionByName, parts)


def malformed_rows(spark: SparkSession, report: list[tuple[str, str, str]]) -> DataFrame:
    """(table_name, row_count, malformed) for the loaded files of a load report: rows, and how many of
    them have a value that was read as NULL because it doesn't fit the schema."""
    # a value counts only if its column is read: the flag looks at the whole row
    bad = lambda table: F.when(
        F.col("_malformed").isNotNull(), F.struct(*RAW_SCHEMAS[table].fieldNames()))
    parts = [
        read_csv_table(spark, path, table, "_malformed")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count(bad(table)).alias("malformed"))
        .select(F.lit(table).alias("table_name"), "row_count", "malformed")
        for table, path, status in report if status == "loaded"
    ]
    if not parts:
        return spark.createDataFrame([], "table_name string, row_count bigint, malformed bigint")
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")


def catalog_inventory(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Every table of a catalog database with its row count, ordered by name.

    The table list is catalog metadata (names only); each count is a distributed aggregate.
    """
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    prefix = f"{database}." if database else ""
    return table_inventory({name: spark.table(prefix + name) for name in names})


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name``, ``row_count`` (bigint), ordered by name."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in sorted(tables.items())
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")
