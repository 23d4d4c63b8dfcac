"""Text and table scans with the loader's missing-value and failure rules."""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.columns import name_sql, named, present, replaced, text_sql, type_of
from assayframe.functions.parse import NULL_TOKENS, null_tokens_sql, number_sql

# Dtype names a rules file may use.
DTYPES = {
    "str": "string", "string": "string", "object": "string", "category": "string",
    "int": "bigint", "int64": "bigint", "Int64": "bigint", "int32": "int", "Int32": "int",
    "float": "double", "float64": "double", "Float64": "double", "float32": "float",
    "bool": "boolean", "boolean": "boolean",
    "datetime64[ns]": "timestamp_ntz", "date": "date",
}


# A line whose last cell opens a quote and does not close it.  Lines with an even
# number of quotes are ruled out before the pattern is tried.
_CELL = r'(?:"(?:[^"]++|"")*+"|[^",][^,]*+|)'
OPEN_QUOTE = (
    """(length(value) - length(replace(value, '"', ''))) % 2 = 1 AND value RLIKE """
    + text_sql(rf'^(?:{_CELL},)*+"(?:[^"]++|"")*+$')
)


# The path a row was read from, as it was written rather than as a URI.
FILE_PATH = "url_decode(replace(_metadata.file_path, '+', '%2B'))"


class UnreadableInput(ValueError):
    """The file exists but does not hold a complete table."""


def _require(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = system.globStatus(location)
    if not matches:
        raise FileNotFoundError(f"no input at {path}")


# How every CSV file below a folder is found.
_BELOW = {"recursiveFileLookup": True, "pathGlobFilter": "*.csv"}


def _scan(spark: SparkSession, path: str | list[str], multi_line: bool = False, folder: bool = False) -> DataFrame:
    # Broken rows must fail even when a query needs only some of their columns.
    reader = spark.read.option("columnPruning", False).options(**_BELOW if folder else {})
    return reader.csv(
        path, header=True, quote='"', escape='"', mode="FAILFAST", multiLine=multi_line,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        nullValue="\x00none\x00", emptyValue="",
        enforceSchema=False,  # a file whose header differs is an error, not other columns
    )


def _no_open_quotes(spark: SparkSession, path: str, folder: bool) -> None:
    if not spark.read.text(path, **_BELOW if folder else {}).filter(OPEN_QUOTE).isEmpty():
        raise UnreadableInput(f"{path} holds a line that ends inside a quoted cell")


def read_text_table(
    spark: SparkSession, path: str, multi_line: bool = False, check: bool = True,
    folder: bool = False,
) -> DataFrame:
    """All columns as text, cells kept as written, absent cells as empty text.

    ``multi_line`` allows line breaks inside quotes and gives up splitting files.
    ``check`` scans the raw lines once for a last cell whose quote is never closed,
    which the parser itself lets pass.  ``folder`` reads every CSV file below ``path``.
    """
    if not folder and not str(path).rstrip("/").lower().endswith(".csv"):
        raise ValueError(f"unsupported file format: {path}; use CSV or a table")
    _require(spark, path)
    df = _scan(spark, path, multi_line, folder)
    if not df.columns:
        raise UnreadableInput(f"{path} has no header and no rows")
    if multi_line:
        last = df.columns[-1]
        df = df.withColumn(last, F.regexp_replace(named(last), "\r$", ""))
        df = df.withColumnRenamed(last, last.rstrip("\r"))
    if check and not multi_line:
        _no_open_quotes(spark, path, folder)
    return df.na.fill("")


def with_nulls(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """The tokens a reader takes as missing become NULL in every text column."""
    return replaced(df, {
        f.name: null_tokens_sql(name_sql(f.name), tuple(tokens))
        for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    })


def cast_columns(df: DataFrame, dtypes: Mapping[str, str]) -> DataFrame:
    """Cast the columns that exist; values that do not fit become NULL."""
    casts = {}
    for name in present(df, dtypes):
        target = DTYPES.get(dtypes[name], dtypes[name])
        c = name_sql(name)
        number = number_sql(c, type_of(df, name))
        if target in ("bigint", "int"):
            # "3.0" is the integer 3, "3.5" is not an integer.
            casts[name] = (
                f"CASE WHEN CAST({c} AS STRING) RLIKE '^\\\\s*[+-]?[0-9]+\\\\s*$' "
                f"THEN try_cast(trim(CAST({c} AS STRING)) AS {target}) "
                f"WHEN {number} = floor({number}) THEN try_cast({number} AS {target}) END")
        elif target in ("double", "float"):
            casts[name] = f"CAST({number} AS {target})"
        else:
            casts[name] = f"try_cast({c} AS {target})"
    return replaced(df, casts)


def load_dataset(
    spark: SparkSession, path: str, dtypes: Mapping[str, str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """A CSV file as a table: missing-value tokens are NULL, declared types applied.

    Columns without a declared type stay text, so ``0001`` keeps its zeros.
    """
    return cast_columns(with_nulls(read_text_table(spark, path, multi_line)), dtypes or {})


def load_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file as text without missing-value detection (repair and injection)."""
    return read_text_table(spark, path)


# A scenario is a CSV file or a written CSV folder.
_SCENARIO = r"/([^/]+)\.csv(/[^/]*)?$"


def scenario_paths(spark: SparkSession, directory: str) -> list[str]:
    """The CSV files and written CSV folders below a directory, from its listing alone."""
    listed = spark.read.format("binaryFile").options(**_BELOW).load(directory).select("path")
    own = F.concat(F.regexp_replace("path", _SCENARIO, "/"), F.regexp_extract("path", _SCENARIO, 1), F.lit(".csv"))
    return sorted(row[0] for row in listed.select(own).distinct().collect())


def load_scenarios(spark: SparkSession, directory: str, name: str = "scenario") -> DataFrame:
    """Every CSV file (or written CSV folder) of a directory, labelled with its name.

    Each is read by its own header, so the order of columns may differ, and a column that one
    does not have is NULL in its rows.  Those with equal headers share a scan: there are as
    many readers as there are headers.  The driver holds one path a scenario.  A part of a
    written folder whose header differs from its first part is an error.  Scenarios without
    a header have no rows; when none has one, that is an error.
    """
    _require(spark, directory)
    by_header: dict[tuple, list[str]] = {}
    for path in scenario_paths(spark, directory):
        literal = re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)
        header = tuple(_scan(spark, literal, folder=True).columns)
        if header:
            by_header.setdefault(header, []).append(literal)
    if not by_header:
        raise UnreadableInput(f"{directory} holds no CSV file with a header")
    _no_open_quotes(spark, directory, folder=True)
    label = F.regexp_extract(F.expr(FILE_PATH), _SCENARIO, 1)
    frames = [_scan(spark, paths, folder=True).na.fill("").withColumn(name, label)
              for paths in by_header.values()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return with_nulls(merged.select(*[named(c) for c in merged.columns if c != name], name))


def load_table(
    spark: SparkSession, table: str, dtypes: Mapping[str, str] | None = None
) -> DataFrame:
    """A catalog table; an unknown name is an error before anything runs."""
    if not spark.catalog.tableExists(table):
        known = sorted(t.name for t in spark.catalog.listTables())
        raise ValueError(f"Unknown table {table!r}. Known tables: {known}.")
    return cast_columns(spark.table(table), dtypes or {})


def load_jdbc(
    spark: SparkSession, url: str, table: str, dtypes: Mapping[str, str] | None = None,
    partition_column: str | None = None, lower: str | None = None, upper: str | None = None,
    partitions: int = 32, **options: str,
) -> DataFrame:
    """A database table, read in parallel ranges when a partition column is given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
            numPartitions=partitions,
        )
    return cast_columns(reader.load(), dtypes or {})


def load_parquet(spark: SparkSession, path: str, dtypes: Mapping[str, str] | None = None) -> DataFrame:
    return cast_columns(spark.read.parquet(path), dtypes or {})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep and rename the mapped columns: ``{new: old}``."""
    return df.select(*[named(old).alias(new) for new, old in names.items()])


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*map(named, present(df, columns)))


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]
