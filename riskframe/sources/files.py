"""CSV / Parquet directory scans and sinks.

Scans take an explicit schema (no inference pass over the data) whose columns are
found by their names in the header; inference is only the fallback when no schema is given. Sinks write part files from
every task in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, mode: str = "PERMISSIVE", rejected: str | None = None) -> DataFrame:
    """A CSV file or a directory of part files as one table.

    With a header, columns are bound by *name*: the header's names (trimmed) are
    read as text, the schema's columns that exist are selected in its order and
    cast; others are left out of the result, whatever their place in the file.
    Part files of one directory may differ in their headers (order, padding, further
    or missing columns): see :func:`read_csv_parts`.
    Values that do not parse become null (and are later removed by the null
    filter); ``rejected`` adds a flag column that marks their rows. Without a
    header the schema binds by position.
    """
    r = spark.read.option("header", header).option("mode", mode)
    if schema is None:
        return r.option("inferSchema", True).csv(path)
    if not header:
        return r.schema(schema).csv(path)
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    return read_csv_parts(spark, path, schema, mode, rejected)


READERS = 16                    # files whose first line is read at once


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """Data files that ``path`` names (a file, a folder, or a pattern of either)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    out, todo = [], list(fs.globStatus(p) or [])
    while todo:
        s = todo.pop()
        if s.getPath().getName().startswith(("_", ".")):
            continue
        if s.isDirectory():
            todo += list(fs.listStatus(s.getPath()))
        elif s.getLen():
            out.append(s.getPath().toString())
    return sorted(out)


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names in the first line of a CSV file (through Hadoop, compressed or not)."""
    import csv
    import io
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
        codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return tuple(next(csv.reader(io.StringIO(reader.readLine() or "")), []))
    finally:
        reader.close()


def read_csv_parts(spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE",
                   rejected: str | None = None) -> DataFrame:
    """Files that each have a header of their own as one table.

    The driver reads the first line of every file; files with the same header are one scan,
    bound by name, and the scans are united. A column of ``schema`` that some files lack is
    null in their rows; one that no file has is left out, as for a single file. A folder
    whose files agree is one plain scan.
    """
    from concurrent.futures import ThreadPoolExecutor
    names = csv_files(spark, path)
    with ThreadPoolExecutor(READERS) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f), names))
    groups: dict[tuple, list[str]] = {}
    for f, h in zip(names, headers):
        groups.setdefault(h, []).append(f)

    def scan(header, where):
        if len({c.strip() for c in header}) < len(header):
            raise ValueError(f"a column stands twice in the header {header} of {where[0]}")
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        r = spark.read.schema(text).option("header", True).option("mode", mode).option("enforceSchema", False)
        return by_name(r.csv(where), schema, rejected)

    if len(groups) <= 1:
        header = next(iter(groups), None)
        if header is None:                       # no rows anywhere: the reader says what is missing
            return by_name(spark.read.option("header", True).option("mode", mode).csv(path), schema, rejected)
        return scan(header, [path])
    parts = [scan(h, fs) for h, fs in sorted(groups.items())]
    have = {c for p in parts for c in p.columns}
    order = [f for f in schema.fields if f.name in have]
    out = None
    for p in parts:
        p = p.select(*[F.col(f"`{f.name}`") if f.name in p.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in order], *([rejected] if rejected else []))
        out = p if out is None else out.unionByName(p)
    return out


def by_name(text: DataFrame, schema: T.StructType, rejected: str | None = None) -> DataFrame:
    """The columns of ``schema`` that ``text`` (strings under a file's header names) has,
    cast to their types; text that does not parse becomes null."""
    names = {c.strip(): c for c in text.columns}
    cols, bad = [], F.lit(False)
    for f in schema.fields:
        if f.name not in names:
            continue
        raw = F.col(f"`{names[f.name]}`")
        value = raw if isinstance(f.dataType, T.StringType) else F.trim(raw).try_cast(f.dataType)
        cols.append(value.alias(f.name))
        bad = bad | (raw.isNotNull() & value.isNull())
    if rejected:
        cols.append(bad.alias(rejected))
    return text.select(*cols)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None) -> DataFrame:
    """A directory written by ``write_table``."""
    if fmt == "csv":
        return read_csv(spark, path, schema)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """S3: overwrite a directory of part files (CSV with header, or Parquet)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path
