"""File and database readers.

Schemas are declared, never inferred (inference costs a pass over the data
and turns codes such as ``'06037'`` into numbers).

CSV columns are bound by **name**: a job finds the header line of every file
(no file is opened on the driver), files of equal header are read together
against that header, and the groups are unioned by name, so a folder may hold
files with reordered, missing or further columns. Quoting follows RFC 4180
(a quote inside a quoted cell is doubled). Cells with line breaks need
``multi_line=True``, which makes a file one task.
"""

from __future__ import annotations

import csv
import io
from functools import reduce
from typing import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from importlens.operators.joins import broadcast_if_small
from importlens.schemas import strings
from importlens.session import work_dir


def _paths(paths: str | list[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _data_files(spark: SparkSession, path: str) -> Iterator[str]:
    """Data files at ``path`` as the file system lists them (none is opened)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    for status in fs.globStatus(target) or []:
        walk = fs.listFiles(status.getPath(), True)
        while walk.hasNext():
            leaf = walk.next().getPath()
            inner = leaf.toString()[len(status.getPath().toString()):]
            # as Spark's own readers: names that start with "_" or "." are no data
            if not any(part.startswith(("_", ".")) for part in inner.split("/") if part and "=" not in part):
                yield leaf.toString()


def _require_files(spark: SparkSession, path: str) -> None:
    if next(_data_files(spark, path), None) is None:
        raise FileNotFoundError(f"no data files at {path}")


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Fully qualified data files at ``path`` (file, folder with subfolders, or glob), on its own file system."""
    found = list(_data_files(spark, path))
    if not found:
        raise FileNotFoundError(f"no data files at {path}")
    return found


def _own_path(column: str = "_metadata.file_path") -> Column:
    """The row's file as a decoded, fully qualified path (it comes percent-encoded, local ones with two more slashes)."""
    encoded = F.replace(F.col(column), F.lit("+"), F.lit("%2B"))
    return F.regexp_replace(F.url_decode(encoded), "^file:/+", "file:/")


def first_lines(spark: SparkSession, paths: list[str], whole: bool = False) -> DataFrame:
    """``(file, line)``: the first line with text of every file, read in tasks that hold one batch of lines.

    With ``whole`` a file is one string and its line is the first CSV record, whose quoted cells may hold line breaks.
    """
    text = spark.read.text(paths, wholetext=whole, recursiveFileLookup=True)
    if whole:
        record = F.regexp_extract("value", r'^\s*((?:[^"\r\n]++|"[^"]*+")*+)', 1)
        return text.select(_own_path().alias("file"), record.alias("line"))
    head = text.where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
    lines = head.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))

    def first_of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None                 # a task reads file after file, each in its order
        for batch in batches:
            if batch.num_rows:
                runs = pc.run_end_encode(batch["file"])
                files, ends = runs.values.to_pylist(), runs.run_ends.to_pylist()
                starts = [at for at, file, before in zip([0, *ends], files, [last, *files]) if file != before]
                last = files[-1]
                yield batch.take(pa.array(starts, pa.int64()))

    return lines.mapInArrow(first_of_files, "file string, line string").select(_own_path("file").alias("file"), "line")


def _columns(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader(io.StringIO(line.removeprefix("\ufeff"), newline="")), ()))


def by_header(spark: SparkSession, paths: list[str], multi_line: bool = False) -> dict[tuple[str, ...], list[str]]:
    """What to read for each header: the given paths if all files have one, else the files of each.

    The lines are found by a job and written; only distinct lines reach the driver, and
    lists of files only if there are several headers.
    """
    path = work_dir(spark, "headers")
    first_lines(spark, paths).write.parquet(path)
    lines = spark.read.schema("file string, line string").parquet(path)
    odd = F.pmod(F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit(""))), F.lit(2)) == 1
    if multi_line and (cut := [r.file for r in lines.where(odd).select("file").collect()]):
        lines = lines.where(~odd).unionByName(first_lines(spark, cut, whole=True))
    headers: dict[tuple[str, ...], list[str]] = {}
    for row in lines.select("line").distinct().collect():
        headers.setdefault(_columns(row.line), []).append(row.line)
    if len(headers) <= 1:
        return {h: paths for h in headers}
    return {h: [r.file for r in lines.where(F.col("line").isin(own)).select("file").collect()] for h, own in headers.items()}


def _read(spark: SparkSession, header: tuple[str, ...], files: list[str], types: dict, multi_line: bool) -> DataFrame:
    schema = StructType([StructField(c, types.get(c, StringType()), True) for c in header])
    return (spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
            .option("recursiveFileLookup", True).option("multiLine", multi_line).schema(schema).csv(files))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _by_name(spark: SparkSession, paths: str | list[str], columns: StructType | None, multi_line: bool) -> DataFrame:
    for p in _paths(paths):
        _require_files(spark, p)
    types = {f.name: f.dataType for f in columns.fields} if columns is not None else {}
    groups = by_header(spark, _paths(paths), multi_line)
    frames = [_read(spark, h, fs, types, multi_line) for h, fs in groups.items()]
    if not frames:
        return spark.createDataFrame([], columns or StructType([]))
    out = _union(frames)
    if columns is None:
        return out
    missing = {f.name: F.lit(None).cast(f.dataType) for f in columns.fields if f.name not in out.columns}
    return out.withColumns(missing).select(*[f.name for f in columns.fields])


def read_csv_strings(spark: SparkSession, paths: str | list[str],
                     columns: Iterable[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Header CSV with every column as text, bound by name.

    ``columns`` selects (a column that no file has is NULL); without it the
    result has every column of any file.
    """
    return _by_name(spark, paths, strings(*columns) if columns is not None else None, multi_line)


def read_csv_typed(spark: SparkSession, paths: str | list[str], schema: StructType | str,
                   multi_line: bool = False) -> DataFrame:
    """Header CSV read against a declared schema, bound by name; unparsable cells become NULL."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return _by_name(spark, paths, declared, multi_line)


def read_tagged(spark: SparkSession, paths: dict[str, str], schema: StructType | None = None,
                tag: str = "country_iso3") -> DataFrame:
    """Read several folders, files or globs and tag each row with its path's key.

    ``paths`` maps a key (e.g. ISO3) to a path of any scheme. Files of equal
    header are read in one scan; the tag comes from a join of the row's decoded,
    fully qualified file path with a written table of paths, so the plan does not
    grow with the files. A row whose file belongs to no key raises an error.
    """
    owner: dict[str, str] = {}
    for key, path in paths.items():
        for file in list_files(spark, path):
            if owner.setdefault(file, key) != key:
                raise ValueError(f"{file} belongs to {owner[file]} and to {key}")
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    own = {f.name for f in schema.fields} if schema is not None else None
    frames, places = [], _path_tables(spark, owner)
    for header, files in by_header(spark, list(paths.values())).items():
        df = _tagged(_read(spark, header, files, types, False), places, tag)
        if own is not None:
            absent = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in header and f.name != tag}
            df = df.withColumns(absent).select(*[f.name for f in schema.fields if f.name != tag], tag)
        frames.append(df)
    if not frames:
        raise ValueError("every file is empty")
    return _union(frames)


def _path_tables(spark: SparkSession, owner: dict[str, str]) -> dict[str, DataFrame]:
    """Written tables ``(place, key)``: folders that hold files of one key, and the files of other folders."""
    folders: dict[str, set[str]] = {}
    for file, key in owner.items():
        folders.setdefault(file.rsplit("/", 1)[0], set()).add(key)
    rows = {"folder": [(f, min(k)) for f, k in folders.items() if len(k) == 1],
            "file": [(f, k) for f, k in owner.items() if len(folders[f.rsplit("/", 1)[0]]) > 1]}
    found = {}
    for kind, own in rows.items():
        if own:
            path = work_dir(spark, f"paths-{kind}")
            spark.createDataFrame(own, "place string, key string").write.parquet(path)
            found[kind] = spark.read.schema("place string, key string").parquet(path)
    return found


def _tagged(df: DataFrame, places: dict[str, DataFrame], tag: str) -> DataFrame:
    """``df`` with the key of each row's file."""
    columns = [c for c in df.columns if c != tag]
    out = df.select(*columns, _own_path().alias("__row_file"))
    for kind, table in places.items():
        place = F.regexp_extract("__row_file", "^(.*)/[^/]*$", 1) if kind == "folder" else F.col("__row_file")
        side = broadcast_if_small(table.select(F.col("place").alias(f"__at_{kind}"), F.col("key").alias(f"__key_{kind}")))
        out = out.join(side, place == F.col(f"__at_{kind}"), "left")
    unknown = F.raise_error(F.concat(F.lit("no key for the file "), F.col("__row_file"))).cast("string")
    return out.select(*columns, F.coalesce(*[F.col(f"__key_{kind}") for kind in places], unknown).alias(tag))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, partitions: int | None = None) -> DataFrame:
    """Read a database table; give a numeric partition column to read in parallel."""
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)
