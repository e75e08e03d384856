"""Publishing a set of tables at once.

A set is written into a folder of its own, ``results/sets/<id>``, and becomes the
published one by a single rename of its manifest to the next number,
``results/manifests/<number>.json``. Readers take the manifest of the highest
number, so they see one whole set or the one before; a run that fails leaves the
published set as it was. Two runs that publish at the same time cannot take the
same number: the later one fails. The last ``keep`` sets stay for readers that
have begun; older ones, and what failed runs left before them, are removed.
"""

from __future__ import annotations

import json
import uuid
from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from importlens.plans.stages import build_concurrently


def _hadoop(spark: SparkSession, path: str):
    """File system of ``path``, and a maker of its paths."""
    jvm = spark._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _numbers(spark: SparkSession, base: str) -> list[int]:
    fs, path = _hadoop(spark, base)
    folder = path(f"{base}/manifests")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _manifest(spark: SparkSession, base: str, number: int) -> dict:
    fs, path = _hadoop(spark, base)
    stream = fs.open(path(f"{base}/manifests/{number}.json"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def current(spark: SparkSession, out_dir: str) -> dict:
    """Manifest of the published set: ``number``, ``set`` and the ``tables``' folders (relative to ``out_dir``)."""
    base = f"{out_dir.rstrip('/')}/results"
    found = _numbers(spark, base)
    if not found:
        raise FileNotFoundError(f"nothing is published under {out_dir}")
    return _manifest(spark, base, found[-1]) | {"number": found[-1]}


def publish_set(tables: Mapping[str, DataFrame], out_dir: str, write: Callable[[str, DataFrame, str], None],
                keep: int = 3) -> dict[str, str]:
    """Write every table by ``write(name, df, folder)``, side by side, then publish them as one set.

    Returns the tables' folders. If a table fails, the error is raised and nothing is published.
    """
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    out_dir = out_dir.rstrip("/")
    base, own = f"{out_dir}/results", uuid.uuid4().hex
    before = _numbers(spark, base)
    folders = {name: f"results/sets/{own}/{name}" for name in tables}
    build_concurrently(spark, {n: (lambda n=n, df=df: write(n, df, f"{out_dir}/{folders[n]}")) for n, df in tables.items()})
    number = (before[-1] if before else 0) + 1
    fs, path = _hadoop(spark, base)
    draft = path(f"{base}/manifests/.{own}")
    stream = fs.create(draft)
    try:
        stream.write(bytearray(json.dumps({"set": own, "tables": folders}).encode()))
    finally:
        stream.close()
    # without an overwrite option this fails if the number was taken meanwhile
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(draft, path(f"{base}/manifests/{number}.json"), none)
    _remove_old(spark, base, keep)
    return {name: f"{out_dir}/{folder}" for name, folder in folders.items()}


def _remove_old(spark: SparkSession, base: str, keep: int) -> None:
    """Drop the manifests before the last ``keep``, and the sets written before the oldest one kept that no manifest names."""
    fs, path = _hadoop(spark, base)
    numbers = _numbers(spark, base)
    kept = numbers[-max(1, keep):]
    named = {_manifest(spark, base, n)["set"] for n in kept}
    for n in numbers[:-len(kept)]:
        fs.delete(path(f"{base}/manifests/{n}.json"), False)
    sets = {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(path(f"{base}/sets"))}
    oldest = min(sets[s] for s in named if s in sets)
    for name, changed in sets.items():
        if name not in named and changed < oldest:      # a run under way has a younger folder
            fs.delete(path(f"{base}/sets/{name}"), True)


def read_set(spark: SparkSession, out_dir: str, names: list[str] | None = None, part: str = "parquet") -> dict[str, DataFrame]:
    """Readers over the tables of the published set, all of one manifest."""
    tables = current(spark, out_dir)["tables"]
    return {n: spark.read.parquet(f"{out_dir.rstrip('/')}/{tables[n]}/{part}") for n in (names or tables)}
