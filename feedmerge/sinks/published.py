"""Partitioned tables whose state is a manifest, so that a commit happens whole or not at all.

Files lie below ``path/<partition>/version=<id>``. A manifest names, for each partition, the
versions that count, and is put in place by one rename after all files are written. A job that
dies before that leaves files no manifest names, which readers never open; those who
read an older manifest keep its files until ``vacuum``. One writer at a time: a second one that
publishes over the same manifest is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmerge.sources.files import child_names

VERSION = "version"
MANIFESTS = "_manifest"
Manifest = dict[str, list[str]]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def manifest_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests in place, oldest first."""
    return [int(n) for n in child_names(spark, f"{path.rstrip('/')}/{MANIFESTS}") if n.isdigit()]


def read_manifest(spark: SparkSession, path: str, number: int) -> Manifest:
    """Partition (as ``column=value/...``, '' if there is none) to its versions, oldest first."""
    jvm, target, fs = _fs(spark, f"{path.rstrip('/')}/{MANIFESTS}/{number:020d}")
    stream = fs.open(target)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(manifest_numbers(spark, path))


def current(spark: SparkSession, path: str) -> tuple[int, Manifest]:
    """The newest manifest and its number; 0 and nothing before the first commit."""
    numbers = manifest_numbers(spark, path)
    return (numbers[-1], read_manifest(spark, path, numbers[-1])) if numbers else (0, {})


def put_manifest(spark: SparkSession, path: str, number: int, manifest: Manifest) -> None:
    """Put manifest ``number`` in place; fails if another writer was faster."""
    base = f"{path.rstrip('/')}/{MANIFESTS}"
    jvm, fresh, fs = _fs(spark, f"{base}/.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    finally:
        out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{base}/{number:020d}")
    if fs.exists(final) or not fs.rename(fresh, final):
        fs.delete(fresh, False)
        raise RuntimeError(f"another writer has published manifest {number} of {path}")


def _partitions_of(spark: SparkSession, path: str, version: str, depth: int) -> list[str]:
    """The partitions that hold files of a version; names only are listed."""
    base = path.rstrip("/")
    jvm, target, fs = _fs(spark, "/".join([base, *["*"] * depth, f"{VERSION}={version}"]))
    found = fs.globStatus(target) or []
    names = [s.getPath().toString().split("/")[-depth - 1 : -1] if depth else [] for s in found]
    return ["/".join(n) for n in names]


def write_version(df: DataFrame, path: str, by: Sequence[str], rebalance: bool = True) -> tuple[str, list[str]]:
    """Write the rows as a version that no manifest names yet; its id and its partitions."""
    version = uuid.uuid4().hex
    spread = df.hint("rebalance", *[F.col(c) for c in by]) if rebalance else df
    spread.withColumn(VERSION, F.lit(version)).write.mode("append").partitionBy(*by, VERSION).parquet(path)
    return version, _partitions_of(df.sparkSession, path, version, len(by))


def publish_partitions(df: DataFrame, path: str, by: Sequence[str], rebalance: bool = True) -> list[str]:
    """Replace the partitions that ``df`` has rows for, all at once; returns them.

    ``df`` may read from ``path``: nothing is overwritten.
    """
    spark = df.sparkSession
    number, manifest = current(spark, path)
    version, touched = write_version(df, path, by, rebalance)
    if touched:
        put_manifest(spark, path, number + 1, {**manifest, **{p: [version] for p in touched}})
    return touched


def publish_changes(df: DataFrame, path: str) -> int:
    """Add the rows to a table without partitions; returns how many versions it holds now."""
    spark = df.sparkSession
    number, manifest = current(spark, path)
    # a frame of newest rows is spread by its key already
    version, touched = write_version(df, path, [], rebalance=False)
    held = manifest.get("", [])
    if touched:
        held = [*held, version]
        put_manifest(spark, path, number + 1, {"": held})
    return len(held)


def withdraw(spark: SparkSession, path: str, versions: Sequence[str]) -> None:
    """Take versions out of the manifest; their files stay until ``vacuum``."""
    number, manifest = current(spark, path)
    gone = set(versions)
    left = {p: [v for v in held if v not in gone] for p, held in manifest.items()}
    put_manifest(spark, path, number + 1, {p: held for p, held in left.items() if held})


def read_versions(
    spark: SparkSession, path: str, manifest: Manifest, only: Callable[[str], bool] | None = None, schema: str | None = None
) -> DataFrame | None:
    """The rows a manifest names, of some partitions if ``only`` is given, or None if there are none."""
    base = path.rstrip("/")
    files = [
        "/".join(filter(None, [base, p, f"{VERSION}={v}"]))
        for p, held in sorted(manifest.items())
        if only is None or only(p)
        for v in held
    ]
    if not files:
        return None
    reader = spark.read.option("basePath", base)
    if schema:
        reader = reader.schema(schema)
    return reader.parquet(*files).drop(VERSION)


def read_published(spark: SparkSession, path: str, only: Callable[[str], bool] | None = None) -> DataFrame | None:
    """The table as of its newest manifest, or None before the first commit."""
    return read_versions(spark, path, current(spark, path)[1], only)


def vacuum(spark: SparkSession, path: str, by: Sequence[str], keep: int = 2) -> list[str]:
    """Delete versions that none of the newest ``keep`` manifests names, and older manifests; returns the folders.

    Readers of older manifests and writers must have ended.
    """
    numbers = manifest_numbers(spark, path)
    named = {(p, v) for n in numbers[-keep:] for p, held in read_manifest(spark, path, n).items() for v in held}
    base = path.rstrip("/")
    jvm, target, fs = _fs(spark, "/".join([base, *["*"] * len(by), f"{VERSION}=*"]))
    removed = []
    for status in fs.globStatus(target) or []:
        parts = status.getPath().toString().split("/")
        partition = "/".join(parts[-len(by) - 1 : -1]) if by else ""
        if (partition, parts[-1].partition("=")[2]) not in named:
            fs.delete(status.getPath(), True)
            removed.append("/".join(filter(None, [partition, parts[-1]])))
    for n in numbers[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/{MANIFESTS}/{n:020d}"), False)
    return sorted(removed)
