"""Datasets in committed versions.

A version is written to a folder of its own; a manifest that names it, put in place in one step, commits it. Readers
take the last manifest (or one they ask for), so they see a whole version or the one before, whatever happens to the
job that writes: a failed or repeated one leaves at worst a folder that no manifest names. Two jobs that commit at once
get two versions. Versions are removed by :func:`forget` and nothing else.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.sources import writers
from tablewright.sources.folders import Folders
from tablewright.sources.readers import read_csv

FORMATS = ("csv", "parquet")
#: Other jobs may commit first; so often the next number is tried.
COMMIT_ATTEMPTS = 100


@dataclass(frozen=True)
class Version:
    """What a manifest says."""

    number: int
    folder: str
    format: str
    rows: int
    schema: str
    options: dict = field(default_factory=dict)


def _manifests(path: str) -> str:
    return f"{path.rstrip('/')}/_manifests"


def _data(path: str, folder: str) -> str:
    return f"{path.rstrip('/')}/{folder}"


def _numbers(folders: Folders, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in folders.names(_manifests(path)) if n[0] != "." and n.endswith(".json"))


def _version(folders: Folders, path: str, number: int) -> Version:
    return Version(**json.loads(folders.read(f"{_manifests(path)}/{number:010d}.json")))


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All committed versions, oldest first."""
    folders = Folders(spark, path)
    return [_version(folders, path, n) for n in _numbers(folders, path)]


def publish(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
    null_text: str = "",
    multi_line: bool = False,
    rebalance: bool = False,
) -> Version:
    """Write the rows as a new version of the dataset and commit it.

    ``df`` may read earlier versions. Rows are counted while they are written, and the number is in the manifest.
    """
    if format not in FORMATS:
        raise ValueError(f"format must be one of {list(FORMATS)}, not {format!r}")
    if partition_by and format != "parquet":
        raise ValueError("only Parquet is written by partitions")
    spark = df.sparkSession
    folders = Folders(spark, path)
    folder = f"_version-{uuid.uuid4().hex}"
    counted = Observation()
    seen = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if format == "csv":
        writers.load_csv(seen, _data(path, folder), mode="error", null_text=null_text, rebalance=rebalance)
    elif partition_by:
        writers.load_partitioned(seen, _data(path, folder), *partition_by, rebalance=rebalance)
    else:
        writers.load_parquet(seen, _data(path, folder), mode="error", rebalance=rebalance)
    options = {"null_text": null_text, "multi_line": multi_line} if format == "csv" else {}
    folders.make(_manifests(path))
    for _ in range(COMMIT_ATTEMPTS):
        number = max(_numbers(folders, path), default=0) + 1
        version = Version(number, folder, format, counted.get["rows"], df.schema.json(), options)
        target = f"{_manifests(path)}/{number:010d}.json"
        try:
            folders.put(target, json.dumps(asdict(version), sort_keys=True))
            return version
        except Exception:
            if not folders.exists(target):
                raise
    raise RuntimeError(f"{COMMIT_ATTEMPTS} other jobs have committed to {path} meanwhile")


def published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The last committed version, or the one with that number."""
    folders = Folders(spark, path)
    there = _numbers(folders, path)
    if not there or (number is not None and number not in there):
        raise FileNotFoundError(f"{path} has no committed version{'' if number is None else f' {number}'}")
    version = _version(folders, path, there[-1] if number is None else number)
    schema = T.StructType.fromJson(json.loads(version.schema))
    if version.format == "csv":
        return read_csv(spark, _data(path, version.folder), schema, **version.options)
    return spark.read.schema(schema).parquet(_data(path, version.folder)).select(*(F.col(f"`{c}`") for c in schema.names))


def forget(spark: SparkSession, path: str, keep: int = 2, abandoned_hours: float = 24.0) -> list[str]:
    """Remove all but the last ``keep`` versions, and folders that no manifest names and nobody wrote to for that long.

    The manifest goes first, so that no reader is sent to rows that are being removed. Returns the folders removed.
    """
    if keep < 1:
        raise ValueError("the last version stays")
    folders = Folders(spark, path)
    committed = versions(spark, path)
    gone = []
    for old in committed[:-keep]:
        folders.remove(f"{_manifests(path)}/{old.number:010d}.json")
        gone.append(old.folder)
    named = {v.folder for v in committed}
    oldest = (time.time() - abandoned_hours * 3600) * 1000
    for name, changed in folders.names(path).items():
        if name.startswith("_version-") and name not in named and changed < oldest:
            gone.append(name)
    for folder in gone:
        folders.remove(_data(path, folder))
    return gone
