"""Versioned tables (ops A10, A11): data folders that never change, and a manifest that says which are live.

A write goes to a folder of its own. Only when all its rows are there does the next manifest name it, as a
small file under ``_live`` that is created under a number not used before; readers take the last complete one. So
a failed write leaves the old rows live, a table can be read while it is replaced, and of two writers
that start from the same version one fails instead of undoing the other. Data folders no longer
named by a manifest stay until the owner of the table clears them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

LIVE, DATA = "_live", "data"


def _place(spark: SparkSession, path: str):
    """Hadoop's view of a path: any store that Spark can write to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _place(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, by name; nothing if it doesn't exist."""
    fs, folder = _place(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(folder)) if fs.exists(folder) else []


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:-5]) for n in names(spark, f"{root}/{LIVE}") if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, root: str) -> dict | None:
    """The last complete manifest of a table, None if it has none. One that a lost writer left
    half-written can't be parsed and is passed over."""
    root = root.rstrip("/")
    for number in reversed(_numbers(spark, root)):
        fs, place = _place(spark, f"{root}/{LIVE}/{number:010d}.json")
        stream = fs.open(place)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            continue
    return None


def commit(spark: SparkSession, root: str, entries: dict, after: dict | None) -> dict:
    """Make ``entries`` the live manifest, the successor of ``after``. Raises if another
    writer has changed the table since."""
    root = root.rstrip("/")
    now = manifest(spark, root)
    if (now or {}).get("version") != (after or {}).get("version"):
        raise RuntimeError(f"{root} was changed by another writer; read it again and repeat the change")
    number = max(_numbers(spark, root), default=0) + 1
    fs, place = _place(spark, f"{root}/{LIVE}/{number:010d}.json")
    out = fs.create(place, False)  # fails if the number is taken
    try:
        out.write(bytearray(json.dumps({**entries, "version": number}).encode()))
    finally:
        out.close()
    return {**entries, "version": number}


def new_version() -> str:
    return uuid.uuid4().hex


def publish(df: DataFrame, root: str) -> dict:
    """Replace all rows of the table at ``root``; its manifest keeps their number, from the files' footers."""
    spark, root = df.sparkSession, root.rstrip("/")
    before = manifest(spark, root)
    folder = f"{DATA}/v={new_version()}"
    df.write.parquet(f"{root}/{folder}")
    rows = spark.read.schema(df.schema).parquet(f"{root}/{folder}").count()
    return commit(spark, root, {"folder": folder, "rows": rows, "schema": df.schema.json()}, before)


def live_path(spark: SparkSession, root: str) -> str:
    """The folder with a table's live rows: the one that its manifest names, or ``root`` itself for a plain folder."""
    entries = manifest(spark, root)
    return f"{root.rstrip('/')}/{entries['folder']}" if entries else root


def read_live(spark: SparkSession, root: str) -> DataFrame:
    """The rows that are live now; what is written later doesn't change them."""
    return spark.read.parquet(live_path(spark, root))
