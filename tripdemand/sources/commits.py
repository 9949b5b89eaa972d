"""Tables that change all at once: staged folders, and a commit file that names what counts.

A root holds one folder per table, in it one folder per write (``version=...``), and
``_commits``: numbered files, each listing the folders of every table. Writers stage new
folders, which no reader sees, and then publish one commit file by a rename. Readers follow
the last commit. So a failed or killed write leaves every table as it was, readers never see
half a change, and tables committed together are always of one make.

Folders that no commit names any more are deleted by ``remove_unused`` only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "_commits"
DIGITS = 10


def _folder(spark: SparkSession, path: str):
    """(file system, path) of any Hadoop path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def commit_numbers(spark: SparkSession, root: str) -> list[int]:
    """The commits of a root, oldest first."""
    return [int(n[:DIGITS]) for n in _names(spark, f"{root}/{LOG}") if n.endswith(".json") and n[:DIGITS].isdigit()]


def state(spark: SparkSession, root: str, number: int | None = None) -> dict[str, dict]:
    """Table -> its ``schema`` (JSON) and ``folders`` as of a commit, the last by default; empty without commits."""
    root = root.rstrip("/")
    if number is None:
        numbers = commit_numbers(spark, root)
        if not numbers:
            return {}
        number = numbers[-1]
    fs, p = _folder(spark, f"{root}/{LOG}/{number:0{DIGITS}}.json")
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _part(folder: str) -> str:
    """``key=value/...`` of a folder below its version."""
    return folder.partition("/")[2]


class Change:
    """New folders of some tables, staged until ``publish``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        numbers = commit_numbers(spark, self.root)
        self.number = numbers[-1] + 1 if numbers else 1
        self.tables = state(spark, self.root, numbers[-1]) if numbers else {}

    def replace(self, table: str, df: DataFrame, by: Sequence[str] = (), **options: str) -> None:
        """The table's rows become those of ``df``, in folders by the columns ``by``; ``options`` go to the writer."""
        self.tables[table] = {"schema": df.schema.json(), "folders": self._stage(table, df, by, options)}

    def replace_parts(self, table: str, df: DataFrame, by: Sequence[str], gone: Iterable[str] = ()) -> None:
        """Parts that ``df`` has rows of are replaced, those of ``gone`` (``key=value/...``) removed, others stay."""
        new = self._stage(table, df, by)
        drop = {_part(f) for f in new} | set(gone)
        old = [f for f in self.tables.get(table, {}).get("folders", []) if _part(f) not in drop]
        self.tables[table] = {"schema": df.schema.json(), "folders": old + new}

    def append(self, table: str, df: DataFrame, by: Sequence[str] = (), **options: str) -> None:
        """The rows of ``df`` are added."""
        old = self.tables.get(table, {}).get("folders", [])
        self.tables[table] = {"schema": df.schema.json(), "folders": old + self._stage(table, df, by, options)}

    def staged(self, table: str) -> DataFrame:
        """The table as it will be, for the steps of a change that build on each other."""
        return _read(self.spark, self.root, table, self.tables[table])

    def _stage(self, table: str, df: DataFrame, by: Sequence[str], options: dict[str, str] | None = None) -> list[str]:
        version = f"version=v{self.number}-{uuid.uuid4().hex[:8]}"
        writer = df.write.options(**(options or {}))
        writer = writer.partitionBy(*by) if by else writer
        writer.parquet(f"{self.root}/{table}/{version}")
        folders = [version]
        for _ in by:
            folders = [f"{f}/{n}" for f in folders for n in _names(self.spark, f"{self.root}/{table}/{f}") if "=" in n]
        return folders

    def publish(self) -> None:
        """Make the staged state the current one. Fails if another writer published first."""
        fs, temporary = _folder(self.spark, f"{self.root}/{LOG}/.{uuid.uuid4().hex}")
        out = fs.create(temporary, True)
        out.write(bytearray(json.dumps(self.tables).encode()))
        out.close()
        _, final = _folder(self.spark, f"{self.root}/{LOG}/{self.number:0{DIGITS}}.json")
        if fs.exists(final) or not fs.rename(temporary, final):
            fs.delete(temporary, False)
            raise RuntimeError(f"another writer has published commit {self.number} of {self.root}")


def _read(spark: SparkSession, root: str, table: str, entry: dict) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    if not entry["folders"]:
        return spark.createDataFrame([], schema)
    base = f"{root.rstrip('/')}/{table}"
    reader = spark.read.schema(schema).option("basePath", base)
    return reader.parquet(*(f"{base}/{f}" for f in entry["folders"])).select(*(F.col(f"`{n}`") for n in schema.names))


def has_table(spark: SparkSession, root: str, table: str) -> bool:
    return table in state(spark, root)


def read_committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as of the last commit; an error if none names it."""
    tables = state(spark, root)
    if table not in tables:
        raise FileNotFoundError(f"no committed table {table} under {root}")
    return _read(spark, root, table, tables[table])


def table_path(spark: SparkSession, root: str, table: str) -> str:
    """The folder of a table that its last write replaced as a whole."""
    versions = {f.partition("/")[0] for f in state(spark, root)[table]["folders"]}
    if len(versions) != 1:
        raise ValueError(f"{table} under {root} has {len(versions)} versions; use read_committed")
    return f"{root.rstrip('/')}/{table}/{versions.pop()}"


def intact(spark: SparkSession, root: str, tables: Sequence[str]) -> bool:
    """Whether the last commit names all of the tables and their folders are there."""
    current = state(spark, root)
    for t in tables:
        if t not in current:
            return False
        for f in current[t]["folders"]:
            fs, p = _folder(spark, f"{root.rstrip('/')}/{t}/{f}")
            if not fs.exists(p):
                return False
    return True


def remove_unused(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete versions and commits that the last ``keep`` commits do not name; returns the versions.

    Run it when no writer is staging and no job reads a state older than those.
    """
    root = root.rstrip("/")
    numbers = commit_numbers(spark, root)
    states = [state(spark, root, n) for n in numbers[-keep:]]
    removed = []
    for table in {t for s in (state(spark, root, n) for n in numbers) for t in s}:
        used = {f.partition("/")[0] for s in states for f in s.get(table, {}).get("folders", [])}
        for name in _names(spark, f"{root}/{table}"):
            if name.startswith("version=") and name not in used:
                fs, p = _folder(spark, f"{root}/{table}/{name}")
                fs.delete(p, True)
                removed.append(f"{table}/{name}")
    for n in numbers[:-keep]:
        fs, p = _folder(spark, f"{root}/{LOG}/{n:0{DIGITS}}.json")
        fs.delete(p, False)
    return removed
