"""Stored tables that change by whole versions: immutable folders and one pointer per version.

    root/data/_v=<n>/<partition folders>    rows written by version n, never changed
    root/versions/<n>.json                  the folders that make up version n, and its schema

A change writes its rows into a folder of its own and is committed by one rename of a small
pointer file, which only ever names complete folders. A job that dies before that leaves folders
no version names, and the next change writes over them. A reader keeps to the version it opened:
its folders stay as long as it is among the newest `KEEP`. One writer at a time; a second one that
started from the same version fails to commit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.sources import files

#: Versions whose folders are kept.
KEEP = 2
_V = "_v"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Version:
    """What a pointer file says. `folders` are relative to `root/data`."""

    number: int
    folders: tuple[str, ...]
    schema: T.StructType
    facts: dict


def values_of(folder: str) -> dict[str, str | None]:
    """The partition values in a folder's name."""
    parts = (p.split("=", 1) for p in folder.split("/"))
    return {k: None if v == NULL_FOLDER else unquote(v) for k, v in parts}


class VersionedTable:
    """A table at `root`, laid out by the columns `layout` (possibly none)."""

    def __init__(self, spark: SparkSession, root: str, layout: Sequence[str] = ()):
        self.spark, self.root, self.layout = spark, root, tuple(layout)

    # --- reading ------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        found = files.matching(self.spark, f"{self.root}/versions/*.json")
        return sorted(int(p.rsplit("/", 1)[1].removesuffix(".json")) for p in found)

    def version(self, number: int | None = None) -> Version | None:
        """The pointer of a version, by default of the newest; None before the first."""
        if number is None:
            numbers = self._numbers()
            if not numbers:
                return None
            number = numbers[-1]
        said = files.from_json(files.read_text(self.spark, f"{self.root}/versions/{number}.json"))
        if said is None:
            raise ValueError(f"{self.root} has no version {number}")
        schema = T.StructType.fromJson(said["schema"])
        return Version(number, tuple(said["folders"]), schema, said["facts"])

    def read(
        self, version: Version | None = None, only: Callable[[dict], bool] | None = None
    ) -> DataFrame:
        """The rows of a version; `only` picks folders by their partition values (texts or None)."""
        version = version or self.version()
        if version is None:
            raise ValueError(f"{self.root} was never written")
        wanted = [f for f in version.folders if only is None or only(values_of(f))]
        if not wanted:
            return self.spark.createDataFrame([], version.schema)
        stored = T.StructType([f for f in version.schema if f.name not in self.layout])
        for name in (_V, *self.layout):
            stored.add(name, "string")
        reader = self.spark.read.schema(stored).option("basePath", f"{self.root}/data")
        df = reader.parquet(*[f"{self.root}/data/{f}" for f in wanted])
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in version.schema])

    # --- changing -----------------------------------------------------------------------

    def write(self, rows: DataFrame, number: int) -> list[str]:
        """Rows into the folder of version `number`, replacing what a dead job left there.
        Returns the folders, which name every partition value that has rows."""
        path = f"{self.root}/data/{_V}={number}"
        files.delete(self.spark, path)
        out = rows.hint("rebalance", *self.layout) if self.layout else rows
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*self.layout) if self.layout else writer).parquet(path)
        if not self.layout:
            return [f"{_V}={number}"]
        depth = "/*=*" * len(self.layout)
        base = f"/data/{_V}={number}/"
        found = files.matching(self.spark, f"{path}{depth}")
        return sorted(f"{_V}={number}/" + p.split(base, 1)[1] for p in found)

    def commit(
        self, before: Version | None, folders: Iterable[str], schema: T.StructType, **facts
    ) -> Version:
        """Make `folders` the next version after `before`, then remove what no kept version names."""
        number = before.number + 1 if before else 1
        new = Version(number, tuple(sorted(folders)), schema, facts)
        said = {"folders": new.folders, "schema": schema.jsonValue(), "facts": facts}
        path = f"{self.root}/versions/{number}.json"
        files.create_text(self.spark, path, files.to_json(said))
        self.clean()
        return new

    def clean(self) -> None:
        """Remove old pointers and every folder that no kept version names."""
        numbers = self._numbers()
        for old in numbers[:-KEEP]:
            files.delete(self.spark, f"{self.root}/versions/{old}.json")
        kept = {f for n in numbers[-KEEP:] for f in self.version(n).folders}
        depth = "/*=*" * len(self.layout)
        for path in files.matching(self.spark, f"{self.root}/data/{_V}=*"):
            name = path.rsplit("/", 1)[1]
            if int(values_of(name)[_V]) > numbers[-1]:
                continue  # being written
            if not any(f.split("/", 1)[0] == name for f in kept):
                files.delete(self.spark, path)
                continue
            for part in files.matching(self.spark, path + depth) if depth else ():
                if f"{name}/{part.split(f'/data/{name}/', 1)[1]}" not in kept:
                    files.delete(self.spark, part)

    def next_number(self) -> tuple[Version | None, int]:
        before = self.version()
        return before, before.number + 1 if before else 1
