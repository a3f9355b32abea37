"""What columns a table's change files have, as a ledger that grows with the files.

One row per column, type and table, with the first file that has it. An update
looks at files that are newer than the last one, and at their footers only:
Spark merges the footers of a folder in one job, and only a column or type that
the ledger does not know yet is traced to its file, by halving the list. All
files are then read under the union of the ledger's columns in wide types: a
column is null in files from before it appeared, a number that has been widened
arrives whole, and `changes.conform` counts what the declared type cannot hold.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER = "table string, column string, type string, first_file string, seen_ms long"
#: The row that says up to when files have been looked at.
LOOKED = ""
WHOLE = {"tinyint", "smallint", "int", "bigint"}
REAL = {"float", "double"}


class SchemaConflict(ValueError):
    """A column whose types in different files have no common wide type."""


def leaves(schema: T.StructType, above: str = "") -> Iterator[tuple[str, str]]:
    """(path, type) of every column that is no struct; fields of structs by dotted path."""
    for f in schema.fields:
        name = f"{above}{f.name}"
        if isinstance(f.dataType, T.StructType):
            yield from leaves(f.dataType, f"{name}.")
        else:
            yield name, f.dataType.simpleString()


def wide(types: Iterable[str], column: str = "") -> str:
    """The widest of some types, which every one of them can be read as."""
    found = set(types)
    if found <= WHOLE:
        return "bigint"
    if found <= REAL:
        return "double"
    if len(found) == 1:
        return found.pop()
    raise SchemaConflict(f"column {column} is of types {', '.join(sorted(found))}, which cannot be read as one")


def union(known: Iterable[tuple[str, str]]) -> T.StructType:
    """All columns as one schema, structs rebuilt from their paths, in the order given."""
    types: dict[str, list[str]] = {}
    for column, kind in known:
        types.setdefault(column, []).append(kind)
    tree: dict = {}
    for column, kinds in types.items():
        *above, last = column.split(".")
        at = tree
        for name in above:
            at = at.setdefault(name, {})
            if not isinstance(at, dict):
                raise SchemaConflict(f"column {column} lies below a column that is no struct")
        if isinstance(at.get(last), dict):
            raise SchemaConflict(f"column {column} is a struct in some files only")
        at[last] = wide(kinds, column)

    def built(level: dict) -> str:
        return ",".join(
            f"`{name}`:struct<{built(below)}>" if isinstance(below, dict) else f"`{name}`:{below}" for name, below in level.items()
        )

    return T.StructType.fromDDL(f"_row struct<{built(tree)}>")["_row"].dataType if tree else T.StructType()


@dataclass(frozen=True)
class SchemaLedger:
    """The ledger of one table below a state folder."""

    spark: SparkSession
    path: str
    table: str

    def rows(self) -> list[tuple[str, str]]:
        """(column, type) pairs in the order in which they were found."""
        return [(r["column"], r["type"]) for r in self._stored() if r["column"] != LOOKED]

    def schema(self) -> T.StructType:
        """The union of all columns known, in wide types."""
        return union(self.rows())

    def first_files(self) -> dict[tuple[str, str], str]:
        return {(r["column"], r["type"]): r["first_file"] for r in self._stored() if r["column"] != LOOKED}

    def update(self, root: str) -> int:
        """Looks at the files below a folder that are newer than the last ones; returns what is new."""
        stored = self._stored()
        since = max((r["seen_ms"] for r in stored if r["column"] == LOOKED), default=None)
        known = {(r["column"], r["type"]) for r in stored}
        files = self._listing(root, since)
        folder = F.regexp_replace("path", "/[^/]*$", "")
        # One row per folder with new files, such as a day.
        folders = files.groupBy(folder.alias("folder")).agg(F.max("ms").alias("ms")).orderBy("folder").collect()
        if not folders:
            return 0
        new: list[tuple[str, str, str]] = []
        for row in folders:
            here = sorted(r["path"] for r in files.where(folder == row["folder"]).select("path").collect())
            self._trace(here, known, new)
        newest = max(r["ms"] for r in folders)
        # The newest moment is looked at again: another file may still come in it.
        found = [(self.table, c, t, f, newest - 1) for c, t, f in new] + [(self.table, LOOKED, "", "", newest - 1)]
        self.spark.createDataFrame(found, LEDGER).coalesce(1).write.mode("append").partitionBy("table").parquet(self.path)
        return len(new)

    def _trace(self, files: Sequence[str], known: set[tuple[str, str]], new: list[tuple[str, str, str]]) -> None:
        """Adds what the files have and nobody knows, each with the first file that has it."""
        seen = self._merged(files)
        if seen is not None and all(pair in known for pair in seen):
            return
        if len(files) == 1:
            for pair in seen or ():
                if pair not in known:
                    known.add(pair)
                    new.append((*pair, files[0]))
            return
        half = len(files) // 2
        self._trace(files[:half], known, new)
        self._trace(files[half:], known, new)

    def _merged(self, files: Sequence[str]) -> list[tuple[str, str]] | None:
        """Columns of all files together, None where their types cannot be merged or a file is broken."""
        try:
            reader = self.spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
            return list(leaves(reader.parquet(*files).schema))
        except (PySparkException, Py4JJavaError):
            return None

    def _listing(self, root: str, since: int | None) -> DataFrame:
        """path, ms of files that are newer than a time; no file is opened."""
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        if since is not None:
            after = datetime.fromtimestamp(since / 1000, tz=timezone.utc)
            reader = reader.option("modifiedAfter", after.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
        files = reader.load(root).select("path", F.unix_millis("modificationTime").alias("ms"))
        return files if since is None else files.where(F.col("ms") > since)

    def _stored(self) -> list:
        # One row per column and type, and one per update.
        try:
            rows = self.spark.read.schema(LEDGER).parquet(self.path).where(F.col("table") == self.table)
            return rows.groupBy("table", "column", "type").agg(
                F.min_by("first_file", "seen_ms").alias("first_file"),
                F.when(F.col("column") == LOOKED, F.max("seen_ms")).otherwise(F.min("seen_ms")).alias("seen_ms"),
            ).orderBy("seen_ms", "column").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
