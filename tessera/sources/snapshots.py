"""Versioned tables: new folders first, then one pointer file.

A version is a set of tables that changes as one.  Every write goes to folders of its own
(``<table>/[<column>=<value>/]version=<token>``); nothing a reader may hold is overwritten.  ``commit`` then adds the
pointer ``_versions/<number>.json``, which names for each table (or partition) the folder that holds it: the switch is
one rename that fails if another writer took the number.  A write that fails before it leaves the old version as it was.

Readers pin a version: frames of a pin go on reading that version's folders until ``clean`` removes those that none of
the kept versions names.  The pointer holds names of folders only; it goes through the driver, rows never do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

VERSION = "version"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another writer committed since the draft was begun."""


class Files:
    """The few file operations a switch needs, on any file system that Spark can write."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._jvm, self._fs = jvm, jvm.org.apache.hadoop.fs
        self.fs = self.path(root).getFileSystem(self._conf)
        self.root = str(self.fs.makeQualified(self.path(root)).toString()).rstrip("/")

    def path(self, name: str):
        return self._fs.Path(name)

    def names(self, pattern: str) -> list[str]:
        found = self.fs.globStatus(self.path(pattern))
        return [str(s.getPath().toString()) for s in found or []]

    def age_s(self, name: str) -> float:
        return (self._jvm.java.lang.System.currentTimeMillis() - self.fs.getFileStatus(self.path(name)).getModificationTime()) / 1000

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return str(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> None:
        """The whole file under ``name`` at once, or an error if there is one already."""
        part = f"{name}.{uuid.uuid4().hex}.part"
        stream = self.fs.create(self.path(part), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        target = self.path(name)
        try:
            options = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
            self._fs.FileContext.getFileContext(target.toUri(), self._conf).rename(self.path(part), target, options)
        except Exception as e:
            self.fs.delete(self.path(part), False)
            if self.fs.exists(target):
                raise Conflict(f"{name} was written by another") from e
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class Pin:
    """One version: table names to frames.  Reads as a source mapping, so marts can be built from it."""

    def __init__(self, store: Snapshots, number: int, tables: dict, notes: dict):
        self.store, self.number, self.tables, self.notes = store, number, tables, notes

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def __getitem__(self, name: str) -> DataFrame:
        return self.read(name)

    def read(self, name: str, values: Iterable | None = None) -> DataFrame:
        """The table, or only its partitions of the given values (others are not even listed)."""
        table = self.tables[name]
        wanted = table["parts"] if values is None else {_folder(table["by"], v) for v in values}
        return self.store._frame(name, table, [k for k in table["parts"] if k in wanted])


class Snapshots:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.files = spark, Files(spark, path)
        self.path = self.files.root

    def numbers(self) -> list[int]:
        return sorted(int(n.rsplit("/", 1)[1][:-5]) for n in self.files.names(f"{self.path}/_versions/*.json"))

    def pin(self, number: int | None = None) -> Pin:
        """The named version, or the latest; version 0 is empty."""
        known = self.numbers()
        number = (known[-1] if known else 0) if number is None else number
        if number == 0:
            return Pin(self, 0, {}, {})
        if number not in known:
            raise LookupError(f"no version {number} under {self.path}")
        said = json.loads(self.files.read(f"{self.path}/_versions/{number:08d}.json"))
        return Pin(self, number, said["tables"], said["notes"])

    def begin(self, base: Pin | None = None) -> Draft:
        return Draft(self, base or self.pin())

    def clean(self, keep: int = 2, least_age_s: float = 86_400) -> list[str]:
        """Removes pointers but for the last ``keep``, and folders that none of these names and that are old enough
        not to belong to a write under way."""
        numbers = self.numbers()
        for n in numbers[:-keep]:
            self.files.delete(f"{self.path}/_versions/{n:08d}.json")
        named = set()
        for n in numbers[-keep:]:
            for name, table in self.pin(n).tables.items():
                named |= {self._folder_path(name, k, token) for k, token in table["parts"].items()}
        found = [f for pattern in ("*", "*/*=*") for f in self.files.names(f"{self.path}/{pattern}/{VERSION}=*")]
        gone = [f for f in found if f not in named and self.files.age_s(f) >= least_age_s]
        for f in gone:
            self.files.delete(f)
        return gone

    def _folder_path(self, name: str, part: str, token: str) -> str:
        return "/".join([self.path, name, *([part] if part else []), f"{VERSION}={token}"])

    def _frame(self, name: str, table: dict, parts: list[str]) -> DataFrame:
        schema = StructType.fromJson(table["schema"])
        if not parts:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(StructType([*schema.fields, StructField(VERSION, StringType())])).option("basePath", f"{self.path}/{name}")
        return read.parquet(*[self._folder_path(name, k, table["parts"][k]) for k in parts]).select(*schema.fieldNames())


def _folder(by: str | None, value) -> str:
    return f"{by}={NULL_PARTITION if value is None else value}" if by else ""


class Draft:
    """A version to be: tables written to folders that nothing names until ``commit``."""

    def __init__(self, store: Snapshots, base: Pin):
        self.store, self.base = store, base
        self.tables = {k: {**t, "parts": dict(t["parts"])} for k, t in base.tables.items()}
        self.token = f"{base.number + 1:08d}-{uuid.uuid4().hex[:12]}"

    def dealt(self, df: DataFrame, by: str) -> DataFrame:
        """``df`` with each value of ``by`` in one task, as ``replace`` writes it: a partition is one task's file, not one
        of each task."""
        return df.repartition(int(self.store.spark.conf.get("spark.sql.shuffle.partitions")), by)

    def replace(self, name: str, df: DataFrame, by: str | None = None, values: Iterable | None = None, dealt: bool = False) -> DataFrame:
        """Writes ``df`` as the table, or with ``values`` as its partitions of these values of ``by``, and reads it back.

        Partitions named in ``values`` that ``df`` has no rows for are empty in the new version.  Rows of other
        partitions are an error.  ``dealt``: ``df`` was made from rows that are ``dealt`` by ``by`` and still lie so.
        """
        if VERSION in df.columns:
            raise ValueError(f"{name}: a table cannot have a column named {VERSION}")
        token = f"{self.token}-{uuid.uuid4().hex[:6]}"
        at = f"{self.store.path}/{name}"
        rows = self.dealt(df, by) if by and not dealt else df
        rows.withColumn(VERSION, F.lit(token)).write.mode("append").partitionBy(*([by] if by else []), VERSION).parquet(at)
        found = self.store.files.names(f"{at}/{by}=*/{VERSION}={token}" if by else f"{at}/{VERSION}={token}")
        new = {f.rsplit("/", 2)[1] if by else "": token for f in found}
        old = self.tables.get(name, {"by": by, "parts": {}})
        if values is not None:
            if old["by"] != by:
                raise ValueError(f"{name} is partitioned by {old['by']}")
            drop = {_folder(by, v) for v in values}
            if not set(new) <= drop:
                raise ValueError(f"{name}: rows outside the partitions to be replaced: {sorted(set(new) - drop)[:5]}")
            kept = {k: t for k, t in old["parts"].items() if k not in drop}
        else:
            kept = {}
        schema = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields]).jsonValue()
        self.tables[name] = {"by": by, "schema": schema, "parts": {**kept, **new}}
        return self.store._frame(name, self.tables[name], sorted(new))

    def read(self, name: str, values: Iterable | None = None) -> DataFrame:
        return Pin(self.store, 0, self.tables, {}).read(name, values)

    def values(self, name: str) -> list[str | None]:
        """The values of the partitions that hold rows, as folder names spell them."""
        said = [k.split("=", 1)[1] for k in self.tables[name]["parts"]]
        return [None if v == NULL_PARTITION else v for v in said]

    def drop(self, name: str) -> None:
        self.tables.pop(name, None)

    def commit(self, **notes) -> Pin:
        """Makes the draft the next version; ``notes`` are added to those of the version before."""
        number = self.base.number + 1
        said = {"tables": self.tables, "notes": {**self.base.notes, **notes}}
        self.store.files.put_new(f"{self.store.path}/_versions/{number:08d}.json", json.dumps(said))
        return Pin(self.store, number, self.tables, said["notes"])
