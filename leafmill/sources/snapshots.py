"""Tables that are replaced as a whole: versions in folders of their own, and a manifest that is put if it isn't there.

A commit writes its rows to a new folder and then puts the next manifest. Only one writer can put it; another one finds it
there and has a conflict. Readers take the manifest that is latest when they begin, so they see a whole version, old or
new, and a writer that dies leaves a folder that no manifest names. A folder of plain Parquet files is version 0.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"


class Conflict(RuntimeError):
    """Somebody else has put the next version."""


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether this call put the file, which appears with all of its text or not at all."""
    at, fs = _at(spark, path)
    fs.mkdirs(at.getParent())
    if fs.getUri().getScheme() == "file":  # a rename would replace; a link doesn't
        final = at.toUri().getPath()
        draft = f"{os.path.dirname(final)}/.{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(draft, final)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    draft, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    won = bool(fs.rename(draft, at))  # false if the target is there
    if not won:
        fs.delete(draft, False)
    return won


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _at(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    at, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


class Table:
    def __init__(self, spark: SparkSession, path: str, schema: StructType | str | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _manifest(self, version: int) -> str:
        return f"{self.path}/{MANIFESTS}/{version:020d}.json"

    def versions(self) -> list[int]:
        return [int(n[:20]) for n in names(self.spark, f"{self.path}/{MANIFESTS}") if n.endswith(".json") and n[0] != "."]

    def version(self) -> int:
        return max(self.versions(), default=0)

    def folders(self, version: int) -> list[str]:
        return json.loads(read_text(self.spark, self._manifest(version)))["folders"] if version else ["."]

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        r = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        paths = [self.path if f == "." else f"{self.path}/{f}" for f in self.folders(version)]
        return r.parquet(*paths)

    def create(self) -> None:
        """An empty first version, unless there is a table."""
        if self.version() == 0 and not any(not n.startswith(("_", ".", "rows-")) for n in names(self.spark, self.path)):
            try:
                self.commit(self.spark.createDataFrame([], self.schema), 0)
            except Conflict:
                pass

    def commit(self, df: DataFrame, expect: int | None = None, append: bool = False) -> int:
        """The version that df makes, of all rows or of further ones. expect: the version df was worked out from; if another
        has come since, nothing changes and it is a Conflict.
        """
        expect = self.version() if expect is None else expect
        folder = f"rows-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        held = [*self.folders(expect), folder] if append else [folder]
        if not put_if_absent(self.spark, self._manifest(expect + 1), json.dumps({"version": expect + 1, "folders": held, "at": time.time()})):
            at, fs = _at(self.spark, f"{self.path}/{folder}")
            fs.delete(at, True)
            raise Conflict(f"{self.path} has a version {expect + 1} already")
        return expect + 1

    def change(self, f: Callable[[DataFrame], DataFrame], append: bool = False, tries: int = 20) -> int:
        """Commit f of the rows there are, worked out anew whenever another writer was first."""
        for left in range(tries - 1, -1, -1):
            now = self.version()
            try:
                return self.commit(f(self.read(now)), now, append)
            except Conflict:
                if not left:
                    raise
        raise AssertionError

    def vacuum(self, keep: int = 2, seconds: float = 7 * 86_400) -> list[str]:
        """Remove folders that none of the last versions names and that are older than so many seconds; their names."""
        last = self.versions()[-keep:]
        named = {f for v in last for f in self.folders(v)}
        gone = []
        for n in names(self.spark, self.path):
            at, fs = _at(self.spark, f"{self.path}/{n}")
            if n.startswith("rows-") and n not in named and fs.getFileStatus(at).getModificationTime() / 1000 <= time.time() - seconds:
                fs.delete(at, True)
                gone.append(n)
        return gone
