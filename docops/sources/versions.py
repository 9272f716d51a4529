"""Small tables that change together: each version is a folder, complete once it has its name."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the prefix of a version's folder.
VERSION = "version="

Written = Mapping[str, DataFrame]


class VersionConflictError(RuntimeError):
    """Somebody else has written the version that was to be written."""


class VersionedTables:
    """Tables below ``root``, all of one version at a time.

    A version is written to a folder of its own and then renamed, which a file system does
    whole or not at all, and never onto a folder that is there. So a reader sees all tables
    of one version, an interrupted write leaves the last version as it was, and of two
    writers that start from one version the second fails. Old versions stay until somebody
    deletes them: a reader that has begun with one ends with it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _hadoop(self):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs

    def _files(self):
        """The file system of ``root``, by the interface whose rename never overwrites."""
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        context, uri = self._hadoop().FileContext, self._hadoop().Path(self.root).toUri()
        return context.getFileContext(uri, conf) if uri.getScheme() else context.getFileContext(conf)

    def latest(self) -> int | None:
        """The newest complete version, None before the first."""
        root, files = self._hadoop().Path(self.root), self._files()
        if not files.util().exists(root):
            return None
        names = [status.getPath().getName() for status in files.util().listStatus(root)]
        numbers = [name.removeprefix(VERSION) for name in names if name.startswith(VERSION)]
        return max((int(n) for n in numbers if n.isdigit()), default=None)

    def read(self, name: str, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{VERSION}{version}/{name}")

    def commit(self, steps: Mapping[str, DataFrame | Callable[[Written], DataFrame]], after: int | None) -> int:
        """Writes the version behind ``after`` and returns its number.

        A table may be a function instead of a frame: it is called with the tables
        that have been written before it, so what they hold is not computed again.
        """
        version = 0 if after is None else after + 1
        staged = f"{self.root}/staged-{uuid.uuid4().hex}"
        written: dict[str, DataFrame] = {}
        for name, step in steps.items():
            rows = step(written) if callable(step) else step
            rows.write.parquet(f"{staged}/{name}")
            written[name] = self.spark.read.schema(rows.schema).parquet(f"{staged}/{name}")
        self._rename(staged, f"{self.root}/{VERSION}{version}")
        return version

    def _rename(self, source: str, target: str) -> None:
        fs, files = self._hadoop(), self._files()
        gateway = self.spark.sparkContext._gateway
        plainly = gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            files.rename(fs.Path(source), fs.Path(target), plainly)
        except Exception as error:
            if files.util().exists(fs.Path(target)) and files.util().exists(fs.Path(source)):
                raise VersionConflictError(f"{target} is already there") from error
            raise
