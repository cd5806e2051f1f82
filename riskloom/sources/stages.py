"""Named stages of a run that a later run can take up again.

``Stages`` keeps what a stage returns as parquet under a folder, and afterwards a
manifest entry: the stage's name, the digest of what it was computed from, and its
path.  A run that finds an entry with the same digest reads the stored table; a
stage whose driver died before the entry was written is computed again.  Entries are
small JSON files beside the tables, so any driver with the folder can go on.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def input_digest(df: DataFrame, **parameters: object) -> str:
    """What a run depends on: the plan that reads its input, the input files, and parameters.

    Files that are replaced under the same names are not told apart: name batches
    anew, or pass a version among the parameters."""
    known = json.dumps([sorted(df.inputFiles()), df.schema.json(), {k: repr(v) for k, v in sorted(parameters.items())}])
    return hashlib.sha256(known.encode()).hexdigest()[:16]


class Stages:
    """Stages of one run under ``folder``; ``digest`` tells runs with other input apart."""

    def __init__(self, spark: SparkSession, folder: str, digest: str):
        self.spark, self.folder, self.digest = spark, folder.rstrip("/"), digest
        self.resumed: list[str] = []
        self.computed: list[str] = []

    def _paths(self, name: str) -> tuple[str, str]:
        return f"{self.folder}/{name}-{self.digest}", f"{self.folder}/_manifest/{name}-{self.digest}"

    def stored(self, name: str) -> DataFrame | None:
        """The table of a finished stage."""
        _, entry = self._paths(name)
        try:
            rows = self.spark.read.schema("stage string, digest string, path string, columns string").json(entry).collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None
        return self.spark.read.parquet(rows[0]["path"]) if rows else None

    def keep(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """What ``make`` returns, computed once for this digest."""
        found = self.stored(name)
        if found is not None:
            self.resumed.append(name)
            return found
        path, entry = self._paths(name)
        df = make()
        df.write.mode("overwrite").parquet(path)
        record = [(name, self.digest, path, json.dumps(df.columns))]
        self.spark.createDataFrame(record, "stage string, digest string, path string, columns string").coalesce(1).write.mode("overwrite").json(entry)
        self.computed.append(name)
        return self.spark.read.parquet(path)

    def clean(self) -> None:
        """Delete the tables and entries of this digest (the entry first)."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in {*self.resumed, *self.computed}:
            for path in reversed(self._paths(name)):
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(conf).delete(target, True)
