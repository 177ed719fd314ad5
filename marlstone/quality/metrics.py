"""The duration and outcome of a job, kept as JSON beside the tables; recording never breaks the job."""

from __future__ import annotations

import contextlib
import time

from pyspark.sql import SparkSession

from marlstone.sources.storage import write_report


class JobRecord:
    def __init__(self, spark: SparkSession, name: str, folder: str):
        self.spark, self.name, self.folder, self.counts = spark, name, folder, {}

    def count(self, what: str, n: int = 1) -> None:
        self.counts[what] = self.counts.get(what, 0) + n

    def __enter__(self) -> JobRecord:
        self._began = time.time()
        return self

    def __exit__(self, kind, value, _) -> bool:
        with contextlib.suppress(Exception):
            row = {"name": self.name, "began": self._began, "seconds": round(time.time() - self._began, 3), "status": "failed" if kind else "ok", "error": str(value)[:300] if value else None, **self.counts}
            write_report(self.spark, row, f"{self.folder.rstrip('/')}/{self.name}-{int(self._began * 1000)}.json")
        return False
