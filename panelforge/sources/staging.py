"""Tables written on the way to a result, and figures observed while they are written."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from panelforge.sources import readers


def write_observed(df: DataFrame, path: str, figures: dict[str, Column]) -> dict:
    """Write ``df`` as Parquet; ``figures`` (aggregates) are taken of the rows as they pass, not by a pass of their own.

    They are observed directly below the write. That stage's tasks count once each, however often one is run again
    after an executor was lost, so the figures are those of the rows written."""
    names = {f"f{i}": n for i, n in enumerate(figures)}
    if not names:
        df.write.parquet(path)
        return {}
    seen = Observation()
    df.observe(seen, *[figures[n].alias(k) for k, n in names.items()]).write.parquet(path)
    return {names[k]: v for k, v in seen.get.items()}


class Staging:
    """Tables in the shared folder, kept until ``release`` or until the driver's interpreter ends. Unlike rows kept in an
    executor's storage they outlive it, and a reader takes only the columns that it needs."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        atexit.register(self._release_quietly)

    def table(self, df: DataFrame, name: str, figures: dict[str, Column] | None = None) -> tuple[DataFrame, dict]:
        """(``df`` written and read back, its figures): lineage ends here."""
        path = f"{readers.scratch_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        found = write_observed(df, path, figures or {})
        return self.spark.read.schema(df.schema).parquet(path), found

    def release(self) -> None:
        while self.paths:
            readers.remove(self.spark, self.paths.pop())
        atexit.unregister(self._release_quietly)

    def _release_quietly(self) -> None:
        try:
            self.release()
        except Exception:  # the application has ended; its shared folder goes with it
            return
