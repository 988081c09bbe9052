"""The feature store: versions of one Parquet table partitioned by split and of its codes, and a manifest that names one."""

from __future__ import annotations

import datetime
import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions import schema as S
from panelforge.operators import features as X
from panelforge.operators.clean import null_figures, refuse_nulls
from panelforge.sources import readers
from panelforge.sources.staging import Staging

# The panel's own columns by group; what the feature builders make is added to the same groups.
_GIVEN = {
    "identifiers": [*S.ID_COLUMNS, "d", "d_int"],
    "target": ["sales"],
    "calendar_features": [c for c in S.CALENDAR_COLUMNS if c not in ("d", "d_int")],
    "price_features": ["sell_price"],
}
GROUPS = ["identifiers", "target", "lag_features", "rolling_features", "calendar_features", "price_features", "label_encoded", "other"]
_NAMES = re.compile("|".join(f"(?P<{g}>{'|'.join([*map(re.escape, _GIVEN.get(g, [])), *X.MAKES.get(g, [])])})" for g in GROUPS[:-1]), re.DOTALL)


def group_of(column: str) -> str:
    """The first group of ``GROUPS`` that lists the name."""
    found = _NAMES.fullmatch(column)
    return found.lastgroup if found else GROUPS[-1]


def feature_groups(columns: Sequence[str]) -> dict[str, list[str]]:
    return {g: [c for c in columns if group_of(c) == g] for g in GROUPS}


def split_of(day: Column | str = "d_int") -> Column:
    """train, valid or test by walk-forward day ranges; null outside of all."""
    day = F.col(day) if isinstance(day, str) else day
    out = F.lit(None).cast("string")
    for name, (first, last) in S.SPLITS.items():
        out = F.when(day.between(first, last), F.lit(name)).otherwise(out)
    return out


def row_figures(columns: Sequence[str]) -> dict[str, Column]:
    """Counts of rows, in all and by split, and of nulls. The test count has no upper bound, unlike the test split."""
    day = F.col("d_int")
    nulls = F.sum(sum((F.col(f"`{c}`").isNull().cast("long") for c in columns), F.lit(0).cast("long")))
    return {
        "n_rows": F.count(F.lit(1)),
        "train_rows": F.count_if(day.between(*S.SPLITS["train"])),
        "valid_rows": F.count_if(day.between(*S.SPLITS["valid"])),
        "test_rows": F.count_if(day >= S.SPLITS["test"][0]),
        "null_count": F.coalesce(nulls, F.lit(0)).cast("long"),
    }


def manifest_counts(df: DataFrame) -> DataFrame:
    """One row of ``row_figures``."""
    return df.agg(*[v.alias(n) for n, v in row_figures(df.columns).items()])


#: Rows in a file of the store, about.
FILE_ROWS = 1_000_000


class FeatureStore:
    """Everything lives under ``path``: versions/<name>/features (a folder per split, and one for rows outside of all),
    versions/<name>/codes, and manifest.json.

    The manifest names the version that readers see. A save writes a version of its own and then renames a new manifest
    over the old one, the only change that readers notice: a save that dies on its way leaves the old version in place.
    The version before the present one stays for readers that are still at it; older ones go. What dead saves left is
    removed by ``vacuum``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _version(self, name: str | None = None) -> str:
        return f"{self.path}/versions/{name or self._manifest()['version']}"

    def _manifest(self) -> dict:
        return json.loads(readers.read_text(self.spark, f"{self.path}/manifest.json"))

    @property
    def features(self) -> str:
        """The folder of the present version's rows."""
        return f"{self._version()}/features"

    def exists(self) -> bool:
        """Whether a version was committed and is there."""
        if not readers.exists(self.spark, f"{self.path}/manifest.json"):
            return False
        return "version" in self._manifest() and readers.is_complete(self.spark, self.features)

    def save(self, df: DataFrame, codes: DataFrame | None = None, *, config: S.FeatureConfig = S.FeatureConfig(), force: bool = False, file_rows: int = FILE_ROWS) -> None:
        """Write once; a complete store is kept unless ``force``. Refuses nulls and frames without d_int.

        ``df`` is computed once: it is staged, and rows, splits and nulls are counted as it passes. The staged rows are
        dealt into ranges of (split, id, d_int) and sorted, in files of about ``file_rows`` rows, so that a filter on id
        skips the files and row groups of other series."""
        if not force and self.exists():
            return
        if "d_int" not in df.columns:
            raise RuntimeError("splits need the column d_int")
        staging, columns = Staging(self.spark), df.columns
        try:
            nulls = {f"nulls_{c}": v for c, v in null_figures(df).items()}
            rows, found = staging.table(df.withColumn("split", F.coalesce(split_of(), F.lit("none"))), "features", row_figures(columns) | nulls)
            refuse_nulls({n.removeprefix("nulls_"): found.pop(n) for n in nulls})
            name = f"{datetime.datetime.now():%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
            order = [c for c in ("split", "id", "d_int") if c in rows.columns]
            clustered = rows.repartitionByRange(-(-found["n_rows"] // file_rows) or 1, *order).sortWithinPartitions(*order)
            clustered.write.partitionBy("split").parquet(f"{self._version(name)}/features", compression="snappy")
            if codes is not None:
                codes.write.parquet(f"{self._version(name)}/codes")
            self._commit(name, df, found, config)
        finally:
            staging.release()

    def _commit(self, name: str, df: DataFrame, found: dict, config: S.FeatureConfig) -> None:
        before = self._manifest() if readers.exists(self.spark, f"{self.path}/manifest.json") else {}
        manifest = {
            "n_features": len(df.columns),
            **found,
            "created_at": datetime.datetime.now().isoformat(),
            "feature_groups": feature_groups(df.columns),
            "column_dtypes": dict(df.dtypes),
            "lag_days": list(config.lags),
            "rolling_windows": list(config.windows),
            "rolling_stats": list(config.stats),
            "forecast_horizon": config.horizon,
            "version": name,
            "previous": before.get("version"),
        }
        readers.write_text(self.spark, f"{self.path}/manifest.json", json.dumps(manifest, indent=2))
        if before.get("previous"):
            readers.remove(self.spark, self._version(before["previous"]))

    def vacuum(self) -> None:
        """Remove all versions but the present one; for when no save and no older reader is at work."""
        if readers.exists(self.spark, f"{self.path}/manifest.json"):
            for name in readers.children(self.spark, f"{self.path}/versions"):
                if name != self._manifest()["version"]:
                    readers.remove(self.spark, self._version(name))

    def load_split(self, split: str, columns: Sequence[str] | None = None) -> DataFrame:
        """train, valid, test, or full (all rows); only the split's folder is read."""
        if split not in (*S.SPLITS, "full"):
            raise ValueError(f"no split {split!r}: train, valid, test or full")
        if not self.exists():
            raise FileNotFoundError(f"no feature store at {self.path}")
        df = self.spark.read.parquet(self.features)
        df = df if split == "full" else df.where(F.col("split") == split)
        return df.select(*columns) if columns else df.drop("split")

    def load_codes(self) -> DataFrame:
        if not self.exists() or not readers.exists(self.spark, f"{self._version()}/codes"):
            raise FileNotFoundError(f"no codes at {self.path}")
        return self.spark.read.parquet(f"{self._version()}/codes")

    def load_manifest(self) -> dict:
        return self._manifest()

    def print_manifest(self) -> None:
        for key, value in self.load_manifest().items():
            print(f"{key}: {({g: len(c) for g, c in value.items()}) if key == 'feature_groups' else value if key != 'column_dtypes' else len(value)}")
