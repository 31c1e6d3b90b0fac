"""Bronze: the source text, restricted to the snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions.cleaning import parse_date
from snapmart.operators.rows import at_snapshots
from snapmart.schemas import SNAPSHOT, DatasetSpec


def rejected_rows(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The source rows whose snapshot date cannot be read, as text; bronze has no month for them."""
    return raw.where(parse_date(F.col(SNAPSHOT), spec.date_format).isNull()).select(
        *[F.col(name).cast("string").alias(name) for name in spec.column_names]
    )


def build_bronze(
    raw: DataFrame,
    spec: DatasetSpec,
    snapshots: Sequence[date] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Text columns with the parsed snapshot date, for all snapshots in one pass."""
    parsed = parse_date(F.col(SNAPSHOT), spec.date_format, strict)
    others = [F.col(name).cast("string").alias(name) for name in spec.column_names if name != SNAPSHOT]
    bronze = raw.select(*others, parsed.alias(SNAPSHOT))
    if snapshots is None:
        return bronze.where(F.col(SNAPSHOT).isNotNull())
    return at_snapshots(bronze, snapshots)
