"""Table schemas: explicit types, one row per frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(parts: str) -> T.StructType:
    return T.StructType([T.StructField(p, T.DoubleType()) for p in parts])


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


TEXT, WHOLE, REAL, FLAG = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
VECTOR, ROTATION = _struct("xyz"), _struct("wxyz")

TAKES = _table(take_id=TEXT, pair_id=TEXT, source=TEXT, subject_id=TEXT, sequence_id=TEXT, status=TEXT, frames=WHOLE, reason=TEXT, excluded_by=TEXT)
SMALL_FRAMES = _table(take_id=TEXT, site=TEXT, frame=WHOLE, t_s=REAL, q=ROTATION, a=VECTOR, w=VECTOR, valid=FLAG, confidence=T.FloatType())
LARGE_FRAMES = _table(take_id=TEXT, joint=TEXT, frame=WHOLE, t_s=REAL, q=ROTATION, rate=VECTOR)
ROOT_FRAMES = _table(take_id=TEXT, frame=WHOLE, t_s=REAL, p=VECTOR)
MARKER_FRAMES = _table(take_id=TEXT, marker=TEXT, frame=WHOLE, t_s=REAL, x=REAL, y=REAL, z=REAL)
IMU_FRAMES = _table(take_id=TEXT, sensor=TEXT, frame=WHOLE, t_s=REAL, q=ROTATION)
SEGMENTS = _table(take_id=TEXT, label=TEXT, start_s=REAL, end_s=REAL, velocity=REAL)
POSE_FRAMES = _table(take_id=TEXT, body=TEXT, frame=WHOLE, q=ROTATION, p=VECTOR, residual=REAL, n_visible=WHOLE, status=TEXT)
FINDINGS = _table(level=TEXT, check=TEXT, severity=TEXT, message=TEXT, take_id=TEXT, artifact=TEXT)
LEDGER = _table(take_id=TEXT, artifact_sha=TEXT, generator_sha=TEXT, validator_sha=TEXT, spec_version=TEXT, status=TEXT)

# The frame status vocabulary.
STATUSES = ("OBSERVED", "RECONSTRUCTED", "INTERPOLATED", "UNAVAILABLE")


def usable(status: str | Column) -> Column:
    """P13. A frame that carries a value."""
    return (F.col(status) if isinstance(status, str) else status) != "UNAVAILABLE"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL everywhere: NaN becomes NULL at the scan."""
    reals = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in reals}) if reals else df
