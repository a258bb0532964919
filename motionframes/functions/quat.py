"""Quaternion, vector and matrix algebra as Column expressions.

A rotation is ``struct<w,x,y,z>``, a vector ``struct<x,y,z>``, a matrix ``struct<m00..m22>``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TINY = 1e-12


def quat(w, x, y, z) -> Column:
    return F.struct(w.alias("w"), x.alias("x"), y.alias("y"), z.alias("z"))


def vec(x, y, z) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def hold(value: Column, present: Column) -> Column:
    """Keep a struct as one computed column where ``present`` holds.

    The optimizer copies a bare struct into every later use of its fields, which multiplies long
    expressions; a conditional one is computed once.
    """
    return F.when(present, value)


def qdot(a: Column, b: Column) -> Column:
    return a["w"] * b["w"] + a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def scale_quat(q: Column, s: Column) -> Column:
    return quat(q["w"] * s, q["x"] * s, q["y"] * s, q["z"] * s)


def normalise(q: Column) -> Column:
    """F1. Unit quaternion; null for zero length."""
    n = F.sqrt(qdot(q, q))
    return F.when(n > 0, scale_quat(q, 1.0 / n))


def conjugate(q: Column) -> Column:
    """F1."""
    return quat(q["w"], -q["x"], -q["y"], -q["z"])


def multiply(a: Column, b: Column) -> Column:
    """F1. Hamilton product ``a * b``."""
    return quat(
        a["w"] * b["w"] - a["x"] * b["x"] - a["y"] * b["y"] - a["z"] * b["z"],
        a["w"] * b["x"] + a["x"] * b["w"] + a["y"] * b["z"] - a["z"] * b["y"],
        a["w"] * b["y"] - a["x"] * b["z"] + a["y"] * b["w"] + a["z"] * b["x"],
        a["w"] * b["z"] + a["x"] * b["y"] - a["y"] * b["x"] + a["z"] * b["w"],
    )


def log_unit(q: Column) -> Column:
    """F2. Half the rotation vector."""
    n = norm(q)
    s = F.when(n > TINY, F.atan2(n, clip(q["w"], -1.0, 1.0)) / n).otherwise(F.lit(0.0))
    return vec(q["x"] * s, q["y"] * s, q["z"] * s)


def exp_pure(v: Column) -> Column:
    """F2. Inverse of ``log_unit``."""
    a = norm(v)
    s = F.when(a > TINY, F.sin(a) / a).otherwise(F.lit(1.0))
    return quat(F.cos(a), v["x"] * s, v["y"] * s, v["z"] * s)


def shorter_arc(q: Column) -> Column:
    """F3. The representative with a non-negative scalar part."""
    return scale_quat(q, F.when(q["w"] < 0, F.lit(-1.0)).otherwise(F.lit(1.0)))


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def norm(v: Column) -> Column:
    return F.sqrt(v["x"] * v["x"] + v["y"] * v["y"] + v["z"] * v["z"])


def cross(a: Column, b: Column) -> Column:
    return vec(
        a["y"] * b["z"] - a["z"] * b["y"],
        a["z"] * b["x"] - a["x"] * b["z"],
        a["x"] * b["y"] - a["y"] * b["x"],
    )


def add(a: Column, b: Column) -> Column:
    return vec(a["x"] + b["x"], a["y"] + b["y"], a["z"] + b["z"])


def sub(a: Column, b: Column) -> Column:
    return vec(a["x"] - b["x"], a["y"] - b["y"], a["z"] - b["z"])


def scale(v: Column, s: Column) -> Column:
    return vec(v["x"] * s, v["y"] * s, v["z"] * s)


def unit(v: Column) -> Column:
    """Unit vector; null for zero length."""
    n = norm(v)
    return F.when(n > 0, scale(v, 1.0 / n))


def to_matrix(q: Column) -> Column:
    """F7. Rotation matrix of a unit quaternion."""
    w, x, y, z = (q[c] for c in "wxyz")
    cells = [
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    ]
    return F.struct(*[c.alias(f"m{i // 3}{i % 3}") for i, c in enumerate(cells)])


def with_quaternion(df: DataFrame, out: str, matrix: str) -> DataFrame:
    """F7. Unit quaternion of a rotation matrix: largest of the four divisors, scalar part >= 0."""
    m = F.col(matrix)
    a, b, c = m["m00"], m["m11"], m["m22"]
    d32, d13, d21 = m["m21"] - m["m12"], m["m02"] - m["m20"], m["m10"] - m["m01"]
    s21, s31, s32 = m["m10"] + m["m01"], m["m02"] + m["m20"], m["m21"] + m["m12"]
    sums = {"_sw": 1 + a + b + c, "_sx": 1 + a - b - c, "_sy": 1 - a + b - c, "_sz": 1 - a - b + c}
    df = df.withColumns({n: 2.0 * F.sqrt(F.greatest(F.lit(0.0), t)) for n, t in sums.items()})
    sw, sx, sy, sz = (F.col(n) for n in sums)
    best = F.greatest(sw, sx, sy, sz)
    q = (
        F.when(m["m00"].isNull(), None)
        .when(sw == best, quat(sw / 4, d32 / sw, d13 / sw, d21 / sw))
        .when(sx == best, quat(d32 / sx, sx / 4, s21 / sx, s31 / sx))
        .when(sy == best, quat(d13 / sy, s21 / sy, sy / 4, s32 / sy))
        .otherwise(quat(d21 / sz, s31 / sz, s32 / sz, sz / 4))
    )
    df = df.withColumn("_q", q)
    return df.withColumn(out, hold(shorter_arc(F.col("_q")), F.col("_q").isNotNull())).drop("_q", *sums)


def apply_matrix(m: Column, v: Column) -> Column:
    return vec(
        m["m00"] * v["x"] + m["m01"] * v["y"] + m["m02"] * v["z"],
        m["m10"] * v["x"] + m["m11"] * v["y"] + m["m12"] * v["z"],
        m["m20"] * v["x"] + m["m21"] * v["y"] + m["m22"] * v["z"],
    )


def rotate(q: Column, v: Column) -> Column:
    """F4. Rotate ``v`` by the unit quaternion ``q``."""
    return apply_matrix(to_matrix(q), v)


def counter_rotate(q: Column, v: Column) -> Column:
    """F4."""
    return rotate(conjugate(q), v)


def specific_force(acceleration: Column, q: Column, gravity: Column) -> Column:
    """F4. Acceleration minus gravity, seen in the rotated frame."""
    return counter_rotate(q, sub(acceleration, gravity))


def with_slerp(df: DataFrame, paths: dict[str, tuple[str, str]], t: str) -> DataFrame:
    """F5 for several columns at once: adds ``name = slerp(a, b, t)`` in steps, so that the angle,
    the weights and the length of each are computed once per row."""
    at = F.col(t)
    pairs = {n: (F.col(a), F.col(b)) for n, (a, b) in paths.items()}
    df = df.withColumns({f"_{n}_d": qdot(a, b) for n, (a, b) in pairs.items()})
    df = df.withColumns({f"_{n}_th": F.acos(clip(F.abs(F.col(f"_{n}_d")), -1.0, 1.0)) for n in pairs})
    weights = {}
    for n in pairs:
        d, theta = F.col(f"_{n}_d"), F.col(f"_{n}_th")
        close = F.abs(d) > 1.0 - 1e-9
        sign = F.when(d < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
        weights[f"_{n}_a"] = F.when(close, 1.0 - at).otherwise(F.sin((1.0 - at) * theta) / F.sin(theta))
        weights[f"_{n}_b"] = sign * F.when(close, at).otherwise(F.sin(at * theta) / F.sin(theta))
    df = df.withColumns(weights)
    df = df.withColumns(
        {
            f"_{n}_{c}": F.col(f"_{n}_a") * a[c] + F.col(f"_{n}_b") * b[c]
            for n, (a, b) in pairs.items()
            for c in "wxyz"
        }
    )
    parts = {n: [F.col(f"_{n}_{c}") for c in "wxyz"] for n in pairs}
    df = df.withColumns({f"_{n}_n": F.sqrt(sum((p * p for p in ps[1:]), ps[0] * ps[0])) for n, ps in parts.items()})
    df = df.withColumns(
        {n: F.when(F.col(f"_{n}_n") > 0, quat(*[p / F.col(f"_{n}_n") for p in ps])) for n, ps in parts.items()}
    )
    return df.drop(*[f"_{n}_{s}" for n in pairs for s in ("d", "th", "a", "b", "w", "x", "y", "z", "n")])


def angle_deg(a: Column, b: Column) -> Column:
    """F6. Geodesic angle between two unit quaternions, degrees."""
    return F.degrees(2.0 * F.acos(clip(F.abs(qdot(a, b)), 0.0, 1.0)))


def trace_product(a: Column, b: Column) -> Column:
    """Trace of ``a^T b``, without forming the product."""
    terms = [a[f"m{i}{j}"] * b[f"m{i}{j}"] for i in range(3) for j in range(3)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def matrix_angle_deg(a: Column, b: Column) -> Column:
    """F6. Geodesic angle between two rotation matrices, degrees."""
    return F.degrees(F.acos(clip((trace_product(a, b) - 1.0) / 2.0, -1.0, 1.0)))


def heading(m: Column) -> Column:
    """F8. Azimuth of the first axis, radians."""
    return F.atan2(m["m10"], m["m00"])


def vertical_twist(q: Column) -> Column:
    """F8. Rotation about the vertical that best matches ``q``, radians."""
    m = to_matrix(q)
    return F.atan2(m["m10"] - m["m01"], m["m00"] + m["m11"])


def rotation_z(angle: Column) -> Column:
    """F8."""
    return quat(F.cos(angle / 2), F.lit(0.0), F.lit(0.0), F.sin(angle / 2))


def twist_y_deg(q: Column) -> Column:
    """Unsigned twist about the local y axis, degrees."""
    return F.degrees(2.0 * F.atan2(F.abs(q["y"]), F.abs(q["w"])))


def with_frame_from_axes(df: DataFrame, out: str, primary: str, secondary: str) -> DataFrame:
    """F9. Right-handed orthonormal frame as a matrix with columns x, y, z: y along ``primary``, x along
    the part of ``secondary`` across it, z = x cross y. Null when the two are parallel."""
    y, x = F.col("_y"), F.col("_x")
    across = sub(F.col(secondary), scale(y, dot(F.col(secondary), y)))
    df = df.withColumn("_y", unit(F.col(primary)))
    df = df.withColumn("_a", hold(across, y.isNotNull()))
    df = df.withColumn("_x", unit(F.col("_a")))
    df = df.withColumn("_z", hold(cross(x, y), x.isNotNull()))
    cells = [
        F.col(axis)[c].alias(f"m{i}{j}") for i, c in enumerate("xyz") for j, axis in enumerate(("_x", "_y", "_z"))
    ]
    return df.withColumn(out, hold(F.struct(*cells), x.isNotNull())).drop("_x", "_y", "_z", "_a")


def with_shortest_to_axis(df: DataFrame, out: str, v: str, axis: tuple[float, float, float]) -> DataFrame:
    """F10. Smallest rotation taking the direction of ``v`` onto a fixed unit axis.

    Opposite directions turn by half a circle about a fixed perpendicular axis.
    """
    ax, ay, az = (float(c) for c in axis)
    other = (0.0, 1.0, 0.0) if abs(ay) < 0.9 else (1.0, 0.0, 0.0)
    p = (ay * other[2] - az * other[1], az * other[0] - ax * other[2], ax * other[1] - ay * other[0])
    length = math.sqrt(sum(q * q for q in p))
    turn = quat(F.lit(0.0), *[F.lit(q / length) for q in p])
    u = F.col("_u")
    df = df.withColumn("_u", unit(F.col(v)))
    df = df.withColumn("_c", u["x"] * ax + u["y"] * ay + u["z"] * az)
    k = cross(u, vec(F.lit(ax), F.lit(ay), F.lit(az)))
    df = df.withColumn("_k", hold(quat(1.0 + F.col("_c"), k["x"], k["y"], k["z"]), u.isNotNull()))
    df = df.withColumn("_n", F.sqrt(qdot(F.col("_k"), F.col("_k"))))
    usual = hold(scale_quat(F.col("_k"), 1.0 / F.col("_n")), F.col("_n") > 0)
    opposite = F.col("_c") < -1.0 + TINY
    return df.withColumn(out, F.when(opposite, turn).otherwise(usual)).drop("_u", "_c", "_k", "_n")


def components(v: Column, first: Column, third: Column, threshold: float) -> Column:
    """F12. Components of ``v`` on ``first``, on the unit of ``third`` x ``first``, and on ``third``.

    The middle one is null where the two axes are nearly parallel.
    """
    middle = cross(third, first)
    n = norm(middle)
    return vec(dot(v, first), F.when(n > threshold, dot(v, middle) / n), dot(v, third))


def to_local(q: Column, origin: Column, point: Column) -> Column:
    """F13. A point in the coordinates of the pose (q, origin)."""
    return counter_rotate(q, sub(point, origin))


def to_world(q: Column, origin: Column, point: Column) -> Column:
    """F13."""
    return add(rotate(q, point), origin)
