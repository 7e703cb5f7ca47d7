"""Quaternions and vectors as tuples of columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

Quaternion = tuple[Column, Column, Column, Column]
Vector = tuple[Column, Column, Column]


def quaternion(c: Column, order: str = "wxyz") -> Quaternion:
    """(w, x, y, z) of an array column in the given order."""
    return tuple(c[order.index(k)] for k in "wxyz")


def quaternion_norm(q: Quaternion) -> Column:
    w, x, y, z = q
    return F.sqrt(w * w + x * x + y * y + z * z)


def invalid_quaternion(q: Quaternion, least: float = 0.1) -> Column:
    """Null, NaN, infinite or a norm under ``least``."""
    n = quaternion_norm(q)
    return n.isNull() | F.isnan(n) | (n == float("inf")) | (n < least)


def unit(q: Quaternion) -> Quaternion:
    n = quaternion_norm(q)
    return tuple(F.when(n > 0, c / n) for c in q)


def rotation_column(q: Quaternion, axis: int) -> Vector:
    """Image of a unit axis (0 x, 1 y, 2 z) under a unit quaternion."""
    w, x, y, z = q
    columns = (
        (1 - 2 * (y * y + z * z), 2 * (x * y + w * z), 2 * (x * z - w * y)),
        (2 * (x * y - w * z), 1 - 2 * (x * x + z * z), 2 * (y * z + w * x)),
        (2 * (x * z + w * y), 2 * (y * z - w * x), 1 - 2 * (x * x + y * y)),
    )
    return columns[axis]


def rotate(q: Quaternion, v: Vector) -> Vector:
    cols = [rotation_column(q, k) for k in range(3)]
    return tuple(cols[0][i] * v[0] + cols[1][i] * v[1] + cols[2][i] * v[2] for i in range(3))


def dot(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    total = a[0] * b[0]
    for x, y in zip(a[1:], b[1:], strict=True):
        total = total + x * y
    return total


def distance(a: Vector, b: Vector) -> Column:
    return F.sqrt(dot(tuple(x - y for x, y in zip(a, b, strict=True)), tuple(x - y for x, y in zip(a, b, strict=True))))


def slerp(p: Column, q: Column, t: Column) -> Column:
    """array<double>: spherical interpolation of two quaternion arrays along the shorter arc; nearly equal ones linearly.

    Higher-order functions keep the arrays as they are, so the expression stays small."""
    unit_of = lambda a: F.transform(a, lambda x: x / F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, y: s + y * y)))
    cosine = F.aggregate(F.zip_with(unit_of(p), unit_of(q), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    s = F.struct(unit_of(p).alias("p"), F.transform(unit_of(q), lambda x: F.when(cosine < 0, -x).otherwise(x)).alias("q"), F.least(F.abs(cosine), F.lit(1.0)).alias("c"), t.alias("t"))

    def mixed(v: Column) -> Column:
        theta = F.acos(v["c"])
        wide = v["c"] <= 0.9995
        a = F.when(wide, F.sin((1 - v["t"]) * theta) / F.sin(theta)).otherwise(1 - v["t"])
        b = F.when(wide, F.sin(v["t"] * theta) / F.sin(theta)).otherwise(v["t"])
        return F.zip_with(v["p"], v["q"], lambda x, y: a * x + b * y)

    raw = F.transform(F.array(s), mixed)[0]
    return F.transform(F.array(raw), unit_of)[0]
