"""Vectors, rotations and quaternions as columns. A vector is struct(x, y, z); a matrix an array of three rows, vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vec(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def xyz(v: Column) -> tuple[Column, Column, Column]:
    return v["x"], v["y"], v["z"]


def each(f, *vs: Column) -> Column:
    return vec(*(f(*c) for c in zip(*map(xyz, vs))))


def add(a: Column, b: Column) -> Column:
    return each(lambda p, q: p + q, a, b)


def sub(a: Column, b: Column) -> Column:
    return each(lambda p, q: p - q, a, b)


def times(a: Column, k: Column | float) -> Column:
    return each(lambda p: p * k, a)


def mid(a: Column, b: Column) -> Column:
    return each(lambda p, q: (p + q) / 2, a, b)


def dot(a: Column, b: Column) -> Column:
    return a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cross(a: Column, b: Column) -> Column:
    return vec(a["y"] * b["z"] - a["z"] * b["y"], a["z"] * b["x"] - a["x"] * b["z"], a["x"] * b["y"] - a["y"] * b["x"])


def distance(a: Column, b: Column) -> Column:
    return norm(sub(a, b))


def let(value: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def unit(v: Column) -> Column:
    """v by its length; null where that is 0."""
    return let(F.struct(v.alias("v"), norm(v).alias("n")), lambda s: each(lambda c: F.try_divide(c, s["n"]), s["v"]))


def zero() -> Column:
    return vec(F.lit(0.0), F.lit(0.0), F.lit(0.0))


def matvec(rows: Column, v: Column) -> Column:
    return vec(dot(rows[0], v), dot(rows[1], v), dot(rows[2], v))


def mean_of(points: Column) -> Column:
    n = F.size(points)
    total = F.aggregate(points, zero(), lambda acc, p: add(acc, p))
    return each(lambda c: F.try_divide(c, n), total)


def has_nan(v: Column) -> Column:
    return F.isnan(v["x"]) | F.isnan(v["y"]) | F.isnan(v["z"])


# --- quaternions: array (w, x, y, z)


def quat_mul(a: Column, b: Column) -> Column:
    w1, x1, y1, z1 = (a[i] for i in range(4))
    w2, x2, y2, z2 = (b[i] for i in range(4))
    return F.array(w1 * w2 - x1 * x2 - y1 * y2 - z1 * z2, w1 * x2 + x1 * w2 + y1 * z2 - z1 * y2, w1 * y2 - x1 * z2 + y1 * w2 + z1 * x2, w1 * z2 + x1 * y2 - y1 * x2 + z1 * w2)


def quat_conj(a: Column) -> Column:
    return F.array(a[0], -a[1], -a[2], -a[3])


def quat_delta(now: Column, after: Column) -> Column:
    """The rotation from now to after."""
    return quat_mul(after, quat_conj(now))


def quat_axis_angle(q: Column) -> Column:
    """The axis times the angle, zero for the identity."""
    w = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q[0]))
    angle = F.acos(w) * 2
    s = F.sqrt(F.greatest(F.lit(0.0), 1 - w * w))
    k = F.when(s < 1e-6, F.lit(0.0)).otherwise(F.try_divide(angle, s))
    return F.array(q[1] * k, q[2] * k, q[3] * k)


def quat_of_matrix(rows: Column) -> Column:
    """Of a rotation matrix; the largest of the four squares is taken for the root."""
    (m00, m01, m02), (m10, m11, m12), (m20, m21, m22) = (xyz(rows[i]) for i in range(3))
    trace = m00 + m11 + m22
    s0 = F.sqrt(F.greatest(trace + 1, F.lit(1e-12))) * 2
    s1 = F.sqrt(F.greatest(m00 - m11 - m22 + 1, F.lit(1e-12))) * 2
    s2 = F.sqrt(F.greatest(m11 - m00 - m22 + 1, F.lit(1e-12))) * 2
    s3 = F.sqrt(F.greatest(m22 - m00 - m11 + 1, F.lit(1e-12))) * 2
    return (
        F.when(trace > 0, F.array(s0 / 4, (m21 - m12) / s0, (m02 - m20) / s0, (m10 - m01) / s0))
        .when((m00 > m11) & (m00 > m22), F.array((m21 - m12) / s1, s1 / 4, (m01 + m10) / s1, (m02 + m20) / s1))
        .when(m11 > m22, F.array((m02 - m20) / s2, (m01 + m10) / s2, s2 / 4, (m12 + m21) / s2))
        .otherwise(F.array((m10 - m01) / s3, (m02 + m20) / s3, (m12 + m21) / s3, s3 / 4))
    )


def look_rotation(direction: Column) -> Column:
    """The quaternion whose x axis is the direction, upright where it can be; the identity for a zero direction."""
    up = lambda x: F.when(F.abs(x["y"]) > 0.99, vec(F.lit(0.0), F.lit(0.0), F.lit(1.0))).otherwise(vec(F.lit(0.0), F.lit(1.0), F.lit(0.0)))

    def turned(x: Column) -> Column:
        xz = let(unit(cross(x, up(x))), lambda z: F.struct(z.alias("z"), cross(z, x).alias("y")))
        rows = lambda q: F.array(*(vec(x[k], q["y"][k], q["z"][k]) for k in "xyz"))
        return let(xz, lambda q: let(rows(q), quat_of_matrix))

    return F.when(norm(direction) < 1e-6, F.array(*map(F.lit, (1.0, 0.0, 0.0, 0.0)))).otherwise(let(unit(direction), turned))


def euler_matrix(yaw: Column, pitch: Column, roll: Column) -> Column:
    """Rows of Rz(roll) Rx(pitch) Ry(yaw), in degrees: rotations about the fixed axes y, x, z in turn."""
    (sa, ca), (sb, cb), (sc, cc) = ((F.sin(F.radians(a)), F.cos(F.radians(a))) for a in (yaw, pitch, roll))
    return F.array(
        vec(cc * ca - sc * sb * sa, -sc * cb, cc * sa + sc * sb * ca),
        vec(sc * ca + cc * sb * sa, cc * cb, sc * sa - cc * sb * ca),
        vec(-cb * sa, sb, cb * ca),
    )
