"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def md5_draw(*parts) -> Column:
    """Non-negative 32-bit integer from md5 of 'p1:p2:...'; DuckDB computes the
    same number with ``cast('0x'||substr(md5(s),1,8) as bigint)``."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    s = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def unit_draw(*parts) -> Column:
    """Uniform draw in [0, 1) derived from ids (never from partition layout)."""
    return md5_draw(*parts) / F.lit(TWO_POW_32)


def portable_init(id_col: Column, k: int, seed: int, scale: float = 1.0) -> Column:
    """array<double> of k normal values N(0, scale²), a pure function of (id, f, seed):
    Box-Muller on the first two 32-bit words of md5('id:f:seed')."""
    if k <= 0:
        return F.array().cast("array<double>")

    def one(f):
        h = F.md5(F.concat_ws(":", id_col.cast("string"), f.cast("string"), F.lit(str(seed))))
        u = (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") + 1) / F.lit(TWO_POW_32)
        v = F.conv(F.substring(h, 9, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)
        return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2.0) * F.pi() * v) * F.lit(scale)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), one)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def block_of(col: Column | str, n: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
