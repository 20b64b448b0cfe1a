"""Scalar column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_uniform(*parts: Column) -> Column:
    """A uniform number in [0, 1) from the md5 of the parts joined by ':'."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(2**32))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def clamp01(x: Column, digits: int = 3) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)), digits)


def choose(col: Column, mapping: Mapping[str, object], default: object) -> Column:
    """Value of a small literal mapping, `default` for anything else."""
    out = None
    for key, value in mapping.items():
        out = (F if out is None else out).when(col == key, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def safe_ratio(num: Column, den: Column, digits: int) -> Column:
    """Rounded ratio, 0 where the divisor is not positive."""
    return F.when(den > 0, F.round(num / den, digits)).otherwise(F.lit(0.0))


def value_block(x: Column, per_octave: int = 64) -> Column:
    """Order-preserving block of any number: `per_octave` blocks per doubling of magnitude."""
    size = F.floor(F.log2(F.lit(1.0) + F.abs(x.cast("double"))) * per_octave)
    return F.coalesce((F.signum(x.cast("double")) * size).cast("long"), F.lit(0))


def unit_block(p: Column, blocks: int = 1024) -> Column:
    """Order-preserving block of a number in [0, 1]."""
    return F.coalesce(F.floor(p * blocks).cast("long"), F.lit(0))
