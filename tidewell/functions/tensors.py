"""Packed half-precision tensors and vector arithmetic."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Channel means and deviations of the usual image normalisation.
PIXEL_MEAN, PIXEL_STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
REGISTERS = 4


def _packed(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else np.asarray(v, "<f2").tobytes())


def _unpacked(packed: pd.Series) -> pd.Series:
    return packed.map(lambda b: None if b is None else np.frombuffer(b, "<f2").astype(np.float32))


def pack_half(values: Column | str) -> Column:
    """array<float> as little-endian half-precision bytes."""
    return F.pandas_udf(_packed, T.BinaryType())(values)


def unpack_half(packed: Column | str) -> Column:
    return F.pandas_udf(_unpacked, T.ArrayType(T.FloatType()))(packed)


def packed_fits(packed: Column, shape: Column) -> Column:
    """Whether the bytes are two for each cell of the shape."""
    return F.length(packed) == 2 * F.aggregate(shape, F.lit(1), lambda n, s: n * s)


def token_grid(tokens: Column, height: int, width: int) -> Column:
    """Splits a row of tokens: the first one, REGISTERS that are dropped if there are so many, then height x width in rows.

    An error if the number of tokens fits neither way.
    """
    cells = height * width
    start = F.when(F.size(tokens) == 1 + REGISTERS + cells, 2 + REGISTERS).when(F.size(tokens) == 1 + cells, 2)
    rest = F.slice(tokens, F.coalesce(start, F.raise_error(F.concat(F.lit("tokens don't fit the grid: "), F.size(tokens))).cast("int")), F.lit(cells))
    rows = F.transform(F.sequence(F.lit(0), F.lit(height - 1)), lambda r: F.slice(rest, r * width + 1, F.lit(width)))
    return F.struct(F.element_at(tokens, 1).alias("cls"), rows.alias("patches"))


def sigmoid(c: Column) -> Column:
    return 1 / (1 + F.exp(-c))


def label_probabilities(logits: Column) -> Column:
    """Of two logits the first is fruiting, the second flowering."""
    return F.struct(sigmoid(F.element_at(logits, 2)).alias("flowering"), sigmoid(F.element_at(logits, 1)).alias("fruiting"))


def pixels_normalised(channels: Column) -> Column:
    """(x / 255 - mean) / deviation for the three channels of a pixel."""
    mean, std = F.array(*map(F.lit, PIXEL_MEAN)), F.array(*map(F.lit, PIXEL_STD))
    return F.zip_with(F.zip_with(channels, mean, lambda x, m: x / 255 - m), std, lambda x, s: x / s)


def to_byte(value: Column, low: Column, high: Column) -> Column:
    """Where a value stands between low and high, as 0 to 255; 0 if these are equal."""
    share = (value - low) / (high - low)
    scaled = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * 255).cast("int")
    return F.when(high > low, scaled).otherwise(F.lit(0))
