"""Colour columns. All stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# sRGB primaries and the D65 white point, linear light to XYZ.
_XYZ = ((0.412453, 0.357580, 0.180423), (0.212671, 0.715160, 0.072169), (0.019334, 0.119193, 0.950227))
_WHITE = (0.950456, 1.0, 1.088754)


def pack_rgb(r: Column, g: Column, b: Column) -> Column:
    """One integer for a colour: red in the high byte."""
    return F.shiftleft(r.cast("int"), 16) + F.shiftleft(g.cast("int"), 8) + b.cast("int")


def unpack_rgb(code: Column) -> tuple[Column, Column, Column]:
    return F.shiftright(code, 16).bitwiseAND(255), F.shiftright(code, 8).bitwiseAND(255), code.bitwiseAND(255)


def squared_distance(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    total = F.lit(0)
    for x, y in zip(a, b, strict=True):
        total = total + (x - y) * (x - y)
    return total


def lab(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """CIE Lab of 8-bit sRGB: L 0..100, a and b signed."""
    linear = []
    for c in (r, g, b):
        s = c / F.lit(255.0)
        linear.append(F.when(s <= 0.04045, s / 12.92).otherwise(F.pow((s + 0.055) / 1.055, F.lit(2.4))))
    f = []
    for row, white in zip(_XYZ, _WHITE, strict=True):
        t = sum((c * w for c, w in zip(linear, row, strict=True)), F.lit(0.0)) / white
        f.append(F.when(t > 0.008856, F.pow(t, F.lit(1 / 3))).otherwise(7.787 * t + 16.0 / 116.0))
    y = sum((c * w for c, w in zip(linear, _XYZ[1], strict=True)), F.lit(0.0))
    light = F.when(y > 0.008856, 116.0 * f[1] - 16.0).otherwise(903.3 * y)
    return light, 500.0 * (f[0] - f[1]), 200.0 * (f[1] - f[2])


def lab8(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """Lab in the 8-bit scale: L * 255 / 100, a + 128, b + 128, rounded half to even and saturated."""
    light, a, bb = lab(r, g, b)
    clip = lambda v: F.least(F.greatest(F.rint(v), F.lit(0.0)), F.lit(255.0)).cast("int")
    return clip(light * 255.0 / 100.0), clip(a + 128.0), clip(bb + 128.0)


def hsv(r: Column, g: Column, b: Column) -> tuple[Column, Column, Column]:
    """Hue 0..179 (half degrees), saturation and value 0..255."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    span = top - low
    degrees = F.when(span == 0, F.lit(0.0)).when(top == r, 60.0 * (g - b) / span).when(top == g, 120.0 + 60.0 * (b - r) / span).otherwise(240.0 + 60.0 * (r - g) / span)
    hue = F.rint(F.when(degrees < 0, degrees + 360.0).otherwise(degrees) / 2.0)
    return F.when(hue >= 180, hue - 180).otherwise(hue).cast("int"), F.when(top == 0, F.lit(0)).otherwise(F.rint(255.0 * span / top)).cast("int"), top


def signed_warm_hue(hue: Column) -> Column:
    """Hue with the reds above 150 moved below zero, so that warm colours are one interval."""
    return F.when(hue >= 150, hue - 180).otherwise(hue)
