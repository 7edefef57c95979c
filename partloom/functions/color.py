"""Colour columns: sRGB, linear RGB, CIE Lab, CIEDE2000, OKLab, HSV and labels. All are native expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Linear sRGB to XYZ (D65), and the white point.
XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))
WHITE = (0.95047, 1.0, 1.08883)
#: Linear sRGB to cone responses and these to OKLab (published by its author).
OK_CONES = ((0.4122214708, 0.5363325363, 0.0514459929), (0.2119034982, 0.6806995451, 0.1073969566), (0.0883024619, 0.2817188376, 0.6299787005))
OK_LAB = ((0.2104542553, 0.7936177850, -0.0040720468), (1.9779984951, -2.4285922050, 0.4505937099), (0.0259040371, 0.7827717662, -0.8086757660))


def srgb_to_linear(c: Column) -> Column:
    return F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4)))


def linear_to_srgb(c: Column) -> Column:
    return F.when(c <= 0.0031308, c * 12.92).otherwise(1.055 * F.pow(c, F.lit(1 / 2.4)) - 0.055)


def _times(rows, c):
    return [r[0] * c[0] + r[1] * c[1] + r[2] * c[2] for r in rows]


def lab(r: Column, g: Column, b: Column) -> Column:
    """struct(l, a, b) of sRGB channels from 0 to 1."""
    xyz = [v / w for v, w in zip(_times(XYZ, [srgb_to_linear(c) for c in (r, g, b)]), WHITE, strict=True)]
    f = [F.when(t > (6 / 29) ** 3, F.cbrt(t)).otherwise(t * (29 / 6) ** 2 / 3 + 4 / 29) for t in xyz]
    return F.struct((116 * f[1] - 16).alias("l"), (500 * (f[0] - f[1])).alias("a"), (200 * (f[1] - f[2])).alias("b"))


def oklab(r: Column, g: Column, b: Column) -> Column:
    cones = [F.cbrt(c) for c in _times(OK_CONES, [srgb_to_linear(c) for c in (r, g, b)])]
    light, a, bb = _times(OK_LAB, cones)
    return F.struct(light.alias("l"), a.alias("a"), bb.alias("b"))


def delta_e(x: Column, y: Column) -> Column:
    """Euclidean distance of two Lab structs."""
    return F.sqrt(sum((F.pow(x[c] - y[c], F.lit(2)) for c in ("a", "b")), F.pow(x["l"] - y["l"], F.lit(2))))


def delta_e2000(x: Column, y: Column) -> Column:
    """CIEDE2000 of two Lab structs, as published."""
    c1, c2 = F.hypot(x["a"], x["b"]), F.hypot(y["a"], y["b"])
    mean7 = F.pow((c1 + c2) / 2, F.lit(7))
    g = 0.5 * (1 - F.sqrt(mean7 / (mean7 + 25.0**7)))
    a1, a2 = x["a"] * (1 + g), y["a"] * (1 + g)
    p1, p2 = F.hypot(a1, x["b"]), F.hypot(a2, y["b"])
    turn = lambda b, a: F.when((a == 0) & (b == 0), 0.0).otherwise(F.pmod(F.degrees(F.atan2(b, a)), F.lit(360.0)))
    h1, h2 = turn(x["b"], a1), turn(y["b"], a2)
    grey = p1 * p2 == 0
    dh = F.when(grey, 0.0).when(h2 - h1 > 180, h2 - h1 - 360).when(h2 - h1 < -180, h2 - h1 + 360).otherwise(h2 - h1)
    dl, dc = y["l"] - x["l"], p2 - p1
    dhh = 2 * F.sqrt(p1 * p2) * F.sin(F.radians(dh / 2))
    lm, cm = (x["l"] + y["l"]) / 2, (p1 + p2) / 2
    hm = F.when(grey, h1 + h2).when(F.abs(h1 - h2) <= 180, (h1 + h2) / 2).when(h1 + h2 < 360, (h1 + h2 + 360) / 2).otherwise((h1 + h2 - 360) / 2)
    cosine = lambda k, d: F.cos(F.radians(k * hm + d))
    t = 1 - 0.17 * cosine(1, -30) + 0.24 * cosine(2, 0) + 0.32 * cosine(3, 6) - 0.20 * cosine(4, -63)
    off = F.pow(lm - 50, F.lit(2))
    sl, sc, sh = 1 + 0.015 * off / F.sqrt(20 + off), 1 + 0.045 * cm, 1 + 0.015 * cm * t
    cm7 = F.pow(cm, F.lit(7))
    rt = -F.sin(F.radians(60 * F.exp(-F.pow((hm - 275) / 25, F.lit(2))))) * 2 * F.sqrt(cm7 / (cm7 + 25.0**7))
    return F.sqrt(F.pow(dl / sl, F.lit(2)) + F.pow(dc / sc, F.lit(2)) + F.pow(dhh / sh, F.lit(2)) + rt * (dc / sc) * (dhh / sh))


def hsv(r: Column, g: Column, b: Column) -> Column:
    """struct(h in [0, 1), s, v)."""
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    d = high - low
    h = F.when(d == 0, 0.0).when(high == r, F.pmod((g - b) / d, F.lit(6.0))).when(high == g, (b - r) / d + 2).otherwise((r - g) / d + 4) / 6
    return F.struct(h.alias("h"), F.when(high == 0, 0.0).otherwise(d / high).alias("s"), high.alias("v"))


def colour_label(h: Column, s: Column, v: Column) -> Column:
    """Coarse name of a hue: grey levels first, then six hue sectors."""
    sector = F.pmod(F.floor(h * 6 + 0.5), F.lit(6))
    names = F.array(*map(F.lit, ("red", "yellow", "green", "cyan", "blue", "magenta")))
    return F.when(v < 0.12, "black").when((s < 0.18) & (v > 0.85), "white").when(s < 0.18, "grey").otherwise(F.get(names, sector.cast("int")))


def ok_similarity(x: Column, y: Column) -> Column:
    """Half hue agreement, half closeness of chroma, of two OKLab structs; from 0 to 1."""
    cx, cy = F.hypot(x["a"], x["b"]), F.hypot(y["a"], y["b"])
    hue = F.when((cx < 1e-6) | (cy < 1e-6), 0.5).otherwise((1 + (x["a"] * y["a"] + x["b"] * y["b"]) / (cx * cy)) / 2)
    return 0.5 * hue + 0.5 * F.exp(-F.abs(cx - cy) / 0.1)


def add_colour_features(df: DataFrame, r: str, g: str, b: str) -> DataFrame:
    """Adds lab, oklab and hsv structs and the label, for channels from 0 to 255."""
    c = [F.col(x) / 255.0 for x in (r, g, b)]
    out = df.withColumns({"lab": lab(*c), "oklab": oklab(*c), "hsv": hsv(*c)})
    return out.withColumn("colour", colour_label(F.col("hsv.h"), F.col("hsv.s"), F.col("hsv.v")))


def angle_between(x: list[Column], y: list[Column]) -> Column:
    """Degrees between two directions; null if one has no length."""
    dot = sum((a * b for a, b in zip(x[1:], y[1:], strict=True)), x[0] * y[0])
    norm = F.sqrt(sum((a * a for a in x[1:]), x[0] * x[0])) * F.sqrt(sum((b * b for b in y[1:]), y[0] * y[0]))
    return F.when(norm > 0, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / norm)))))


DEGREES = 180 / math.pi
