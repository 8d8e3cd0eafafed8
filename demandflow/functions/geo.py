"""Geohash expressions (G1, G3-G5) and the centre distance.

G1 is a native column expression: each base-32 character contributes five
bits, interleaved longitude-first. A character at an even position gives its
bits 4,2,0 to longitude and 3,1 to latitude; at an odd position the roles
swap. Folding those bit groups into a corner and a size gives the cell, and the
cell centre follows. No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the geohash base-32 alphabet.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bit(code: Column, pos: int) -> Column:
    return F.shiftright(code, pos).bitwiseAND(1)


def _three(code: Column) -> Column:
    """Bits 4, 2, 0 of a 5-bit code as a 3-bit number."""
    return _bit(code, 4) * 4 + _bit(code, 2) * 2 + _bit(code, 0)


def _two(code: Column) -> Column:
    """Bits 3, 1 of a 5-bit code as a 2-bit number."""
    return _bit(code, 3) * 2 + _bit(code, 1)


def decode_geohash(gh: str | Column = "geohash") -> tuple[Column, Column]:
    """G1: (latitude, longitude) of the cell centre; '' -> (0, 0); null -> null; codes of any length.

    Characters become 0..31 codes (unknown ones 0); one ``aggregate`` over them
    folds them into the cell's corner and size as shares of the axes, exact in
    doubles while they have the bits and converging beyond. The expression has
    constant size whatever the code length, and a row's text is split once.
    """
    s = _c(gh)
    chars = F.slice(F.split(s, ""), 1, F.length(s))
    start = F.struct(*[F.lit(v).alias(k) for k, v in (("lo", 0.0), ("la", 0.0), ("lo_size", 1.0), ("la_size", 1.0), ("even", True))])

    def step(acc: Column, ch: Column) -> Column:
        c = F.greatest(F.instr(F.lit(BASE32), ch) - 1, F.lit(0)).cast("long")
        even = acc["even"]
        lo_size, la_size = acc["lo_size"] / F.when(even, 8).otherwise(4), acc["la_size"] / F.when(even, 4).otherwise(8)
        return F.struct(
            (acc["lo"] + F.when(even, _three(c)).otherwise(_two(c)) * lo_size).alias("lo"),
            (acc["la"] + F.when(even, _two(c)).otherwise(_three(c)) * la_size).alias("la"),
            lo_size.alias("lo_size"), la_size.alias("la_size"), (~even).alias("even"))

    cell = F.aggregate(chars, start, step, lambda idx: F.struct(
        ((idx["la"] + 0.5 * idx["la_size"]) * 180.0 - 90.0).alias("lat"), ((idx["lo"] + 0.5 * idx["lo_size"]) * 360.0 - 180.0).alias("lon")))
    return cell["lat"], cell["lon"]


def geohash_prefix(gh: str | Column, n: int) -> Column:
    """First n characters."""
    return F.substring(_c(gh), 1, n)


def geohash_length(gh: str | Column = "geohash") -> Column:
    """G5."""
    return F.length(_c(gh))


def geohash_table(frames: list[DataFrame], gh: str = "geohash") -> DataFrame:
    """(geohash, latitude, longitude) for each distinct code of the frames."""
    codes = frames[0].select(gh)
    for f in frames[1:]:
        codes = codes.union(f.select(gh))
    lat, lon = decode_geohash(gh)
    return codes.distinct().select(gh, lat.alias("latitude"), lon.alias("longitude"))


def with_geo_columns(df: DataFrame, gh: str = "geohash", decoded: DataFrame | None = None) -> DataFrame:
    """G1 (per row) or G2 (``decoded`` lookup from ``geohash_table``) plus G3 prefixes."""
    if decoded is None:
        lat, lon = decode_geohash(gh)
    else:
        df = df.join(decoded.withColumnRenamed("latitude", "_lat").withColumnRenamed("longitude", "_lon"),
                     gh, "left")
        lat, lon = F.col("_lat"), F.col("_lon")
    out = df.withColumns({
        "latitude": lat, "longitude": lon,
        "geohash_4": geohash_prefix(gh, 4), "geohash_5": geohash_prefix(gh, 5),
    })
    return out if decoded is None else out.drop("_lat", "_lon")


def dist_to_center(center_lat: float, center_lon: float,
                   lat: str = "latitude", lon: str = "longitude") -> Column:
    """Euclidean distance in degrees to a centre fixed from history."""
    return F.sqrt(F.pow(F.col(lat) - F.lit(center_lat), 2) + F.pow(F.col(lon) - F.lit(center_lon), 2))
