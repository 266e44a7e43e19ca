"""Coordinates and map cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed value: the geohash alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def inverted_location(ll: Column | str) -> Column:
    """``[lat, lon]`` as ``[lon, lat]``; NULL when there are no two coordinates."""
    ll = F.col(ll) if isinstance(ll, str) else ll
    return F.when(F.size(ll) >= 2, F.array(F.get(ll, 1), F.get(ll, 0)))


def _bits(precision: int) -> tuple[int, int]:
    """Bits of longitude and latitude in a geohash; longitude takes the odd one."""
    return (5 * precision + 1) // 2, 5 * precision // 2


def _grid(degrees: Column, half_turn: int, bits: int) -> Column:
    cells = 1 << bits
    at = F.floor((degrees + half_turn) / (2 * half_turn) * cells)
    return F.when(at < 0, 0).when(at >= cells, cells - 1).otherwise(at).cast("bigint")


def geo_cell(lat: Column, lon: Column, precision: int) -> tuple[Column, Column]:
    """Row and column numbers of the geohash cell: two integers, cheap to group by."""
    lon_bits, lat_bits = _bits(precision)
    return _grid(lat, 90, lat_bits), _grid(lon, 180, lon_bits)


def coarser_cell(row: Column, column: Column, precision: int, coarse: int) -> tuple[Column, Column]:
    """The numbers of the ``coarse`` cell around a cell: halving the grid drops a bit."""
    (lon_bits, lat_bits), (fewer_lon, fewer_lat) = _bits(precision), _bits(coarse)
    return F.shiftright(row, lat_bits - fewer_lat), F.shiftright(column, lon_bits - fewer_lon)


def geohash_of_cell(row: Column, column: Column, precision: int) -> Column:
    """Text of the cell: bits alternate, longitude first, five to a character."""
    lon_bits, lat_bits = _bits(precision)

    def bit(position: int) -> Column:
        axis, bits = (column, lon_bits) if position % 2 == 0 else (row, lat_bits)
        moved = F.shiftright(axis, bits - 1 - position // 2).bitwiseAND(F.lit(1))
        return F.shiftleft(moved, 4 - position % 5)

    def character(start: int) -> Column:
        index = reduce(lambda a, b: a + b, [bit(start + j) for j in range(5)])
        return F.substring(F.lit(GEOHASH_ALPHABET), (index + 1).cast("int"), F.lit(1))

    return F.concat(*[character(5 * i) for i in range(precision)])


def geohash(lat: Column, lon: Column, precision: int = 7) -> Column:
    return geohash_of_cell(*geo_cell(lat, lon, precision), precision)
