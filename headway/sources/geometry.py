"""Region polygons: well-known binary to ring edges."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

EDGE_SCHEMA = "uuid string, ring int, x1 double, y1 double, x2 double, y2 double"

_POLYGON, _MULTIPOLYGON = 3, 6


def _rings(data: bytes) -> Iterator[list[tuple[float, float]]]:
    """Rings of a polygon or multipolygon; extra Z/M ordinates and an SRID are skipped."""
    def geometry(at: int) -> Iterator[tuple[int, list[tuple[float, float]] | None]]:
        order = "<" if data[at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", data, at + 1)
        at += 5
        if code & 0x20000000:
            at += 4
        extra = bool(code & 0x80000000) + bool(code & 0x40000000)
        kind = code & 0x0FFFFFFF
        extra += {0: 0, 1: 1, 2: 1, 3: 2}[kind // 1000]
        kind %= 1000
        (count,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if kind == _POLYGON:
            width = 2 + extra
            for _ in range(count):
                (points,) = struct.unpack_from(order + "I", data, at)
                at += 4
                flat = struct.unpack_from(f"{order}{points * width}d", data, at)
                at += 8 * points * width
                yield at, list(zip(flat[0::width], flat[1::width]))
        elif kind == _MULTIPOLYGON:
            for _ in range(count):
                for at, ring in geometry(at):
                    if ring is not None:
                        yield at, ring
        else:
            raise ValueError(f"geometry type {kind} is not a polygon")
        yield at, None

    for _, ring in geometry(0):
        if ring is not None:
            yield ring


def ring_edges(shapes: DataFrame) -> DataFrame:
    """One row per polygon edge of ``shapes(uuid, wkb_geometry)``."""
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for uuid, wkb in zip(batch["uuid"], batch["wkb_geometry"]):
                for number, ring in enumerate(_rings(bytes(wkb))):
                    rows += [(uuid, number, *a, *b) for a, b in zip(ring, ring[1:])]
            yield pd.DataFrame(rows, columns=["uuid", "ring", "x1", "y1", "x2", "y2"])

    return shapes.select("uuid", "wkb_geometry").mapInPandas(decode, EDGE_SCHEMA)
