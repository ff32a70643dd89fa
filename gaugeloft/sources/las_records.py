"""Layout of LAS point records, and reading a byte range of a file into Arrow batches."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from gaugeloft.storage import filesystem_of

# Fixed values of the public LAS 1.0-1.4 format: header offsets, record fields, packed bits.
HEADER_BYTES = 375
COMPRESSED_BITS = 0xC0
GPS = [("gps_time", "<f8")]
COLOUR = [("red", "<u2"), ("green", "<u2"), ("blue", "<u2")]
INFRARED = [("nir", "<u2")]
WAVE = [
    ("wavepacket_index", "u1"),
    ("wavepacket_offset", "<u8"),
    ("wavepacket_size", "<u4"),
    ("return_point_wave_location", "<f4"),
    ("x_t", "<f4"),
    ("y_t", "<f4"),
    ("z_t", "<f4"),
]
OLD = [
    ("X", "<i4"),
    ("Y", "<i4"),
    ("Z", "<i4"),
    ("intensity", "<u2"),
    ("_returns", "u1"),
    ("_class", "u1"),
    ("scan_angle_rank", "i1"),
    ("user_data", "u1"),
    ("point_source_id", "<u2"),
]
NEW = [
    ("X", "<i4"),
    ("Y", "<i4"),
    ("Z", "<i4"),
    ("intensity", "<u2"),
    ("_returns", "u1"),
    ("_flags", "u1"),
    ("classification", "u1"),
    ("user_data", "u1"),
    ("scan_angle", "<i2"),
    ("point_source_id", "<u2"),
    ("gps_time", "<f8"),
]
RECORDS = {
    0: OLD,
    1: OLD + GPS,
    2: OLD + COLOUR,
    3: OLD + GPS + COLOUR,
    4: OLD + GPS + WAVE,
    5: OLD + GPS + COLOUR + WAVE,
    6: NEW,
    7: NEW + COLOUR,
    8: NEW + COLOUR + INFRARED,
    9: NEW + WAVE,
    10: NEW + COLOUR + INFRARED + WAVE,
}
# Packed fields: stored byte, shift, mask.
OLD_BITS = {
    "return_number": ("_returns", 0, 7),
    "number_of_returns": ("_returns", 3, 7),
    "scan_direction_flag": ("_returns", 6, 1),
    "edge_of_flight_line": ("_returns", 7, 1),
    "classification": ("_class", 0, 31),
    "synthetic": ("_class", 5, 1),
    "key_point": ("_class", 6, 1),
    "withheld": ("_class", 7, 1),
}
NEW_BITS = {
    "return_number": ("_returns", 0, 15),
    "number_of_returns": ("_returns", 4, 15),
    "synthetic": ("_flags", 0, 1),
    "key_point": ("_flags", 1, 1),
    "withheld": ("_flags", 2, 1),
    "overlap": ("_flags", 3, 1),
    "scanner_channel": ("_flags", 4, 3),
    "scan_direction_flag": ("_flags", 6, 1),
    "edge_of_flight_line": ("_flags", 7, 1),
}
BATCH_POINTS = 65_536

LONG = {"wavepacket_offset", "wavepacket_size"}
FLOAT = {"return_point_wave_location", "x_t", "y_t", "z_t"}
# Spark column names ignore case, so the scaled coordinates cannot be called x, y and z beside X, Y and Z.
SCALED = {"scaled_x": ("X", 0), "scaled_y": ("Y", 1), "scaled_z": ("Z", 2)}
DOUBLE = {"gps_time", *SCALED}


class LasError(ValueError):
    pass


@dataclass(frozen=True)
class Header:
    point_format: int
    record_bytes: int
    data_start: int
    points: int
    declared_points: int
    scale: tuple[float, float, float]
    offset: tuple[float, float, float]

    @property
    def dimensions(self) -> list[str]:
        return dimensions_of(self.point_format)

    @property
    def dtype(self) -> np.dtype:
        fields = RECORDS[self.point_format]
        packed = np.dtype(fields)
        if self.record_bytes < packed.itemsize:
            raise LasError(f"records of {self.record_bytes} bytes are too short for format {self.point_format}")
        # Whatever follows the standard fields in a record is skipped.
        names, kinds = [n for n, _ in fields], [k for _, k in fields]
        places = [packed.fields[n][1] for n in names]
        return np.dtype({"names": names, "formats": kinds, "offsets": places, "itemsize": self.record_bytes})


def dimensions_of(point_format: int) -> list[str]:
    """Dimension names of a point format in record order, packed bytes opened up."""
    bits = OLD_BITS if point_format < 6 else NEW_BITS
    names: list[str] = []
    for stored, _ in RECORDS[point_format]:
        names += [n for n, (byte, _, _) in bits.items() if byte == stored] if stored.startswith("_") else [stored]
    return names


def all_dimensions() -> list[str]:
    return list(dict.fromkeys(n for f in RECORDS for n in dimensions_of(f)))


def arrow_type(name: str) -> pa.DataType:
    if name in DOUBLE:
        return pa.float64()
    if name in FLOAT:
        return pa.float32()
    return pa.int64() if name in LONG else pa.int32()


def parse_header(raw: bytes, size: int) -> Header:
    """The header, with the points it declares and those whose whole records the file really holds."""
    if len(raw) < 227 or raw[:4] != b"LASF":
        raise LasError("not a LAS file")
    minor = raw[25]
    (data_start,) = struct.unpack_from("<I", raw, 96)
    point_format, record_bytes, points = struct.unpack_from("<BHI", raw, 104)
    if point_format & COMPRESSED_BITS:
        raise LasError("compressed (LAZ) point data is not supported")
    if point_format not in RECORDS:
        raise LasError(f"unknown point format {point_format}")
    if minor >= 4 and len(raw) >= 255:
        (points,) = struct.unpack_from("<Q", raw, 247)
    if record_bytes == 0:
        raise LasError("records have no bytes")
    present = max(0, size - data_start) // record_bytes
    return Header(
        point_format,
        record_bytes,
        data_start,
        min(points, present),
        points,
        struct.unpack_from("<ddd", raw, 131),
        struct.unpack_from("<ddd", raw, 155),
    )


def read_header(path: str) -> Header:
    system, local = filesystem_of(path)
    with system.open_input_file(local) as handle:
        return parse_header(handle.read(HEADER_BYTES), handle.size())


def points_or_error(path: str) -> tuple[int, int, str | None]:
    """Points a file holds, points it declares, and what is wrong with it, from header and size alone."""
    try:
        header = read_header(path)
        header.dtype
    except (LasError, OSError, struct.error) as error:
        return 0, 0, str(error)
    short = header.declared_points - header.points
    return header.points, header.declared_points, f"{short} of {header.declared_points} declared points are missing" if short else None


def _column(name: str, data: np.ndarray, header: Header) -> pa.Array:
    if name in SCALED:
        raw, axis = SCALED[name]
        return pa.array(data[raw] * header.scale[axis] + header.offset[axis], pa.float64())
    bits = OLD_BITS if header.point_format < 6 else NEW_BITS
    kind = arrow_type(name)
    if name in data.dtype.names:
        return pa.array(data[name].astype(kind.to_pandas_dtype()), kind)
    if name in bits:
        byte, shift, mask = bits[name]
        return pa.array(((data[byte] >> shift) & mask).astype(np.int32), kind)
    return pa.nulls(len(data), kind)


def _batches(
    path: str, start: int, end: int, columns: list[str], labels: dict[str, str], step: int, aligned: bool, before: int | None = None
) -> Iterator[tuple[int, list[pa.Array]]]:
    """Position of the first point, and the columns, of up to ``step`` points at a time.

    A range covers the points whose first byte lies in ``[start, end)``; ``aligned`` ranges begin
    and end at multiples of ``step``. Neighbouring ranges never share a point or leave one out.
    """
    system, local = filesystem_of(path)
    with system.open_input_file(local) as handle:
        header = parse_header(handle.read(HEADER_BYTES), handle.size())
        dtype = header.dtype

        def first_from(byte: int) -> int:
            ahead = max(0, byte - header.data_start)
            point = -(-ahead // header.record_bytes)
            return min(header.points, -(-point // step) * step if aligned else point)

        at, stop = first_from(start), first_from(end)
        if before is not None:
            stop = min(stop, before)
        while at < stop:
            count = min(step, stop - at)
            handle.seek(header.data_start + at * header.record_bytes)
            data = np.frombuffer(handle.read(count * header.record_bytes), dtype=dtype, count=count)
            arrays = []
            for name in columns:
                if name in labels:
                    arrays.append(pa.repeat(pa.scalar(labels[name], pa.string()), count))
                elif name == "point_index":
                    arrays.append(pa.array(np.arange(at, at + count, dtype=np.int64)))
                elif name == "point_format_id":
                    arrays.append(pa.array(np.full(count, header.point_format, dtype=np.int32)))
                else:
                    arrays.append(_column(name, data, header))
            yield at, arrays
            at += count


def read_range(
    path: str, start: int, end: int, columns: list[str], labels: dict[str, str], before: int | None = None
) -> Iterator[pa.RecordBatch]:
    """One row per point, up to the position ``before``. ``labels`` are text columns with one value per file."""
    for _, arrays in _batches(path, start, end, columns, labels, BATCH_POINTS, False, before):
        yield pa.RecordBatch.from_arrays(arrays, names=columns)


def read_chunks(path: str, start: int, end: int, columns: list[str], labels: dict[str, str], size: int) -> Iterator[pa.RecordBatch]:
    """One row per chunk of ``size`` points: the labels, the chunk number and the points as an array."""
    for at, arrays in _batches(path, start, end, columns, labels, size, True):
        points = pa.StructArray.from_arrays(arrays, names=columns)
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array([v], pa.string()) for v in labels.values()],
                pa.array([at // size], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(points)], pa.int32()), points),
            ],
            names=[*labels, "chunk_number", "points"],
        )
