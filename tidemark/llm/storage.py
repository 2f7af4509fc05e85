"""Files in the shared folder, and compact blobs of numbers inside them."""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs


def write_file(path: str, data: bytes) -> None:
    """All of it or nothing under the final name; a task that runs again replaces it."""
    where, name = fs.FileSystem.from_uri(path)
    own = f"{name}.{uuid.uuid4().hex}"
    where.create_dir(name.rpartition("/")[0], recursive=True)
    with where.open_output_stream(own) as out:
        out.write(data)
    where.move(own, name)


def read_file(path: str) -> pa.Buffer:
    where, name = fs.FileSystem.from_uri(path)
    with where.open_input_file(name) as source:
        return source.read_buffer()


def dump(values: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: equal high bytes cost nothing."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T if len(values) else values
    kind = values.dtype.str.encode().ljust(4)
    return struct.pack("<4sQ", kind, len(values)) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def load(raw: bytes) -> np.ndarray:
    kind, n = struct.unpack_from("<4sQ", raw)
    dtype = np.dtype(kind.decode().strip())
    if not n:
        return np.empty(0, dtype)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(memoryview(raw)[12:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).reshape(n)


def dump_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers by their differences."""
    return dump(np.diff(values, prepend=np.uint64(0)))


def load_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(load(raw), dtype=np.uint64)


def pack(named: dict[str, bytes]) -> bytes:
    """Several blobs in one file."""
    head = struct.pack("<I", len(named))
    for name, blob in named.items():
        head += struct.pack("<16sQ", name.encode(), len(blob))
    return head + b"".join(named.values())


def unpack(raw) -> dict[str, bytes]:
    view = memoryview(raw)
    (n,) = struct.unpack_from("<I", view)
    at, out = 4 + 24 * n, {}
    for k in range(n):
        name, size = struct.unpack_from("<16sQ", view, 4 + 24 * k)
        out[name.rstrip(b"\0").decode()] = bytes(view[at : at + size])
        at += size
    return out


def slices(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(part, begin, end) of ascending 64-bit keys by their top bits; empty parts left out."""
    edges = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.empty(0, np.uint64)
    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    return [(part, a, b) for part, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
