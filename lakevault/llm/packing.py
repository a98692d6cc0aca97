"""Whole numbers as variable-length bytes, seven bits a byte, for rows that get shuffled."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values) -> bytes:
    """Non-negative numbers below 2**35, small ones in one byte."""
    return _packed(np.asarray(values, dtype=np.uint64))[0].tobytes()


def pack_parts(values, ends) -> list[bytes]:
    """As many packed lists as there are ends: where each list ends among the values."""
    data, at = _packed(np.asarray(values, dtype=np.uint64))
    data, at = data.tobytes(), np.concatenate(([0], at))[np.concatenate(([0], ends)).astype(int)]
    return [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def unpack_parts(parts: list[bytes]) -> list[np.ndarray]:
    data = b"".join(parts)
    values = unpack(data)
    size = np.cumsum(np.frombuffer(data, np.uint8) < 128)
    ends = np.cumsum([len(p) for p in parts])
    at = np.concatenate(([0], size))[ends]
    return np.split(values, at[:-1])


def _packed(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes, and where each number's bytes end."""
    if not len(v):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    size = 1 + sum((v >= np.uint64(1 << s)).astype(np.int64) for s in (7, 14, 21, 28))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]), dtype=np.uint8)
    at = ends - size
    for k in range(int(size.max())):
        some = size > k
        more = (size[some] > k + 1).astype(np.uint64) << np.uint64(7)
        out[at[some] + k] = ((v[some] >> np.uint64(7 * k)) & np.uint64(127)) | more
    return out, ends


def unpack(data: bytes | None) -> np.ndarray:
    raw = np.frombuffer(data or b"", dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate(([0], last[:-1] + 1))
    size = last - first + 1
    out = np.zeros(len(last), dtype=np.int64)
    for k in range(int(size.max())):
        some = size > k
        out[some] |= (raw[first[some] + k].astype(np.int64) & 127) << (7 * k)
    return out


def slices(blob: bytes, lengths: np.ndarray) -> list[bytes]:
    """The parts of a blob that have these lengths, in order."""
    ends = np.cumsum(lengths)
    return [blob[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)
