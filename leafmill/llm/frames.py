"""The record file format: length-delimited frames with masked CRC-32C checksums.

frame   := u64 length | u32 masked CRC of the length bytes | payload | u32 masked CRC of the payload | newline
payload := i64 doc_id | u8 flags (1: doc_id is null) | u8 width | ids, each width bytes
All integers are little-endian. The newline ends a frame so that Spark's own text sink, with its commit protocol, can
write the files on any store; readers go by the lengths, never by the newline.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

HEAD, TAIL, BODY = 12, 5, 10
_BLOCK = 512


def _tables() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1).astype(np.uint32)
    out = [table]
    for _ in range(3):
        out.append(table[out[-1] & 255] ^ (out[-1] >> 8))
    return np.stack(out)


_T = _tables()


def _step(state: np.ndarray, word: np.ndarray | int) -> np.ndarray:
    x = state ^ word
    return _T[3][x & 255] ^ _T[2][(x >> 8) & 255] ^ _T[1][(x >> 16) & 255] ^ _T[0][x >> 24]


def _shift_tables() -> np.ndarray:
    """State after a block of zero bytes, for each value of each byte of the state."""
    state = np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])
    for _ in range(_BLOCK // 4):
        state = _step(state, np.uint32(0))
    return state.reshape(4, 256)


_S = _shift_tables()


def crc32c(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32C of data[start:end] per span (each of 4 bytes or more), all spans at once.

    Spans are padded in front to whole blocks, which a zero state does not notice; blocks are run side by side and
    then chained by the linear map of one block of zeros.
    """
    if not len(starts):
        return np.zeros(0, np.uint32)
    sizes = ends - starts
    blocks = -(-sizes // _BLOCK)
    first = np.cumsum(blocks) - blocks
    begin = (first + blocks) * _BLOCK - sizes
    padded = np.zeros(int(blocks.sum()) * _BLOCK, np.uint8)
    for a, b, to in zip(starts.tolist(), ends.tolist(), begin.tolist(), strict=True):
        padded[to : to + b - a] = data[a:b]
    for i in range(4):
        padded[begin + i] ^= 255
    words = np.ascontiguousarray(padded.view("<u4").reshape(-1, _BLOCK // 4).T)
    state = np.zeros(words.shape[1], np.uint32)
    for row in words:
        state = _step(state, row)
    out = state[first]
    for k in range(1, int(blocks.max())):
        at = np.flatnonzero(blocks > k)
        x = out[at]
        shifted = _S[0][x & 255] ^ _S[1][(x >> 8) & 255] ^ _S[2][(x >> 16) & 255] ^ _S[3][x >> 24]
        out[at] = shifted ^ state[first[at] + k]
    return ~out


def masked(crc: np.ndarray) -> np.ndarray:
    """The checksum as it is stored: rotated and offset, so that checksums of checksums stay sound."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    out[at[:, None] + np.arange(raw.shape[1])] = raw


def encode(doc_ids: np.ndarray, nulls: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> pa.BinaryArray:
    """One frame, without its newline, per document; ids holds the ids of all, counts their numbers."""
    width = ids.itemsize
    raw, sizes = ids.view(np.uint8), counts * width
    lengths = sizes + BODY
    ends = np.cumsum(lengths + HEAD + 4)
    starts = ends - lengths - HEAD - 4
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    _put(out, starts, lengths.astype("<u8"))
    _put(out, starts + HEAD, doc_ids.astype("<i8"))
    out[starts + HEAD + 8] = nulls
    out[starts + HEAD + 9] = width
    at = 0
    for to, n in zip((starts + HEAD + BODY).tolist(), sizes.tolist(), strict=True):
        out[to : to + n] = raw[at : at + n]
        at += n
    _put(out, starts + 8, masked(crc32c(out, starts, starts + 8)).astype("<u4"))
    _put(out, ends - 4, masked(crc32c(out, starts + HEAD, ends - 4)).astype("<u4"))
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def spans(content: memoryview) -> np.ndarray:
    """Start of every frame of a file, then the file's length; raises where the lengths do not add up."""
    at, out, size = 0, [], len(content)
    while at < size:
        out.append(at)
        at += int.from_bytes(content[at : at + 8], "little") + HEAD + TAIL
    if at != size:
        raise ValueError(f"frame at byte {out[-1]} runs past the end of the file")
    return np.array([*out, size], np.int64)


def check(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
    """Raise unless length and payload checksums of the frames hold."""
    for name, a, b in (("length", starts, starts + 8), ("payload", starts + HEAD, ends - TAIL)):
        stored = data[b[:, None] + np.arange(4)].view("<u4").ravel()
        wrong = np.flatnonzero(stored != masked(crc32c(data, a, b)))
        if len(wrong):
            raise ValueError(f"{name} checksum fails in the frame at byte {starts[wrong[0]]}")
