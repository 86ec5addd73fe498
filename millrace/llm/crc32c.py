"""CRC-32C (Castagnoli) of many buffers of 32-bit words at once, with numpy."""

from __future__ import annotations

import numpy as np

from millrace.llm.texts import gather, running

_POLYNOMIAL = 0x82F63B78  # reflected
_MASK_DELTA = 0xA282EAD8
_LANE = 64  # words


def _byte_tables() -> np.ndarray:
    """Table k: what a byte becomes after k further zero bytes."""
    table = np.zeros((4, 256), np.uint32)
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ (_POLYNOMIAL if c & 1 else 0)
        table[0, i] = c
    for k in range(1, 4):
        table[k] = (table[k - 1] >> 8) ^ table[0][table[k - 1] & 255]
    return table


_T = _byte_tables()


def _step(state: np.ndarray, words) -> np.ndarray:
    x = state ^ words
    return _T[3][x & 255] ^ _T[2][(x >> 8) & 255] ^ _T[1][(x >> 16) & 255] ^ _T[0][x >> 24]


def _lane_shift() -> np.ndarray:
    """Tables that move a state past one lane of zero words, by state byte."""
    one = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(_LANE):
        one = _step(one, np.uint32(0))
    tables = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for bit in range(8):
            has = (np.arange(256) >> bit) & 1 == 1
            tables[k, has] ^= one[8 * k + bit]
    return tables


_SHIFT = _lane_shift()


def _shift(x: np.ndarray) -> np.ndarray:
    return _SHIFT[0][x & 255] ^ _SHIFT[1][(x >> 8) & 255] ^ _SHIFT[2][(x >> 16) & 255] ^ _SHIFT[3][x >> 24]


def crc32c(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC of every buffer ``words[offsets[i]:offsets[i + 1]]`` (little-endian bytes).

    A buffer is filled with zero words in front up to whole lanes, which leaves a state of zero as
    it is; all lanes run side by side and are then chained. The start state of all ones is put into
    the first word.
    """
    n = np.diff(offsets)
    lanes = -(-n // _LANE)
    at = running(lanes)
    grid = np.zeros(int(at[-1]) * _LANE, np.uint32)
    ends = at[1:] * _LANE
    grid[gather(ends - n, n)] = words[int(offsets[0]) : int(offsets[-1])]
    grid[(ends - n)[n > 0]] ^= np.uint32(0xFFFFFFFF)
    grid = grid.reshape(-1, _LANE)
    state = np.zeros(len(grid), np.uint32)
    for k in range(_LANE):
        state = _step(state, grid[:, k])
    out = np.zeros(len(n), np.uint32)
    order = np.argsort(-lanes, kind="stable")
    longer = np.searchsorted(-lanes[order], -np.arange(int(lanes.max(initial=0))), side="left")
    for k, count in enumerate(longer):  # the first ``count`` buffers have a lane k
        rows = order[:count]
        out[rows] = _shift(out[rows]) ^ state[at[rows] + k]
    return np.where(n > 0, out ^ np.uint32(0xFFFFFFFF), np.uint32(0)).astype(np.uint32)


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotate and shift, so that a checksum of data that hold checksums stays useful."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK_DELTA)
