"""CRC-32 of any substring from two running CRCs, vectorised.

The raw register of CRC-32 (zero start, no final inversion) is linear over
GF(2): the register after the bytes a + b is the register after a, shifted by
len(b) zero bytes, XOR the register after b.  So one scan that keeps running
registers is enough: the register of data[s:e] is R(e) XOR shift(R(s), e - s).
The scan goes through LANE byte positions at a time for all lanes at once;
registers cross lanes by the same shift.
"""

from __future__ import annotations

import numpy as np

POLYNOMIAL = 0xEDB88320
LANE = 256
SEGMENT = 1 << 22


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1).astype(np.uint32)
    return t


TABLE = _byte_table()


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """x through a linear map given by its values on each of the four bytes: table[..., 4, 256]."""
    return (table[0][x & 0xFF] ^ table[1][(x >> 8) & 0xFF] ^ table[2][(x >> 16) & 0xFF] ^ table[3][x >> 24])


def _next_digit(step: np.ndarray) -> np.ndarray:
    """Maps for 0 .. 255 times ``step``: table[m, byte, value]."""
    out = np.empty((256, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for m in range(1, 256):
        out[m] = _apply(step, out[m - 1])
    return out


class _Shifts:
    """Shift maps by base-256 digit of the number of zero bytes, made when first needed."""

    def __init__(self):
        value = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
        self.step = TABLE[value & 0xFF] ^ (value >> 8)
        self.digits: list[np.ndarray] = []

    def digit(self, k: int) -> np.ndarray:
        while len(self.digits) <= k:
            self.digits.append(_next_digit(self.step))
            self.step = _apply(self.step, self.digits[-1][255])
        return self.digits[k]


SHIFTS = _Shifts()


def shift(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers ``x`` after ``n`` further zero bytes each."""
    out = x.astype(np.uint32)
    n = np.asarray(n, np.int64)
    k = 0
    while len(n) and (n > 0).any():
        low = n & 255
        at = np.flatnonzero(low)
        if len(at):
            t, m, v = SHIFTS.digit(k), low[at], out[at]
            out[at] = t[m, 0, v & 0xFF] ^ t[m, 1, (v >> 8) & 0xFF] ^ t[m, 2, (v >> 16) & 0xFF] ^ t[m, 3, v >> 24]
        n = n >> 8
        k += 1
    return out


def _segment(data: np.ndarray, places: np.ndarray, register: int) -> tuple[np.ndarray, int]:
    """(registers after the first ``places`` bytes, register at the end), started from ``register``."""
    lanes = max(1, -(-len(data) // LANE))
    rows = np.zeros(lanes * LANE, np.uint8)
    rows[:len(data)] = data
    rows = np.ascontiguousarray(rows.reshape(lanes, LANE).T)
    local = np.zeros((LANE + 1, lanes), np.uint32)             # from the start of the lane
    for i in range(LANE):
        local[i + 1] = TABLE[(local[i] & 0xFF) ^ rows[i]] ^ (local[i] >> 8)
    carry = np.empty(lanes + 1, np.uint32)
    carry[0] = register
    whole = SHIFTS.digit(1)[1].tolist()
    c = int(register)
    for j, end in enumerate(local[LANE].tolist()):
        c = whole[0][c & 255] ^ whole[1][c >> 8 & 255] ^ whole[2][c >> 16 & 255] ^ whole[3][c >> 24] ^ end
        carry[j + 1] = c
    lane, inside = np.divmod(np.append(places, len(data)), LANE)
    before = carry[lane]
    full = inside == 0
    out = local[inside, np.minimum(lane, lanes - 1)] ^ shift(before, inside)
    out[full] = before[full]
    return out[:-1], int(out[-1])


def registers(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Running register of ``data`` after each number of bytes in ``places`` (ascending)."""
    out = np.zeros(len(places), np.uint32)
    register = 0
    for at in range(0, max(len(data), 1), SEGMENT):
        part = data[at:at + SEGMENT]
        i, j = np.searchsorted(places, [at, at + SEGMENT])
        if at + SEGMENT >= len(data):
            j = len(places)
        out[i:j], register = _segment(part, places[i:j] - at, register)
    return out


def substring_crcs(before: np.ndarray, after: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of substrings from the registers before and after them and their lengths."""
    ones = np.uint32(0xFFFFFFFF)
    return after ^ shift(before ^ ones, length) ^ ones
