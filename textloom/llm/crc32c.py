"""CRC-32C of byte strings, many bytes at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Fixed values of the checksum and of its mask.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
BLOCK = 512


@lru_cache(1)
def _tables() -> tuple[np.ndarray, list[list[int]]]:
    """``places[i, b]``: what byte ``b`` adds, ``BLOCK - 1 - i`` bytes before the end; and the step over a whole block."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> 1) ^ np.where(step & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    places = np.empty((BLOCK, 256), np.uint32)
    places[-1] = step
    for i in range(BLOCK - 2, -1, -1):
        places[i] = (places[i + 1] >> 8) ^ step[places[i + 1] & 0xFF]
    # A state before a block acts as if it were xored onto the block's first four bytes.
    return places, [places[i].tolist() for i in range(4)]


def crc32c_all(parts: list[bytes]) -> list[int]:
    """The checksum of each byte string."""
    places, (t0, t1, t2, t3) = _tables()
    at = np.arange(BLOCK) * 256
    flat, out = places.ravel(), []
    sizes = [-(-len(p) // BLOCK) for p in parts]
    # Zeros in front of a string change nothing when the state begins with zero;
    # the state that it has to begin with is put on its first four bytes instead.
    blocks = np.zeros((sum(sizes), BLOCK), np.uint8)
    rows, end = blocks.reshape(-1), 0
    for p, size in zip(parts, sizes, strict=True):
        end += size * BLOCK
        raw = rows[end - len(p) : end]
        raw[:] = np.frombuffer(p, np.uint8)
        raw[:4] ^= 0xFF
    own = np.empty(len(blocks), np.uint32)
    for s in range(0, len(blocks), 256):
        own[s : s + 256] = np.bitwise_xor.reduce(flat[blocks[s : s + 256] + at], axis=1)
    states, row = own.tolist(), 0
    for p, size in zip(parts, sizes, strict=True):
        state = 0
        for one in states[row : row + size]:
            state = one ^ t0[state & 0xFF] ^ t1[state >> 8 & 0xFF] ^ t2[state >> 16 & 0xFF] ^ t3[state >> 24]
        row += size
        out.append(_short(p) if len(p) < 4 else state ^ 0xFFFFFFFF)
    return out


def _short(data: bytes) -> int:
    state = 0xFFFFFFFF
    for b in data:
        state = (state >> 8) ^ int(_tables()[0][-1, (state ^ b) & 0xFF])
    return state ^ 0xFFFFFFFF


def masked_all(parts: list[bytes]) -> list[int]:
    """The checksums rotated and shifted, so that a checksum of checksums stays sound."""
    return [((c >> 15 | c << 17) + MASK_DELTA) & 0xFFFFFFFF for c in crc32c_all(parts)]
