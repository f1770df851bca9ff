"""SetSketch: exponentially spaced truncated minima of exponentially distributed hash values.

An element sends ascending points to the registers in an order of its own; a register keeps its smallest point x, stored
as floor(1 - log_BASE(x)) in one byte. Sketches of a union are the larger registers, and equal registers are as likely as
the sets are similar, so register values can be banded.
"""

from __future__ import annotations

import numpy as np

from foresight.llm.text import mix

REGISTERS = 512
RATE = 20.0
BASE = 1.085        # 255 steps span sets of one to tens of millions of elements
_STEP = 0x9E3779B97F4A7C15


def sketch(elements: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(sets, REGISTERS) uint8 of the sets elements[first[i]:first[i + 1]]; an empty set has all registers 0."""
    sets = len(first) - 1
    low = np.full(sets * REGISTERS, np.inf)
    owner = np.repeat(np.arange(sets, dtype=np.int64), np.diff(first))
    h = elements.astype(np.uint64)
    register = (h & np.uint64(REGISTERS - 1)).astype(np.int64)
    stride = ((h >> np.uint64(8)) & np.uint64(REGISTERS - 1) | np.uint64(1)).astype(np.int64)
    x = np.zeros(len(h))
    for j in range(REGISTERS):
        u = ((mix(h + np.uint64((j + 1) * _STEP % 2**64)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        x = x - np.log(u) / (RATE * (REGISTERS - j))
        limit = low.reshape(sets, REGISTERS).max(axis=1)
        live = x < limit[owner]
        if not live.all():
            owner, h, register, stride, x = owner[live], h[live], register[live], stride[live], x[live]
        if not len(h):
            break
        np.minimum.at(low, owner * REGISTERS + register, x)
        register = (register + stride) & (REGISTERS - 1)
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(low) / np.log(BASE))
    return np.clip(k, 0, 255).astype(np.uint8).reshape(sets, REGISTERS)


def _share(x):
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


_GRID = np.linspace(0, 1, 201)


def joint_estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of each pair of sketches, from how many registers are larger, smaller and equal
    and from both set sizes."""
    if not len(a):
        return np.zeros(0)
    up = (a > b).sum(1)[:, None]
    down = (a < b).sum(1)[:, None]
    same = REGISTERS - up - down
    u = (size_a / np.maximum(size_a + size_b, 1))[:, None]
    v = 1 - u
    most = np.minimum(u, v) / np.maximum(np.maximum(u, v), 1e-300)
    j = _GRID[None, :] * most
    p = np.clip(_share(np.clip(u - v * j, 0, 1)), 1e-9, 1)
    q = np.clip(_share(np.clip(v - u * j, 0, 1)), 1e-9, 1)
    likelihood = up * np.log(p) + down * np.log(q) + same * np.log(np.clip(1 - p - q, 1e-9, 1))
    return np.take_along_axis(j, likelihood.argmax(1)[:, None], 1)[:, 0]


def low_bits(registers: np.ndarray) -> np.ndarray:
    """The two low bits of every register, packed into 64-bit words."""
    r = registers.reshape(len(registers), REGISTERS // 4, 4)
    packed = (r[:, :, 0] & 3) | (r[:, :, 1] & 3) << 2 | (r[:, :, 2] & 3) << 4 | (r[:, :, 3] & 3) << 6
    return np.ascontiguousarray(packed.astype(np.uint8)).view(np.uint64)


def equal_low_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers whose low bits agree: equal registers and a quarter of the others."""
    x = a ^ b
    return REGISTERS - np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(-1, dtype=np.int64)
