"""SHA-256 states of many messages at once, in numpy.

A message of k hexadecimal digests is k blocks of 64 bytes and one of padding, so
the state before each digest is a state between blocks: 8 words that can be
stored and resumed. Digests are rows of 32 bytes, states rows of 8 words.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

DIGEST = 32


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= x else (low, mid - 1)
    return low


# By the standard: first 32 bits of the fractions of roots of the first primes.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def absorb(states: np.ndarray, words: np.ndarray) -> np.ndarray:
    """States (n, 8) after a block of 16 words each (n, 16)."""
    w = list(np.ascontiguousarray(words.T))
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        small = _turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))
        large = _turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))
        w.append(w[t - 16] + small + w[t - 7] + large)
    a, b, c, d, e, f, g, h = np.ascontiguousarray(states.T)
    for t in range(64):
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + ROUND[t] + w[t]
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], axis=1)


def start(n: int) -> np.ndarray:
    return np.tile(START, (n, 1))


def block(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32) as the words of their hexadecimal text, a block each."""
    text = np.empty((len(digests), 2 * DIGEST), np.uint8)
    text[:, 0::2], text[:, 1::2] = _HEX[digests >> 4], _HEX[digests & 15]
    return text.view(">u4").astype(np.uint32)


def finish(states: np.ndarray, n_blocks: np.ndarray) -> np.ndarray:
    """Digests of messages that end after `n_blocks` whole blocks."""
    end = np.zeros((len(states), 16), np.uint32)
    end[:, 0], end[:, 15] = 0x80000000, n_blocks * 512
    return absorb(states, end).astype(">u4").view(np.uint8).reshape(-1, DIGEST)
