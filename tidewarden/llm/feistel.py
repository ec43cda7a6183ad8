"""Keyed permutations of the numbers below a size, by a Feistel network."""

from __future__ import annotations

import math
from collections.abc import Callable
from hashlib import blake2b

TURNS = 10


class Feistel:
    """A permutation of ``0 .. size - 1`` for every key and tweak. A number is split into
    two digits of a mixed base; each turn adds a keyed hash of one to the other. What
    falls beyond the size is permuted on until it falls inside."""

    def __init__(self, key: bytes) -> None:
        self.key = key

    def _hash(self, tweak: bytes, turn: int, digit: int, base: int) -> int:
        data = tweak + b"/" + str((turn, digit, base)).encode()
        size = max(16, (base.bit_length() + 7) // 8 + 8)
        out, block = b"", 0
        while len(out) < size:
            out += blake2b(data + b"/" + str(block).encode(), key=self.key[:64], digest_size=64).digest()
            block += 1
        return int.from_bytes(out[:size], "big") % base

    def _once(self, x: int, size: int, tweak: bytes, back: bool) -> int:
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        high, low = divmod(x, b)
        for turn in reversed(range(TURNS)) if back else range(TURNS):
            sign = -1 if back else 1
            if turn % 2:
                low = (low + sign * self._hash(tweak, turn, high, b)) % b
            else:
                high = (high + sign * self._hash(tweak, turn, low, a)) % a
        return high * b + low

    def permute(self, x: int, size: int, tweak: bytes, inside: Callable[[int], bool] | None = None, back: bool = False) -> int:
        """Where ``x`` goes (or, with ``back``, where it came from), among the numbers
        that ``inside`` holds for, which must include ``x``."""
        if not 0 <= x < size:
            raise ValueError(f"{x} is not below {size}")
        if size < 2:
            return x
        while True:
            x = self._once(x, size, tweak, back)
            if x < size and (inside is None or inside(x)):
                return x
