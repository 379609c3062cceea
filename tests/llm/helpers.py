"""Small tables and brute-force counterparts for the tests of this folder."""

from __future__ import annotations

import re

WORD = re.compile("[^\x20\x09-\x0d]+")
ALPHABET = ("sol", "ber", "tin", "mak", "or", "ven", "quil", "das", "nep", "ru", "fal", "gim")


def words(count: int, seed: int) -> list[str]:
    """Invented words, the same for the same seed."""
    state, found = seed * 2654435761 % 2**32 or 1, []
    for _ in range(count):
        state = (1103515245 * state + 12345) % 2**31
        found.append(ALPHABET[state % 12] + ALPHABET[state // 97 % 12] + ALPHABET[state // 1201 % 12])
    return found


def prose(count: int, seed: int) -> str:
    return " ".join(words(count, seed))


class Groups:
    """Union-find; the root of a group is its smallest member."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def top(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text: str | None, size: int = 5) -> frozenset:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = WORD.findall(low)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))
