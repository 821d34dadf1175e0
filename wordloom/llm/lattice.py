"""Weighted transducers over strings in the tropical semiring: weights add along a path, the least path counts.

``Normaliser`` is the sequential transducer of a model's character map: at each
place the arc that reads the longest string is taken and writes its mapping, a
character without an arc is copied. ``shortest_path`` solves the composition of
an input string with a transducer that is given by its arcs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import inf

import numpy as np

State = str
Arc = tuple[int, State, float, str]     # characters read, next state, weight, label written


def shortest_path(length: int, start: State, arcs: Callable[[int, State], Iterator[Arc]]) -> tuple[float, list[str]] | None:
    """(weight, labels) of the least path that reads all ``length`` characters, or None where none is finite.

    ``arcs(i, state)`` gives the arcs of the composition at character ``i``;
    each reads at least one, so characters are a topological order. Of paths
    with the same weight the one found first counts.
    """
    reached: list[dict[State, tuple[float, tuple[int, State, str] | None]]] = [{} for _ in range(length + 1)]
    reached[0][start] = 0.0, None
    for i in range(length):
        for state, (cost, _) in reached[i].items():
            for n, to, weight, label in arcs(i, state):
                if cost + weight < reached[i + n].get(to, (inf, None))[0]:
                    reached[i + n][to] = cost + weight, (i, state, label)
    if not reached[length]:
        return None
    state = min(reached[length], key=lambda s: reached[length][s][0])
    weight, back = reached[length][state]
    labels: list[str] = []
    while back is not None:
        i, state, label = back
        labels.append(label)
        back = reached[i][state][1]
    return weight, labels[::-1]


class Normaliser:
    """A compiled character map: the double-array trie of a model file and its strings.

    The map is ``size (u32), trie (u32 units), strings ending in a zero byte``;
    a unit of the trie holds an offset (bits 10 to 30, in blocks of 256 if bit
    9 is set), a label (bits 0 to 7 and 31), and whether it has a value (bit 8).
    """

    def __init__(self, compiled: bytes):
        size = int(np.frombuffer(compiled, "<u4", 1)[0]) if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.strings = compiled[4 + size:]

    def arc(self, b: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes read, bytes written) of the longest string that the map reads at ``at``."""
        if not self.units:
            return None
        found, place = None, self._offset(self.units[0])
        for k in range(at, len(b)):
            c = b[k]
            if c == 0:
                break
            place ^= c
            if place >= len(self.units):
                break
            unit = self.units[place]
            if unit & 0x800000FF != c:
                break
            place ^= self._offset(unit)
            if unit >> 8 & 1:
                value = self.units[place] & 0x7FFFFFFF
                found = k + 1 - at, self.strings[value: self.strings.index(b"\0", value)]
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def __call__(self, text: str) -> str:
        b, out, at = text.encode("utf-8", "replace"), [], 0
        while at < len(b):
            hit = self.arc(b, at)
            if hit is None:
                first = b[at]
                n = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                out.append(b[at: at + n])
                at += n
            else:
                at += hit[0]
                out.append(hit[1])
        return b"".join(out).decode("utf-8", "replace")
