"""Values of strings, looked up for a batch of texts at a time.

The strings of a batch are made distinct, those are looked up in a table of
bounded size, and only what it lacks reaches Python. Strings and values lie in
Arrow arrays: as Python objects in a dict they take ten times the memory, and
nearly every look at one of a long tail misses the processor's caches.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_BYTES = 1 << 26    # of strings and values that a table keeps


class Table:
    """``learn`` gives the values of new strings; at most ``most`` strings, and MOST_BYTES, outlast a batch."""

    def __init__(self, learn: Callable[[list[str]], list[bytes]], most: int):
        self.learn, self.most = learn, most
        self.clear()

    def clear(self) -> None:
        self.strings, self.values = pa.array([], pa.string()), pa.array([], pa.binary())

    def joined(self, lists: pa.ListArray) -> list[bytes]:
        """The values of each list's strings, end to end."""
        coded = lists.flatten().dictionary_encode()
        if not len(coded):
            return [b""] * len(lists)
        if len(self.strings) > self.most or self.strings.nbytes + self.values.nbytes > MOST_BYTES:
            self.clear()
        found = pc.index_in(coded.dictionary, value_set=self.strings)
        at = found.fill_null(-1).to_numpy().copy()
        if found.null_count:
            new, before = coded.dictionary.filter(found.is_null()), len(self.strings)
            self.values = pa.concat_arrays([self.values, pa.array(self.learn(new.to_pylist()), pa.binary())])
            self.strings = pa.concat_arrays([self.strings, new])
            at[at < 0] = np.arange(before, before + len(new))
        whole = self.values.take(pa.array(at).take(coded.indices))
        _, offsets, data = whole.buffers()
        ends = np.frombuffer(offsets, np.int32)[lists.offsets.to_numpy()].tolist()
        data = memoryview(data) if data is not None else b""
        return [bytes(data[a:z]) for a, z in zip(ends, ends[1:])]
