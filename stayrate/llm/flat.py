"""Many short sequences in flat numpy arrays, and numbers for their keys."""

from __future__ import annotations

import numpy as np


class Numbers(dict):
    """Consecutive numbers for keys as they are first asked for; ``new`` lists these keys."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


class Strings:
    """Short sequences in one flat array; ``gather`` concatenates any of them at once."""

    def __init__(self, items: list, dtype=np.uint8):
        self.dtype, self.flat = dtype, np.zeros(0, dtype)
        self.starts = self.lengths = np.zeros(0, np.int64)
        self.extend(items)

    def extend(self, items: list) -> None:
        if not items:
            return
        arrays = [np.frombuffer(x, np.uint8) if isinstance(x, bytes) else x for x in items]
        lengths = np.fromiter(map(len, arrays), np.int64, len(arrays))
        self.append(np.concatenate(arrays), lengths)

    def append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        """Add sequences of these lengths that follow one another in ``flat``."""
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate((self.flat, flat.astype(self.dtype)))
        self.starts = np.concatenate((self.starts, starts))
        self.lengths = np.concatenate((self.lengths, lengths))

    def gather(self, which: np.ndarray) -> np.ndarray:
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.starts[which] - (ends - lengths), lengths)]
