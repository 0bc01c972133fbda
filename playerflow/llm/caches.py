"""A bounded memory of computed values."""

from __future__ import annotations


class Generations(dict):
    """Values made by ``make`` on a miss, at most twice ``size`` of them.

    When full, the present generation becomes the old one and the old one is
    forgotten; what is used again moves over. Frequent keys so stay.
    """

    def __init__(self, size: int, make):
        super().__init__()
        self.size, self.make, self.old = size, make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
