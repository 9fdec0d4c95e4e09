"""Text encoders. Any object with ``encode(list of str) -> 2-d array`` will do."""

from __future__ import annotations

import re
from functools import lru_cache
from hashlib import md5

import numpy as np

_TOKEN = re.compile(r"\w+")


@lru_cache(maxsize=1 << 18)
def _bucket(token: str, dim: int) -> int:
    return int(md5(token.encode()).hexdigest()[:8], 16) % dim


class HashedCounts:
    """Counts of lower-cased words in ``dim`` hash buckets, scaled to unit length on request."""

    def __init__(self, dim: int = 64, unit: bool = True):
        self.dim, self.unit = dim, unit

    def encode(self, texts):
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for row, text in zip(out, texts):
            for token in _TOKEN.findall((text or "").lower()):
                row[_bucket(token, self.dim)] += 1
        if self.unit:
            norm = np.linalg.norm(out, axis=1, keepdims=True)
            out = np.divide(out, norm, out=out, where=norm > 0)
        return out
