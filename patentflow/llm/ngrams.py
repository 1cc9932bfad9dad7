"""Hashed character n-grams of whole texts, in numpy."""

import numpy as np

MULTIPLIER, SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)
SPACE = 32


def code_points(text: str | None) -> np.ndarray:
    """Lower-cased code points between two spaces; control characters and line ends count as spaces."""
    codes = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.maximum(codes, np.uint32(SPACE))


def hashed(text: str | None, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Bucket numbers below 2 ** bits of all n-grams of the given sizes, repetitions included.

    The hash of a longer n-gram extends that of the shorter one at the same place, so all sizes cost one
    multiplication and addition a character each.
    """
    codes = code_points(text)
    rolling, found = codes, []
    for n in range(1, max(sizes) + 1):
        if n > 1:
            if len(rolling) < 2:
                break
            rolling = rolling[:-1] * MULTIPLIER + codes[n - 1 :]
        if n in sizes:
            found.append(((rolling ^ np.uint32(n)) * SPREAD) >> np.uint32(32 - bits))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)


def occurring(buckets: np.ndarray, bits: int, times: int) -> np.ndarray:
    """Numbers of the buckets that occur at least once, twice, ... up to `times` times.

    A bucket that occurs at least k times is numbered by itself plus (k - 1) * 2 ** bits as well.
    """
    found, counts = np.unique(buckets, return_counts=True)
    return np.concatenate([found[counts >= k].astype(np.int64) + ((k - 1) << bits) for k in range(1, times + 1)])
