"""Words, spans and 64-bit hashes of whole text batches with numpy, no loop over characters or words.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, that is ``[^\\x20\\x09-\\x0D]+``.
Texts come as one byte array with document offsets, as Arrow stores them.
"""

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
_RANDOM = np.random.default_rng(20240229)
BYTE_CODE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed at once; bounds the 64-bit working arrays whatever the length of a text.
CHUNK = 1 << 20
#: Bytes of text per slice of a batch.
SLICE = 1 << 20


def mix(x):
    """Finaliser that spreads 64-bit values (splitmix64)."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        return _mix(x)


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(offsets, limit=SLICE):
    """Ranges of documents that hold about ``limit`` bytes each (a longer document stands alone)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def spans(inside, offsets):
    """Start and end of every run of True, never across a document; and runs before each document."""
    n = len(inside)
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    first = offsets[:-1]
    before[first[first < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data, offsets):
    """Word starts, ends and, per document, the position of its first word (one more at the end)."""
    return spans(~SPACE[data], offsets)


def _powers(n):
    out = np.empty(n, np.uint64)
    out[:1] = 1
    out[1:] = STEP
    return np.multiply.accumulate(out)


def span_hashes(data, starts, ends, lower=False):
    """64-bit hash of the bytes of every span (spans in order, not overlapping)."""
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    longest = int((ends - starts).max())
    powers = _powers(min(longest, CHUNK))
    code = BYTE_CODE[LOWER] if lower else BYTE_CODE
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        if ends[i] - starts[i] > CHUNK:  # one very long span: piece by piece
            total = np.uint64(0)
            for at in range(int(starts[i]), int(ends[i]), CHUNK):
                piece = code[data[at:min(at + CHUNK, int(ends[i]))]]
                total = mix(mix(total) ^ (piece * powers[:len(piece)]).sum(dtype=np.uint64))
            out[i] = total
            i += 1
            continue
        s, e, base = starts[i:j], ends[i:j], starts[i]
        part = code[data[base:e[-1]]]
        gaps = np.diff(np.append(s, e[-1]))
        within = np.arange(len(part)) - np.repeat(s - base, gaps)
        part = part * powers[np.minimum(within, len(powers) - 1)]
        bounds = np.stack([s - base, e - base], 1).ravel()
        sums = np.add.reduceat(part, bounds[:-1])[::2] if len(bounds) > 2 else np.array([part.sum(dtype=np.uint64)])
        out[i:j] = sums
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * STEP)


def windows(hashes, k):
    """Hash of every run of ``k`` neighbouring word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * STEP + hashes[j:j + n]
    return mix(total + np.uint64(k))


def shingle_set(hashes, k):
    """Sorted distinct shingle hashes of one document; fewer than ``k`` words make one shingle, none make none."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return np.unique(windows(hashes, min(k, len(hashes))))
