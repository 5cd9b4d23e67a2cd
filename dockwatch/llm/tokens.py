"""Whole texts to token ids with the tokenizers library, each distinct space-separated piece encoded once.

With a byte-level tokenizer whose pieces may start with one space, a text can be cut without changing its ids before a
single space or line break between two non-space characters, after such a line break, and between a letter and a
punctuation mark. Equal pieces of a batch are therefore encoded once, and a bounded cache keeps pieces between the batches
and tasks of a worker. Pieces are matched by a 64-bit hash that covers their length.
"""

import functools
import os

import numpy as np

from dockwatch.llm.textscan import SPACE, slices, span_hashes

#: Pieces kept between batches; when full, new pieces are encoded but not kept.
CACHE_PIECES = 1 << 19
#: First bytes of characters that can be white space outside ASCII; no cut before them.
_MAYBE_SPACE = np.zeros(256, bool)
_MAYBE_SPACE[:0x21] = True
_MAYBE_SPACE[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Not the bar: it occurs inside the name of a special token.
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?\"'()#$%&*")] = True
#: New pieces encoded at once; an encoding takes much more memory than its ids.
ENCODE_PIECES = 1024


def tokenizer_file(name="byte_bpe_50k.json"):
    import public_tokenizers

    return public_tokenizers.path(name)


def ragged(starts, lengths):
    """Positions of all ranges ``starts[i] .. starts[i] + lengths[i]``, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    at = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - at, lengths)


class Encoder:
    """Encodes batches of texts held as bytes and offsets."""

    def __init__(self, path):
        # Spark already runs one task per core
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keys = np.zeros(0, np.uint64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _pieces(self, data, offsets):
        n = len(data)
        cut = np.zeros(n, bool)
        if n > 2:
            before, here, after = data[:-2], data[1:-1], data[2:]
            single = ~SPACE[before] & ~_MAYBE_SPACE[after]
            line = (here == 0x0A) & single
            cut[1:-1] = ((here == 0x20) & single) | line | (_LETTER[before] & _MARK[here])
            cut[2:] |= line
        inner = offsets[:-1]
        cut[inner[inner < n]] = True
        starts = np.flatnonzero(cut)
        return starts, np.append(starts[1:], n)

    def _encode(self, data, starts, ends):
        raw = data.tobytes()
        lengths, flat = [], []
        for i in range(0, len(starts), ENCODE_PIECES):
            pieces = [raw[a:b].decode() for a, b in zip(starts[i:i + ENCODE_PIECES], ends[i:i + ENCODE_PIECES])]
            ids = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            lengths.append(np.array([len(x) for x in ids], np.int64))
            flat.append(np.fromiter((t for x in ids for t in x), np.uint32, int(lengths[-1].sum())))
        lengths = np.concatenate(lengths)
        return np.cumsum(lengths) - lengths, lengths, np.concatenate(flat)

    def encode(self, data, offsets):
        """Flat token ids and, per text, the position of its first id (one more at the end)."""
        starts, ends = self._pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        keys, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        begin, length = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        begin[known], length[known] = self.starts[at[known]], self.lengths[at[known]]
        ids = self.ids
        new = np.flatnonzero(~known)
        if len(new):
            a, n, flat = self._encode(data, starts[first[new]], ends[first[new]])
            begin[new], length[new] = a + len(ids), n
            ids = np.concatenate([ids, flat])
            if len(self.keys) + len(new) <= CACHE_PIECES:
                spot = at[new]  # keys stay sorted
                self.keys = np.insert(self.keys, spot, keys[new])
                self.starts = np.insert(self.starts, spot, begin[new])
                self.lengths = np.insert(self.lengths, spot, n)
                self.ids = ids
        lengths = length[which]
        flat = ids[ragged(begin[which], lengths)]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return flat, total[np.searchsorted(starts, offsets)]

    def encode_texts(self, data, offsets):
        """For slices of bounded size: first text, last text, flat ids, positions."""
        for a, b in slices(offsets):
            ids, at = self.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            yield a, b, ids, at


@functools.lru_cache(maxsize=2)
def encoder(path):
    """One encoder per worker, so that its cache serves all tasks of the worker."""
    return Encoder(path)
