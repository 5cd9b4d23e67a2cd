"""Word runs of texts hashed by CRC-32, without building their strings.

A word is a run of the bytes 0-9, a-z and 0x80 to 0xFF after A-Z became a-z. Texts are written as one line in which every byte outside words
is a space. An Aho-Corasick automaton over the dictionary entries " word " scans the line; as entries reach from delimiter to
delimiter, only whole words match, each exactly once, and a match emits the number of the word, that is its payload: the CRC
of the word, the CRC of the word and a space, and its length. Payloads of neighbouring words compose to the CRC of their run,
since crc(ab) = shift(crc(a), length of b) xor crc(b) with a shift that is linear over bits.

The dictionary learns from the texts a worker reads and is bounded; words it lacks get the same payload computed directly, so
its content changes the speed, never a result.
"""

import functools
import itertools
import zlib

import numpy as np

#: Dictionary entries at most, and bytes of an entry at most.
MAX_WORDS = 1 << 17
MAX_BYTES = 48
#: The automaton is built again when the words learnt since are more than this share of its entries.
LEARN_SHARE = 0.25
#: The generator polynomial of CRC-32 (reflected), a fixed value.
POLYNOMIAL = 0xEDB88320
#: Lengths whose shift has a table of its own; longer shifts are made of powers of two.
DIRECT = 256

_LINE = np.full(256, 0x20, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _LINE[_first:_last + 1] = np.arange(_first, _last + 1)
_LINE[0x41:0x5B] = np.arange(0x61, 0x7B)


def _byte_tables(columns):
    """Four tables of 256 from a linear map given by the images of the 32 bits."""
    out = np.zeros((4, 256), np.uint32)
    for part in range(4):
        for bit in range(8):
            out[part][(np.arange(256) >> bit & 1).astype(bool)] ^= columns[8 * part + bit]
    return out


def _apply(tables, crc):
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


def _shift_tables():
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    byte = bits.copy()
    for _ in range(8):
        byte = np.where(byte & 1, byte >> 1 ^ np.uint32(POLYNOMIAL), byte >> 1).astype(np.uint32)
    one = _byte_tables(byte)
    direct, images = [], bits
    for _ in range(DIRECT):
        direct.append(_byte_tables(images))
        images = _apply(one, images)
    powers, images = [], _apply(one, bits)
    for _ in range(40):  # shifts by 1, 2, 4, ... bytes
        powers.append(_byte_tables(images))
        images = _apply(powers[-1], images)
    return np.ascontiguousarray(np.array(direct).reshape(-1)), np.array(powers)


_DIRECT, _POWERS = _shift_tables()


def shift(crc, length):
    """CRCs as if ``length`` zero bytes came after them, without the start value; the linear part of a composition."""
    base = np.minimum(length, DIRECT - 1) * 1024
    out = _DIRECT[base + (crc & 255)] ^ _DIRECT[base + 256 + (crc >> 8 & 255)] ^ _DIRECT[base + 512 + (crc >> 16 & 255)] ^ _DIRECT[base + 768 + (crc >> 24)]
    far = np.flatnonzero(length >= DIRECT)
    if len(far):
        value, left = crc[far], length[far].astype(np.int64)
        for power in _POWERS:
            odd = (left & 1).astype(bool)
            value = np.where(odd, _apply(power, value), value)
            left >>= 1
        out[far] = value
    return out


def compose(first, second, length):
    """CRC of two strings one after the other from their CRCs and the length of the second."""
    return shift(first, length) ^ second


def run_crcs(crc, spaced, length):
    """CRCs of all runs of one, two and three words from the payloads of neighbouring words.

    ``spaced`` is the CRC of a word and a space. Entry i of the second and third result starts at word i.
    """
    pairs = compose(spaced[:-1], crc[1:], length[1:])
    lead = compose(spaced[:-2], spaced[1:-1], length[1:-1] + 1)
    return crc, pairs, compose(lead, crc[2:], length[2:])


def line_of(data, offsets):
    """All texts as one line that starts and ends with a space, and the place in it where each text begins (one more at the end)."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    begins = offsets + np.arange(1, n + 2)
    line = np.full(int(offsets[-1]) + n + 2, 0x20, np.uint8)
    line[np.arange(int(offsets[-1])) + np.repeat(np.arange(1, n + 1), size)] = _LINE[data[:offsets[-1]]]
    return line, begins


class WordDictionary:
    """Payloads of known words and the automaton that finds them."""

    def __init__(self, max_words=MAX_WORDS):
        self.max_words = max_words
        self.known, self.fresh = {}, 0
        self.payload = np.zeros((3, 1024), np.uint32)  # crc, crc with a space, length
        self.automaton = None

    def _learn(self, words):
        for word in words:
            if len(self.known) >= self.max_words:
                break
            if len(word) > MAX_BYTES or word in self.known:
                continue
            number = self.known[word] = len(self.known)
            if number >= self.payload.shape[1]:
                self.payload = np.concatenate([self.payload, np.zeros_like(self.payload)], 1)
            crc = zlib.crc32(word)
            self.payload[:, number] = crc, zlib.crc32(b" ", crc), len(word)
            self.fresh += 1
        built = 0 if self.automaton is None else len(self.automaton)
        if self.fresh and (built == 0 or self.fresh > LEARN_SHARE * built or len(self.known) == self.max_words):
            self._build()

    def _build(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for word, number in self.known.items():
            self.automaton.add_word(f" {word.decode('latin-1')} ", number)
        self.automaton.make_automaton()
        self.fresh = 0

    def scan(self, line):
        """Start, CRC, CRC with a space and length of every word of a line, in order."""
        inside = line != 0x20
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        number = np.full(len(starts), -1, np.int64)
        raw = line.tobytes()
        if self.automaton is not None and len(starts):
            found = np.fromiter(itertools.chain.from_iterable(self.automaton.iter(raw.decode("latin-1"))), np.int64).reshape(-1, 2)
            number[np.searchsorted(ends, found[:, 0])] = found[:, 1]  # a match ends at the space after its word
        crc, spaced, length = (row[number] for row in self.payload)
        new = np.flatnonzero(number < 0)
        if len(new):
            words = {}
            for i in new:
                word = raw[starts[i]:ends[i]]
                if word not in words:
                    value = zlib.crc32(word)
                    words[word] = value, zlib.crc32(b" ", value)
                crc[i], spaced[i] = words[word]
            length = length.astype(np.int64)
            length[new] = (ends - starts)[new]
            self._learn(words)
        return starts, crc, spaced, length.astype(np.int64)


@functools.lru_cache(maxsize=1)
def dictionary():
    """One dictionary per worker, so that it serves all tasks of the worker."""
    return WordDictionary()


def feature_buckets(data, offsets, buckets, words=None):
    """Bucket of every run of one to three words, the text it belongs to, and the number of words per text."""
    line, begins = line_of(data, offsets)
    starts, crc, spaced, length = (words or dictionary()).scan(line)
    first = np.searchsorted(starts, begins)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    found, owners = [], []
    for k, run in enumerate(run_crcs(crc, spaced, length)):
        whole = owner[k:] == owner[:len(owner) - k] if k else np.ones(len(owner), bool)
        found.append(run[:len(whole)][whole].astype(np.int64) % buckets)
        owners.append(owner[:len(whole)][whole])
    return np.concatenate(found), np.concatenate(owners), n
