"""A byte-level BPE tokenizer compiled to deterministic transducers that count tokens.

Two machines run one after the other. The *cutter* reads character classes and marks where the pieces begin that the
tokenizer encodes one by one. It has twelve states, so the work of a chunk of text is a map from every state to the
state after the chunk; the maps of all chunks are computed side by side and composed by a parallel prefix scan, which tells
every chunk its true entry state.

The *counter* reads the bytes of a piece. After each byte its state holds what the rest of the encoding can depend on: for
every earlier place from which a token may still be growing, the token that ends there and how many tokens were emitted
since. A token may follow another one exactly if the pair, joined and encoded again, gives the same two tokens, and only one
token can end at a place under this condition; so the machine is deterministic. Its transitions carry the change of the
number of tokens, which is below zero where a longer token takes the place of shorter ones. Transitions are compiled when a
text first needs them and kept in a table of bounded size; a full table is emptied, which costs time, never a result.
"""

import functools
import json
import re

import numpy as np

# states of the cutter: at a piece start; in letters, numbers, other signs; after one space, one other white character, two or
# more of them ending in a space or not; after an apostrophe that starts a piece; after such an apostrophe and r, v or l
START, LETTERS, NUMBERS, OTHERS, SPACE, WHITE, SPACES, WHITES, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(12)
STATES = 12
# classes of characters: letters that end (s t m d) or begin (r v l) a short form and e have their own; END closes a text
C_LETTER, C_NUMBER, C_OTHER, C_SPACE, C_WHITE, C_QUOTE, C_SHORT, C_R, C_V, C_L, C_E, C_END, C_NONE = range(13)
_LETTER_CLASSES = (C_LETTER, C_SHORT, C_R, C_V, C_L, C_E)
UNKNOWN = 255
#: Characters of a chunk whose state map is computed as one lane.
CHUNK = 128
#: Bytes of a piece, or of a chunk of a longer piece, that the counter reads in one lane.
LANE = 64
#: Bytes before a chunk of a long piece from which its entry state is guessed; a wrong guess is run again.
LOOK_BACK = 32
#: States of the counter that are kept, 1 kB each.
MAX_STATES = 1 << 17
BYTES = 256
#: Below a node of the trie with so many tokens at most, tokens before it are told apart only by what may follow them.
FEW = 16
_LOW = 128  # what a packed transition adds to the change of count


def _cutter():
    """Packed tables, index class * 16 + state: next state; marks (1: a piece begins here, 2: at the character before)."""
    begin = {C_NUMBER: NUMBERS, C_OTHER: OTHERS, C_SPACE: SPACE, C_WHITE: WHITE, C_QUOTE: QUOTE, C_END: START, **dict.fromkeys(_LETTER_CLASSES, LETTERS)}
    after_space = {**begin, C_QUOTE: OTHERS}
    following, marks = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
    for c in range(13):
        for s in range(STATES):
            letter, sign, white = c in _LETTER_CLASSES, c in (C_OTHER, C_QUOTE), c in (C_SPACE, C_WHITE)
            run = SPACES if c == C_SPACE else WHITES
            to, mark = begin.get(c, s), 1
            if c == C_NONE:
                to, mark = s, 0
            elif s == LETTERS and letter or s == NUMBERS and c == C_NUMBER:
                mark = 0
            elif s == OTHERS and sign or s == QUOTE and sign:
                to, mark = OTHERS, 0
            elif s in (SPACE, WHITE, SPACES, WHITES) and white:
                to, mark = run, 0
            elif s in (SPACE, SPACES) and c != C_END:
                to, mark = after_space[c], 2 if s == SPACES else 0
            elif s == WHITES and c != C_END:
                mark = 3
            elif s == QUOTE and c in (C_SHORT, C_R, C_V, C_L):
                to, mark = {C_SHORT: START, C_R: QUOTE_R, C_V: QUOTE_V, C_L: QUOTE_L}[c], 0
            elif s in (QUOTE_R, QUOTE_V) and c == C_E or s == QUOTE_L and c == C_L:
                to, mark = START, 0
            elif s in (QUOTE_R, QUOTE_V, QUOTE_L):
                mark = 2 if letter else 3
            following[c * 16 + s], marks[c * 16 + s] = to, mark
    return following, marks


NEXT, MARKS = _cutter()


def state_maps(lanes):
    """For lanes of classes (one column each), the state after the lane for every state before it: lanes x states."""
    maps = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (lanes.shape[1], STATES))
    for row in lanes:
        maps = NEXT[(row * 16)[:, None] + maps]
    return maps


def scan_maps(maps):
    """Maps of all prefixes: lane i of the result leads from before lane 0 to after lane i."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), 1)
        step *= 2
    return maps


def piece_marks(classes, entry=START):
    """True where a piece begins, and the state after the last character."""
    n = len(classes)
    if not n:
        return np.zeros(0, bool), entry
    lanes = -(-n // CHUNK)
    grid = np.full(lanes * CHUNK, C_NONE, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(lanes, CHUNK).T)
    after = scan_maps(state_maps(grid))[:, entry]
    state = np.concatenate([np.array([entry], np.uint8), after[:-1]])
    marks = np.empty_like(grid)
    for k, row in enumerate(grid):
        at = row * 16 + state
        marks[k] = MARKS[at]
        state = NEXT[at]
    marks = marks.T.reshape(-1)[:n]
    begins = (marks & 1).astype(bool)
    begins[:-1] |= marks[1:] > 1
    return begins, int(after[-1])


class Transducer:
    """Counts tokens of whole texts as the tokenizers library would, special strings included."""

    def __init__(self, path, max_states=MAX_STATES):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        kind, before = made["model"], made["pre_tokenizer"] or {}
        plain = kind.get("type") == "BPE" and not any(kind.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or made["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError(f"{path}: only byte-level BPE without normaliser can be compiled")
        special = [t for t in made["added_tokens"] or ()]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in special):
            raise ValueError(f"{path}: special strings that take their surroundings are not supported")
        self.special = re.compile(b"|".join(re.escape(t["content"].encode()) for t in sorted(special, key=lambda t: -len(t["content"])))) if special else None
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.cut = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self._probe(np.arange(128))
        for c, chars in ((C_SPACE, " "), (C_QUOTE, "'"), (C_SHORT, "stmd"), (C_R, "r"), (C_V, "v"), (C_L, "l"), (C_E, "e")):
            self.classes[[ord(x) for x in chars]] = c
        self._load(kind["vocab"])
        self.max_states = max(max_states, 4 * BYTES)
        self._empty()

    def _probe(self, points):
        """Class of characters from the library's own cutting, so that both use one Unicode table."""
        for p in points:
            c = chr(p)
            c = "!" if 0xD800 <= p < 0xE000 else c
            joined = [len(self.cut.pre_tokenize_str(x + c)) == 1 for x in "x1!"]
            self.classes[p] = [C_LETTER, C_NUMBER, C_OTHER, C_WHITE][joined.index(True) if any(joined) else 3]

    def _load(self, vocabulary):
        """Trie of the tokens that their own bytes are encoded to; tokens as text in the library's byte alphabet."""
        names = {}
        for b in range(BYTES):  # the byte alphabet: printable bytes stand for themselves, others follow from 256 on
            shown = 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255
            names[chr(b) if shown else chr(BYTES + sum(not (33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255) for x in range(b)))] = b
        self.children, self.token = [{}], [None]
        for text in vocabulary:
            if any(c not in names for c in text) or [t.value for t in self.model.tokenize(text)] != [text]:
                continue
            node = 0
            for c in text:
                b = names[c]
                if b not in self.children[node]:
                    self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = self.children[node][b]
            self.token[node] = text
        if len(self.children[0]) < BYTES or any(self.token[n] is None for n in self.children[0].values()):
            raise ValueError("not every byte is a token")
        self.below = [None] * len(self.children)  # tokens below a node, if they are few
        for node in range(len(self.children) - 1, 0, -1):
            found = []
            for child in self.children[node].values():
                below = self.below[child]
                found = None if found is None or below is None else found + below + ([self.token[child]] if self.token[child] else [])
                if found is not None and len(found) > FEW:
                    found = None
            self.below[node] = found
        self.follows, self.kept, self.alike = {}, {}, {}

    def _empty(self):
        """A table with the start state only: an earlier place, itself, at the root of the trie, after no token."""
        self.table = np.full(1024 * BYTES, -1, np.int32)
        self.states, self.number = [((0, None, 0),)], {((0, None, 0),): 0}

    def _may_follow(self, a, b):
        if a is None:
            return True
        key = (a, b)
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) >= 1 << 20:
                self.follows.clear()
            known = self.follows[key] = [t.value for t in self.model.tokenize(a + b)] == [a, b]
        return known

    def _place(self, node, before):
        """The token by which an earlier place is known: one for all tokens that allow the same to grow; False if nothing can."""
        key = (node, before)
        known = self.kept.get(key)
        if known is None:
            if len(self.kept) >= 1 << 20:
                self.kept.clear()
                self.alike.clear()
            below = self.below[node]
            if below is None or before is None:
                known = before
            else:
                allowed = tuple(self._may_follow(before, t) for t in below)
                known = any(allowed) and self.alike.setdefault((node, allowed), before)
            self.kept[key] = known
        return known

    def _compile(self, index):
        """One transition: state and byte to the next state and the change of the count."""
        state, byte = divmod(int(index), BYTES)
        grown, last, change = [], None, None
        for node, before, count in self.states[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            token = self.token[child]
            if token is not None and last is None and self._may_follow(before, token):
                last, change = token, count + 1
            if self.children[child]:
                kept = self._place(child, before)
                if kept is not False:
                    grown.append((child, kept, count))
        if last is None:
            raise ValueError("no token ends here")
        key = (*[(child, before, count - change) for child, before, count in grown], (0, last, 0))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            if to * BYTES >= len(self.table):
                self.table = np.concatenate([self.table, np.full(len(self.table), -1, np.int32)])
        if not -_LOW <= change < _LOW:
            raise ValueError("change of count out of range")
        self.table[index] = to * BYTES + change + _LOW

    def _step(self, states, letters):
        at = states * BYTES + letters
        packed = self.table[at]
        if packed.min(initial=0) < 0:
            for index in np.unique(at[packed < 0]):
                self._compile(index)
            packed = self.table[at]
        return packed >> 8, (packed & 255) - _LOW

    def run(self, data, starts, lengths, states):
        """Change of the count and last state of every lane, lanes given by start, length and first state."""
        order = np.argsort(-lengths, kind="stable")
        starts, lengths, states = starts[order], lengths[order], states[order].astype(np.int64)
        totals = np.zeros(len(order), np.int64)
        longest = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(longest), "left")
        for k in range(longest):
            m = active[k]
            states[:m], change = self._step(states[:m], data[starts[:m] + k])
            totals[:m] += change
        counts, ends = np.empty_like(totals), np.empty_like(states)
        counts[order], ends[order] = totals, states
        return counts, ends

    def count_pieces(self, data, starts, lengths, entry=None):
        """Tokens of each piece (byte ranges), and the last state; ``entry``: state before the first piece, else the start."""
        if len(self.states) > self.max_states:
            held = None if entry is None else self.states[entry]
            self._empty()
            if held is not None and held != self.states[0]:
                self.states.append(held)
                self.number[held], entry = 1, 1
        first = np.zeros(len(starts), np.int64)
        if entry is not None and len(first):
            first[0] = entry
        counts, ends = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        short = lengths <= LANE
        counts[short], ends[short] = self.run(data, starts[short], lengths[short], first[short])
        long = np.flatnonzero(~short)
        if len(long):
            self._count_long(data, starts, lengths, first, long, counts, ends)
        return counts, (int(ends[-1]) if len(ends) else entry)

    def _count_long(self, data, starts, lengths, first, long, counts, ends):
        """Pieces in chunks: entry states are guessed from the bytes before, all chunks run side by side, and the chunks whose
        entry was another state than the chunk before gives are run again, in order."""
        chunks = -(-lengths[long] // LANE)
        piece = np.repeat(long, chunks)
        begin = starts[piece] + (np.arange(len(piece)) - np.repeat(np.cumsum(chunks) - chunks, chunks)) * LANE
        size = np.minimum(LANE, starts[piece] + lengths[piece] - begin)
        is_first = begin == starts[piece]
        _, guess = self.run(data, begin - np.where(is_first, 0, LOOK_BACK), np.where(is_first, 0, LOOK_BACK), np.zeros(len(piece), np.int64))
        guess[is_first] = first[piece[is_first]]
        count, end = self.run(data, begin, size, guess)
        np.add.at(counts, piece, count)
        ends[piece] = end  # the last chunk of a piece is written last
        wrong = np.flatnonzero(~is_first & (guess != np.concatenate([[0], end[:-1]])))
        fixed = -1
        for i in wrong:
            while i > fixed and not is_first[i] and guess[i] != end[i - 1]:
                guess[i] = end[i - 1]
                again, state = self.run(data, begin[i:i + 1], size[i:i + 1], guess[i:i + 1])
                counts[piece[i]] += again[0] - count[i]
                count[i], end[i] = again[0], state[0]
                fixed = i
                if i + 1 == len(piece):
                    break
                i += 1
        ends[piece] = end

    def char_classes(self, data, at):
        """Class of the character that begins at each of the places ``at`` of ``data`` (four more bytes behind the last)."""
        lead = data[at]
        out = self.classes[lead & 127]
        wide = np.flatnonzero(lead >= 128)
        if len(wide):
            a, (b, c, d) = lead[wide].astype(np.int64), (data[at[wide] + i].astype(np.int64) & 63 for i in (1, 2, 3))
            point = np.where(a < 0xE0, (a & 31) << 6 | b, np.where(a < 0xF0, (a & 15) << 12 | b << 6 | c, (a & 7) << 18 | b << 12 | c << 6 | d))
            point = np.minimum(point, 0x10FFFF)
            found = self.classes[point]
            new = np.unique(point[found == UNKNOWN])
            if len(new):
                self._probe(new.tolist())
                found = self.classes[point]
            out[wide] = found
        return out

    def count(self, data, offsets, window=1 << 20):
        """Tokens per text; texts as bytes and offsets. A text longer than ``window`` bytes is read window by window."""
        n, window = len(offsets) - 1, max(window, 64)  # a short form and its neighbours fit into a window
        specials = np.zeros(n, np.int64)
        owner = np.arange(n)
        raw = data.tobytes()
        cuts = [m.span() for m in self.special.finditer(raw)] if self.special else []
        if cuts:
            spans = np.array(cuts)
            text = np.searchsorted(offsets, spans[:, 0], "right") - 1
            inside = spans[:, 1] <= offsets[text + 1]
            if not inside.all():  # found across two texts: look in each text alone
                spans = np.array([(m.start() + a, m.end() + a) for a, b in zip(offsets, offsets[1:]) for m in self.special.finditer(raw[a:b])]).reshape(-1, 2)
                text = np.searchsorted(offsets, spans[:, 0], "right") - 1
            specials = np.bincount(text, minlength=n)
            first = np.sort(np.concatenate([offsets[:-1], spans[:, 1]]))
            last = np.sort(np.concatenate([offsets[1:], spans[:, 0]]))
            owner = np.sort(np.concatenate([owner, text]))
        else:
            first, last = offsets[:-1], offsets[1:]
        data = np.concatenate([data, np.zeros(4, np.uint8)])
        total = specials.astype(np.int64)
        small = last - first <= window
        group = np.flatnonzero(small)
        held = np.cumsum(np.concatenate([[0], (last - first)[group]]))
        i = 0
        while i < len(group):
            j = max(i + 1, int(np.searchsorted(held, held[i] + window, "right")) - 1)
            some = group[i:j]
            np.add.at(total, owner[some], self._count_segments(data, first[some], last[some]))
            i = j
        for s in np.flatnonzero(~small):
            total[owner[s]] += self._count_window_wise(data, int(first[s]), int(last[s]), window)
        return total

    def _count_segments(self, data, first, last):
        """Tokens of short segments, cut together: an END follows each."""
        lengths = last - first
        at = np.repeat(first, lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        owner = np.repeat(np.arange(len(first)), lengths)
        lead = (data[at] & 0xC0) != 0x80
        at, owner = at[lead], owner[lead]
        stops = np.searchsorted(owner, np.arange(len(first)), "right")
        classes = np.insert(self.char_classes(data, at), stops, C_END)
        at, owner = np.insert(at, stops, last), np.insert(owner, stops, np.arange(len(first)))
        begins, _ = piece_marks(classes)
        p = np.flatnonzero(begins)
        start, length = at[p], np.diff(np.append(at[p], at[-1] if len(at) else 0))
        real = classes[p] != C_END
        counts, _ = self.count_pieces(data, start[real], length[real])
        return np.bincount(owner[p][real], counts, len(first)).astype(np.int64)

    def _count_window_wise(self, data, first, last, window):
        """Tokens of one long segment. A window starts at a piece, or inside one that fills more than a window."""
        total, at, state, entry = 0, first, START, None
        while at < last:
            stop = min(at + window, last)
            while stop < last and data[stop] & 0xC0 == 0x80:
                stop += 1
            chars = at + np.flatnonzero((data[at:stop] & 0xC0) != 0x80)
            classes = self.char_classes(data, chars)
            if stop == last:
                classes, chars = np.append(classes, np.uint8(C_END)), np.append(chars, last)
            begins, after = piece_marks(classes, state)
            p = chars[np.flatnonzero(begins)]
            if stop == last:
                edges = np.concatenate([[at], p[p > at]])
            elif len(p) and p[-1] > at:  # the last piece may go on: the next window starts with it
                edges, stop, state = np.concatenate([[at], p[p > at]]), int(p[-1]), START
            else:  # one piece goes on through the window; of white characters the last may belong to the next piece
                if after in (SPACES, WHITES):
                    stop, after = int(chars[-1]), WHITES
                edges, state = np.array([at, stop]), after
            counts, end = self.count_pieces(data, edges[:-1], np.diff(edges), entry)
            total += int(counts.sum())
            entry = end if state != START else None
            at = stop
        return total


@functools.lru_cache(maxsize=2)
def transducer(path):
    """One machine per worker, so that its table serves all tasks of the worker."""
    return Transducer(path)
