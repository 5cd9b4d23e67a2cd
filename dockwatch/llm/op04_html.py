"""Main text of HTML pages by a recurrent block labeller.

Every page becomes the sequence of its text blocks. A block is described by a hashed vector of its element path (tags, class, id
and role words), a hashed vector of its words and a few counts. A bidirectional LSTM in numpy reads the whole sequence and
labels every block as main text or not, so a label can depend on the whole page.

No page comes labelled, so the labeller is taught at run time from a bounded sample of the pages themselves (TRAIN_PAGES): plain
element semantics label their blocks, and the sample's blocks are set again into page layouts with known labels, among them
parts that the sample may lack (sidebars, notices, forms, comments, articles in plain or misleadingly named containers, figures).
"""

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.common import hashed_sample, lean, materialise
from dockwatch.llm.html_blocks import Paths, blocks
from dockwatch.llm.textscan import mix, span_hashes, words

#: Pages that teach, layouts made of them, and blocks of a page used in teaching: a third each from its head, middle and end. All
#: blocks of all pages are labelled later. A page of any length may teach; of a block that teaches, a layout takes LAYOUT_CHARS.
TRAIN_PAGES = 160
LAYOUTS = 640
TRAIN_BLOCKS = 80
#: How often the pages themselves are shown for each showing of the layouts.
REPEATS = 3
LAYOUT_CHARS = 2000
PATH_SLOTS, WORD_SLOTS, COUNTS = 96, 32, 7
INPUTS = PATH_SLOTS + WORD_SLOTS + COUNTS
HIDDEN = 20
EPOCHS = 14
#: Cells (pages x longest page) that are labelled at once.
CELLS = 8192
#: How often layouts hold plain elements whose names say nothing.
PLAIN = 1.0

OUTSIDE_TAGS = frozenset("nav header footer aside form button menu dialog fieldset".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe signup sidebar side menu nav navbar navigation breadcrumb breadcrumbs toolbar header masthead footer contentinfo complementary "
    "share sharing social related recommended comment comments reply replies respond disqus discussion widget login register search form legal copyright "
    "copy pagination pager tags skip dialog paywall feedback".split())
INSIDE_TAGS = ("article", "main")


def _around(paths, found):
    """All paths of the blocks ``found`` and of the elements around them, parents first."""
    seen = set()
    for path, _, _ in found:
        while path > 0 and path not in seen:
            seen.add(path)
            path = paths.parts[path][0]
    return sorted(seen)


def marks(paths, order, spared=frozenset()):
    """Per path of ``order`` the number of elements that put it outside the main text; names of spared elements do not count.

    A header inside an article counts only where no title stands between it and the path.
    """
    state = {0: (0, 0, False)}  # elements, headers that a title would make harmless, inside an article
    for path in order:
        parent, tag, names = paths.parts[path]
        n, headers, inside = state[parent]
        inside = inside or tag in INSIDE_TAGS
        if tag in ("h1", "h2"):
            headers = 0
        if tag == "header" and inside:
            headers += 1
        elif tag in OUTSIDE_TAGS or (path not in spared and tag not in ("body", "html", "article", "main") and OUTSIDE_NAMES.intersection(names)):
            n += 1
        state[path] = n, headers, inside
    return {path: n + headers for path, (n, headers, _) in state.items()}


def main_blocks(page, paths):
    """Main text or not of every block of a page, by the elements around it.

    Names such as ``has-sidebar`` or ``body-copy`` do not count on an element that holds the page's article or more than half of
    its text (without an article: of the text of the page). An article inside such elements counts as the page's if it
    has as much text as all that would be main without it, so that teasers in a sidebar do not.
    """
    order = _around(paths, page)
    plain, held = marks(paths, order), dict.fromkeys([0, *order], 0)
    for path, text, _ in page:
        held[path] += len(text)
    for path in reversed(order):
        held[paths.parts[path][0]] += held[path]
    free = sum(len(text) for path, text, _ in page if not plain[path])
    articles = sorted((plain[at], -held[at], at) for at in order if paths.parts[at][1] in INSIDE_TAGS)
    every, spared, article = sum(len(text) for _, text, _ in page), set(), None
    if articles and (articles[0][0] == 0 or -articles[0][1] >= free):
        article = at = articles[0][2]
        every = held[article]
        while at > 0:
            spared.add(at)
            at = paths.parts[at][0]
    within = {0: False}
    for at in order:
        within[at] = at == article or within[paths.parts[at][0]]
        if 2 * held[at] > every and (not articles or within[at]):
            spared.add(at)
    outside = marks(paths, order, spared)
    return [not outside[path] for path, _, _ in page]


def _hashed(token: str):
    raw = np.frombuffer(token.encode(), np.uint8)
    h = int(span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])
    return [(((h >> (16 * i)) & 0xFFFF) % PATH_SLOTS, 1.0 if (h >> (48 + i)) & 1 else -1.0) for i in range(3)]


class Describer:
    """Input vectors of the blocks of many pages."""

    def __init__(self):
        self.paths, self._vectors, self._slots = Paths(), {0: np.zeros(PATH_SLOTS, np.float32)}, {}

    def _add(self, vector, token):
        if token not in self._slots:
            self._slots[token] = _hashed(token)
        for slot, sign in self._slots[token]:
            vector[slot] += sign

    def path_vector(self, path):
        """Sum over the distinct words of the elements around; a path adds its fresh words to the sum of its parent."""
        todo = []
        while path not in self._vectors:
            todo.append(path)
            path = self.paths.parts[path][0]
        vector = self._vectors[path]
        for path in reversed(todo):
            vector = vector.copy()
            for token in self.paths.fresh[path]:
                self._add(vector, token)
            self._vectors[path] = vector
        vector = vector.copy()
        if path:
            self._add(vector, f"at:{self.paths.parts[path][1]}")
        return vector

    def pages(self, texts):
        """Blocks of each page, and the input rows of all blocks one page after the other."""
        found = [blocks(t, self.paths) if t else [] for t in texts]
        flat = [b for page in found for b in page]
        x = np.zeros((len(flat), INPUTS), np.float32)
        if flat:
            raw = [b[1].encode() for b in flat]
            offsets = np.cumsum([0, *map(len, raw)])
            data = np.frombuffer(b"".join(raw), np.uint8)
            starts, ends, first = words(data, offsets)
            n = np.diff(first)
            owner = np.repeat(np.arange(len(flat)), n)
            h = mix(span_hashes(data, starts, ends, lower=True))
            sign = np.where(h >> np.uint64(63), 1.0, -1.0)
            bag = np.bincount(owner * WORD_SLOTS + (h % np.uint64(WORD_SLOTS)).astype(np.int64), sign, len(flat) * WORD_SLOTS)
            x[:, PATH_SLOTS:PATH_SLOTS + WORD_SLOTS] = bag.reshape(len(flat), WORD_SLOTS) / np.sqrt(np.maximum(n, 1))[:, None]
            place = np.concatenate([np.arange(len(p)) / max(len(p) - 1, 1) for p in found if p])
            digits = np.concatenate([[0], np.cumsum((data >= 0x30) & (data <= 0x39))])
            marks = np.concatenate([[0], np.cumsum(np.isin(data, list(b".,;!?")))])
            size = np.maximum(np.diff(offsets), 1)
            for i, (path, text, linked) in enumerate(flat):
                x[i, :PATH_SLOTS] = self.path_vector(path)
                x[i, -1] = linked / len(text)
            x[:, -2] = np.log1p(size) / 5
            x[:, -3] = np.log1p(n) / 4
            x[:, -4] = np.diff(digits[offsets]) / size
            x[:, -5] = 10 * np.diff(marks[offsets]) / size
            x[:, -6] = place
            x[:, -7] = 1
        return found, x


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class BlockLabeller:
    """Bidirectional LSTM with one output per block, trained by Adam on full back-propagation through the sequence."""

    def __init__(self, seed=7):
        rng = np.random.default_rng(seed)
        self.w = {}
        for side in "fb":
            self.w["x" + side] = (rng.standard_normal((INPUTS, 4 * HIDDEN)) / np.sqrt(INPUTS)).astype(np.float32)
            self.w["h" + side] = (rng.standard_normal((HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1  # forget gate open at first
            self.w["c" + side] = bias
        self.w["o"] = (rng.standard_normal(2 * HIDDEN) / np.sqrt(2 * HIDDEN)).astype(np.float32)
        self.w["ob"] = np.zeros(1, np.float32)

    def _run(self, x, mask, side, keep):
        """States of one direction for ``x`` (pages, length, inputs); padded cells carry the state on unchanged."""
        pages, length, _ = x.shape
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out, saved = np.zeros((pages, length, HIDDEN), np.float32), []
        gates = x.reshape(-1, INPUTS) @ self.w["x" + side] + self.w["c" + side]
        gates = gates.reshape(pages, length, 4 * HIDDEN)
        for t in range(length) if side == "f" else range(length - 1, -1, -1):
            z = gates[:, t] + h @ self.w["h" + side]
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            fresh = f * c + i * g
            state = np.tanh(fresh)
            m = mask[:, t, None]
            if keep:
                saved.append((t, h, c, i, f, o, g, state, m))
            c = np.where(m, fresh, c)
            h = np.where(m, o * state, h)
            out[:, t] = h
        return out, saved

    def probabilities(self, x, mask, keep=False):
        forward, a = self._run(x, mask, "f", keep)
        backward, b = self._run(x, mask, "b", keep)
        both = np.concatenate([forward, backward], 2)
        return _sigmoid(both @ self.w["o"] + self.w["ob"][0]), both, (a, b)

    def _gradients(self, x, mask, goal):
        p, both, saved = self.probabilities(x, mask, keep=True)
        miss = (p - goal) * mask / max(mask.sum(), 1)
        grads = {"o": (both * miss[..., None]).sum((0, 1)), "ob": np.array([miss.sum()], np.float32)}
        into = miss[..., None] * self.w["o"]
        for n, side in enumerate("fb"):
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dwh = np.zeros_like(self.w["h" + side])
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            for t, h, c, i, f, o, g, state, m in reversed(saved[n]):
                dh = dh + into[:, t, n * HIDDEN:(n + 1) * HIDDEN]
                active = dh * m
                dfresh = dc * m + active * o * (1 - state**2)
                dz = np.concatenate([dfresh * g * i * (1 - i), dfresh * c * f * (1 - f), active * state * o * (1 - o), dfresh * i * (1 - g**2)], 1)
                dz_all[:, t] = dz
                dwh += h.T @ dz
                dh = dz @ self.w["h" + side].T + dh * ~m
                dc = dfresh * f + dc * ~m
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            grads |= {"x" + side: x.reshape(-1, INPUTS).T @ flat, "h" + side: dwh, "c" + side: flat.sum(0)}
        return grads

    def fit(self, sequences, epochs=EPOCHS, batch=32, rate=0.01, seed=3):
        """``sequences``: (inputs, labels) per page."""
        rng = np.random.default_rng(seed)
        mean, spread = {k: 0 for k in self.w}, {k: 0 for k in self.w}
        step = 0
        by_length = sorted((s for s in sequences if len(s[1])), key=lambda s: len(s[1]))
        groups = [by_length[i:i + batch] for i in range(0, len(by_length), batch)]
        for epoch in range(epochs):
            for k in rng.permutation(len(groups)):
                x, mask = padded([s[0] for s in groups[k]])
                goal = np.zeros(mask.shape, np.float32)
                for i, s in enumerate(groups[k]):
                    goal[i, :len(s[1])] = s[1]
                step += 1
                for name, grad in self._gradients(x, mask, goal).items():
                    grad = np.clip(grad, -1, 1)
                    mean[name] = 0.9 * mean[name] + 0.1 * grad
                    spread[name] = 0.999 * spread[name] + 0.001 * grad**2
                    pace = rate * (1 - 0.9 * epoch / epochs)
                    self.w[name] = (self.w[name] - pace * (mean[name] / (1 - 0.9**step)) / (np.sqrt(spread[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def label(self, sequences):
        """Main text or not, for every block of every page."""
        out = [np.zeros(len(s), bool) for s in sequences]
        order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: len(sequences[i]))
        while order:
            longest, take = 0, 0
            while take < len(order) and (take == 0 or (take + 1) * len(sequences[order[take]]) <= CELLS):
                longest = len(sequences[order[take]])
                take += 1
            group, order = order[:take], order[take:]
            x, mask = padded([sequences[i] for i in group])
            p = self.probabilities(x, mask)[0]
            for row, i in enumerate(group):
                out[i] = p[row, :len(sequences[i])] > 0.5
        return out


def padded(sequences):
    length = max(len(s) for s in sequences)
    x, mask = np.zeros((len(sequences), length, INPUTS), np.float32), np.zeros((len(sequences), length), bool)
    for i, s in enumerate(sequences):
        x[i, :len(s)], mask[i, :len(s)] = s, True
    return x, mask


# layouts that teach: (start, end) of containers and kinds of other parts
_HOLDERS = [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="post">', "</div>"), ("<div>", "</div>"),
            ('<section class="entry">', "</section>"), ("<main><article>", "</article></main>"), ('<div class="story body">', "</div>"), ("", "")]
_LISTS = [("<nav><ul>", "</ul></nav>"), ('<ul class="menu">', "</ul>"), ('<div class="breadcrumbs"><ul>', "</ul></div>"), ('<aside><ul>', "</ul></aside>"),
          ('<div class="related"><ul>', "</ul></div>"), ('<div role="navigation"><ul>', "</ul></div>")]
_PARTS = [("<header><p>", "</p></header>"), ("<footer>", "</footer>"), ("<aside><p>", "</p></aside>"), ("<form><label>", "</label></form>"), ("<form><p>", "</p><button>Go</button></form>")]
#: Plain elements whose names say nothing, for bars, endings and holders.
_PLAIN = [('<div class="{}">', "</div>"), ('<div id="{}">', "</div>"), ("<div>", "</div>"), ('<section class="{} {}">', "</section>"), ('<p class="{}">', "</p>")]
_ENDINGS = ("© {} {}", "Copyright {} {}. All rights reserved.", "{1}, {0}", "© {1} {0} - {1}", "{1} (c) {0}")
#: Classes of wrappers around main text and other parts; figures are main text.
_WRAPPERS = ("has-{}", "with-{}", "{}-fixed", "{}-layout", "body-{}", "page {}")
_FIGURES = [("<figure><figcaption>", "</figcaption></figure>"), ("<figure><pre>", "</pre></figure>"), ("<figure><table><tr><td>", "</td></tr></table></figure>"), ("<figure><img src=x><p>", "</p></figure>")]


def layouts(pages, count, seed=13):
    """Pages with known labels from the blocks of given pages: (html, labels of its blocks)."""
    rng = random.Random(seed)
    inside = [[text for text, main in page if main] for page in pages]
    inside = [p for p in inside if p]
    if not inside:
        return
    other = [text for page in pages for text, main in page if not main] or [p[0] for p in inside]
    names = sorted(OUTSIDE_NAMES)
    escape = (lambda t: t.replace("&", "&amp;").replace("<", "&lt;"))
    for _ in range(count):
        made, labels = [], []

        def name():
            return "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(1, 3)))

        def nameless(texts):
            """A bar of short links or an ending, in elements that do not tell what they are."""
            start, end = rng.choice(_PLAIN)
            start = start.format(name(), name())
            short = [w for t in texts for w in t.split()[:2]][:8] or ["Home"]
            if rng.random() < 0.5 or start.startswith("<p"):
                line = rng.choice(_ENDINGS).format(rng.randint(1995, 2030), " ".join(short[:3]))
                made.append(start + (escape(line) if start.startswith("<p") else f"<p>{escape(line)}</p>") + end)
                labels.append(0)
            elif rng.random() < 0.5:
                made.append(start + "".join(f'<p><a href="/{w}">{escape(w)}</a></p>' for w in short) + end)
                labels.extend([0] * len(short))
            else:
                made.append(start + " | ".join(f'<a href="/{w}">{escape(w)}</a>' for w in short) + end)
                labels.append(0)

        def part(within=False):
            texts = [rng.choice(rng.choice(inside)) if rng.random() < 0.3 else rng.choice(other) for _ in range(rng.randint(1, 4))]
            kind = rng.random()
            if kind < 0.12 * PLAIN and not within:
                nameless(texts)
            elif kind < 0.3:
                start, end = rng.choice(_LISTS)
                items = [w for t in texts for w in t.split()[:3]][:6] or ["Home"]
                made.append(start + "".join(f'<li><a href="/{n}">{escape(w)}</a></li>' for n, w in enumerate(items)) + end)
                labels.extend([0] * len(items))
            elif kind < 0.5:
                start, end = rng.choice(_PARTS)
                made.append(start + escape(texts[0]) + end)
                labels.extend([0] * (2 if "<button>" in end else 1))
            else:
                where = f'{rng.choice(("class", "id", "class", "role"))}="{rng.choice(names)}{rng.choice(("", "-box", " wide", "-2"))}"'
                tag = rng.choice(("div", "section", "div", "ul" if rng.random() < 0.2 else "div"))
                inner = "li" if tag == "ul" else rng.choice(("p", "p", "div", "span"))
                texts = texts if inner != "span" else texts[:1]
                made.append(f"<{tag} {where}>" + "".join(f"<{inner}>{escape(t)}</{inner}>" for t in texts) + f"</{tag}>")
                labels.extend([0] * len(texts))

        for _ in range(rng.randint(0, 4)):
            part()
        wrapped = rng.random() < 0.2
        if wrapped:
            start, end = rng.choice(_HOLDERS[:-1])
            made.append(f'<div class="{rng.choice(_WRAPPERS).format(rng.choice(names))}">')
            if rng.random() < 0.5:
                part()
        else:
            start, end = rng.choice(_HOLDERS)
            if rng.random() < 0.25 * PLAIN:
                start, end = rng.choice(_PLAIN[:-1])
                start = start.format(name(), name())
        made.append(start)
        body = rng.choice(inside)[:rng.randint(1, 30)]
        for n, text in enumerate(body):
            tag = "h1" if n == 0 and rng.random() < 0.6 else rng.choice(("p", "p", "p", "p", "h2", "blockquote", "li", "pre")) if rng.random() < 0.3 else "p"
            before, after = rng.choice(_FIGURES) if rng.random() < 0.05 else (f"<{tag}>", f"</{tag}>")
            made.append(before + escape(text) + after)
            labels.append(1)
            if rng.random() < 0.05:
                part(within=True)
        if rng.random() < 0.15:
            part(within=True)
        made.append(end)
        if wrapped:
            if rng.random() < 0.5:
                part()
            made.append("</div>")
        for _ in range(rng.randint(0, 4)):
            part()
        if rng.random() < 0.3 * PLAIN:
            nameless([rng.choice(other)])
        yield "<html><body>" + "".join(made) + "</body></html>", labels


def chosen(n):
    """Places of the blocks of a page of ``n`` blocks that teach: all, or as many from its head, middle and end."""
    if n <= TRAIN_BLOCKS:
        return np.arange(n)
    part = TRAIN_BLOCKS // 3
    middle = (n - part) // 2
    return np.concatenate([np.arange(part), np.arange(middle, middle + part), np.arange(n - (TRAIN_BLOCKS - 2 * part), n)])


def lesson(page: str, describer: Describer):
    """What a page teaches: inputs, labels and texts of some of its blocks."""
    (found,), x = describer.pages([page])
    main, at = main_blocks(found, describer.paths), chosen(len(found))
    return x[at], np.array([main[i] for i in at], bool), [found[i][1][:LAYOUT_CHARS] for i in at]


def teach(pages) -> BlockLabeller:
    """Labeller from the html of some pages."""
    describer = Describer()
    return teach_lessons([lesson(page, describer) for page in pages])


def teach_lessons(lessons) -> BlockLabeller:
    sequences = [(x, main.astype(float)) for x, main, _ in lessons] * REPEATS
    made = list(layouts([list(zip(texts, main.tolist())) for _, main, texts in lessons], LAYOUTS))
    _, x = Describer().pages([page for page, _ in made])
    at = 0
    for page, labels in made:
        sequences.append((x[at:at + len(labels)][chosen(len(labels))], np.array(labels, float)[chosen(len(labels))]))
        at += len(labels)
    if at != len(x):
        raise ValueError("a layout has other blocks than labels")
    return BlockLabeller().fit(sequences)


LESSON = "id {}, x array<float>, main array<boolean>, texts array<string>"


def lessons_of(pages: DataFrame):
    """Lessons of the pages ``id, html``, made by tasks; what reaches the driver is bounded per page."""
    def run(batches):
        describer = Describer()
        for batch in batches:
            for page_id, page in zip(batch.column(0), batch.column(1).to_pylist()):
                x, main, texts = lesson(page, describer)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([page_id.as_py()], batch.column(0).type), pa.array([x.ravel().tolist()], pa.list_(pa.float32())), pa.array([main.tolist()], pa.list_(pa.bool_())),
                     pa.array([texts], pa.list_(pa.string()))], ["id", "x", "main", "texts"])

    made = pages.mapInArrow(lean(run), LESSON.format(pages.schema["id"].dataType.simpleString()))
    return [(np.array(r["x"], np.float32).reshape(-1, INPUTS), np.array(r["main"], bool), r["texts"]) for r in made.orderBy("id").toArrow().to_pylist()]


def extract_main_text(df: DataFrame, id_col="page_id", url_col="url", html_col="html", train_pages=TRAIN_PAGES) -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page of ``df``: its main blocks in page order, joined by a newline.

    Character references are decoded, white space inside a block is one space, and nothing is cut. A null or empty page and
    one without main text give an empty text; hostile markup takes time linear in its length. Ids and urls may be null and rows repeated; other columns are ignored; an
    empty table gives an empty result (and nothing to learn from: then no block is main text).
    """
    given = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    picked = materialise(hashed_sample(given.select("id").where("id is not null").distinct(), "id", train_pages), "known")
    taught = given.where(F.length("html") > 0).join(F.broadcast(picked), "id").groupBy("id").agg(F.min("html").alias("html"))
    labeller = teach_lessons(lessons_of(taught))

    def run(batches):
        describer = Describer()
        for batch in batches:
            for a, b in page_slices(batch.column(2)):
                part = batch.slice(a, b - a)
                found, x = describer.pages(part.column(2).to_pylist())
                ends = np.cumsum([0, *map(len, found)])
                labels = labeller.label([x[p:q] for p, q in zip(ends, ends[1:])])
                texts = ["\n".join(text for (_, text, _), main in zip(page, keep) if main) for page, keep in zip(found, labels)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])
                if len(describer.paths.parts) > 100_000:
                    describer = Describer()

    kinds = {f.name: f.dataType.simpleString() for f in given.schema}
    out = given.mapInArrow(lean(run), f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")


def page_slices(column, limit=1 << 20):
    """Ranges of pages of about ``limit`` characters."""
    start, held = 0, 0
    for i, size in enumerate(pa.compute.utf8_length(column).to_pylist()):
        if held and held + (size or 0) > limit:
            yield start, i
            start, held = i, 0
        held += size or 0
    if len(column):
        yield start, len(column)
