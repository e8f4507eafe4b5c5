"""Scoring texts with a gated recurrent language model.

Tokens are words (``ascii_words``) and one end per text.  The model is a gated recurrent
unit that reads a text from its start to its end; its state is carried from window to
window, so the score of a document is the log-likelihood of the whole document.

*Output.*  The softmax is factored by classes: ``P(word) = P(class | state) * P(word |
class, state)``.  The most frequent words are cut into classes of about equal counts, and
inside those the second factor is a softmax over the class.  All other words fall into
classes by their last two bytes, known or not; inside those the second factor is
``(c + 0.1) / Z`` with the word's training count ``c`` and the class's total ``Z``, where
all unknown words share one 0.1.  So every word has a probability, and a class's words and
its unknown share sum to one.

*Training.*  Truncated backpropagation in numpy over every token of every training
document, in ``ROUNDS`` rounds.  A round takes the documents whose hash is its turn.  Each
task starts from the shared weights, reads its documents as parallel streams in windows of
``WINDOW`` tokens (the state starts anew at each document, as in scoring) and hands back its
weights; their average by tokens, merged 8 at a time, is what the next round starts from.
So the training grows with the corpus, no task holds more than a block of tokens, and the
driver holds one set of weights.  Output biases start at the log counts: a model that has
seen little is no worse than counting.

*Lots.*  Texts are turned into words once: a row of ``text_lots`` has some texts of the same
round as the hashes of their words and, two bytes for most tokens, the place of each token
among them.  Counting, training and scoring read these rows, and look up each word of a lot
once, not each token.

*Counts* cover every training document: tasks add up per lot, and a shuffle by word
hash sums them.  Words counted often enough (at most ``LISTED``, found from the histogram
of counts, on a log scale) travel to the tasks as a sorted list of hashes; the other words of a document
are joined with the table of counts.
"""

from __future__ import annotations

import copy
import itertools
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.llm.common import WordHasher, merged_states, mix64, text_chunks
from siltgate.sources import staging_dir, written

SHORT_WORDS = 1500
SHORT_CLASSES = 32
TAIL_CLASSES = 48
LISTED = 400_000
HIDDEN = 24
WINDOW = 32
#: Streams of a block of tokens: at most so many, and fewer where that leaves less updates.
STREAMS, UPDATES = 256, 100
#: Rows of a softmax at a time: they stay in the processor's cache.
ROWS = 2048
#: Tokens that a task trains on at a time.
BLOCK_TOKENS = 2_000_000
#: Bytes of text of a lot.
LOT_BYTES = 2_000_000
#: There is a range of hashes to add up for every so many lots.
LOTS_COUNTED = 25
#: Tokens that a task scores, and at most twice as many side by side: the few long documents
#: of a larger number are read beside more others.
SCORED_TOKENS = 7_000_000
ROUNDS = 4
RATE = 0.01
SMOOTHING = 0.1
#: The end of a text, as a word hash no other word is likely to have.
END = np.int64(-0x5E5E5E5E5E5E5E5E)
_LN10 = float(np.log(10.0))
_LOG2E = float(np.log2(np.e))
#: Added to a small float32, it leaves the nearest whole number in the last bits.
_ROUND = np.float32(1.5 * 2**23)
#: ``2 ** x`` from -1/2 to 1/2, highest power first.
_POWERS = (np.float32(0.00957009673), np.float32(0.0559178599), np.float32(0.24024745), np.float32(0.693121815), np.float32(0.999999261))


@dataclass(frozen=True)
class Vocabulary:
    """What tasks need to turn words into classes and counts."""

    hashes: np.ndarray  # of the listed words, sorted
    counts: np.ndarray  # aligned with hashes
    short: np.ndarray  # place among the short-listed words, -1 for the others
    class_of: np.ndarray  # of each short-listed word
    class_start: np.ndarray  # short-listed words of class c: [c] to [c + 1]
    tail_total: np.ndarray  # Z of each tail class
    tokens: int  # N
    words: int  # V

    @property
    def n_short(self) -> int:
        return len(self.class_of)

    @property
    def n_classes(self) -> int:
        return len(self.class_start) - 1 + len(self.tail_total)

    @property
    def base_total(self) -> float:
        return self.tokens + SMOOTHING * (self.words + 1)


_TAIL_CLASS = (mix64(np.arange(1 << 16)) % np.uint64(TAIL_CLASSES)).astype(np.int32)


def tail_class(tails: np.ndarray) -> np.ndarray:
    return _TAIL_CLASS.take(tails)


def _tokens(texts: list, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and tail class of every token, ends included, and tokens per text."""
    words, tails, counts = hasher(texts)
    ends = np.cumsum(counts)
    hashes = np.insert(words.view(np.int64), ends, END)
    classes = np.insert(tail_class(tails), ends, 0)
    return hashes, classes, counts + 1


def text_lots(texts: DataFrame) -> DataFrame:
    """``texts`` (doc_id, text, turn, scored) as rows of several texts of one turn.

    ``words`` has the hashes in a lot, sorted, ``tails`` and ``counts`` what belongs to each;
    ``places`` has the place there of every token and ``sizes`` the tokens of each text.  A
    missing id is 0 in ``ids`` and true in ``no_id``; ``tokens`` is the sum of ``sizes``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for chunk in text_chunks(batches, most=4 * LOT_BYTES):
            for (turn, scored), some in chunk.groupby(["turn", "scored"], sort=False):
                for lot in text_chunks(iter([some]), most=LOT_BYTES):
                    h, tail, sizes = _tokens(lot["text"].tolist(), hasher)
                    words, counts = np.unique(h, return_counts=True)
                    places = Lookup(words)(h)
                    tails = np.empty(len(words), np.uint8)
                    tails[places] = tail  # the same wherever a word occurs
                    arrays = {
                        "ids": lot["id"].to_numpy(np.int64),
                        "no_id": lot["no_id"].to_numpy(bool),
                        "sizes": sizes.astype(np.int64),
                        "words": words,
                        "tails": tails,
                        "counts": counts.astype(np.uint32),
                        "places": places.astype(np.uint16 if len(words) <= 1 << 16 else np.uint32),
                    }
                    columns = {n: [a.tobytes()] for n, a in arrays.items()}
                    yield pd.DataFrame({"turn": [turn], "scored": [scored], "tokens": [len(h)], **columns})

    doc_id = F.col("doc_id").cast("long")
    return texts.select(
        F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("no_id"),
        F.col("text").cast("binary"), "turn", "scored",  # not decoded only to be encoded again
    ).mapInPandas(
        run,
        "turn int, scored boolean, tokens long, ids binary, no_id binary, sizes binary, words binary, "
        "tails binary, counts binary, places binary",
    )


def _words_of(lot) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(lot.words, np.int64), np.frombuffer(lot.tails, np.uint8).astype(np.int32)


def _places_of(lot) -> np.ndarray:
    """The place of each token among the words, as numpy takes them."""
    kind = np.uint16 if len(lot.places) == 2 * lot.tokens else np.uint32
    return np.frombuffer(lot.places, kind).astype(np.intp)


def word_counts(lots: DataFrame, ranges: int) -> DataFrame:
    """``h, tail, c``: tokens of all ``lots`` by word hash, added up in ``ranges`` of hashes."""
    bounds = np.linspace(-(2.0**63), 2.0**63, ranges + 1)[1:-1].astype(np.int64)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lot in batch.itertuples():
                cuts = np.searchsorted(np.frombuffer(lot.words, np.int64), bounds).tolist()
                edges = list(itertools.pairwise([0, *cuts, len(lot.tails)]))
                pieces = {
                    n: [bytes(memoryview(x)[k * start : k * end]) for start, end in edges]
                    for n, k, x in (("words", 8, lot.words), ("tails", 1, lot.tails), ("counts", 4, lot.counts))
                }
                yield pd.DataFrame({"part": range(ranges), **pieces})

    def add_up(pieces: pd.DataFrame) -> pd.DataFrame:
        h = np.frombuffer(b"".join(pieces["words"]), np.int64)
        c = np.frombuffer(b"".join(pieces["counts"]), np.uint32).astype(np.int64)
        order = np.argsort(h, kind="stable")
        h = h[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else order
        tail = np.frombuffer(b"".join(pieces["tails"]), np.uint8)[order[first]].astype(np.int32)
        total = np.add.reduceat(c[order], first) if len(h) else c
        return pd.DataFrame({"h": h[first], "tail": tail, "c": total})

    return (
        lots.select("words", "tails", "counts")
        .mapInPandas(cut, "part int, words binary, tails binary, counts binary")
        .groupBy("part")
        .applyInPandas(add_up, "h long, tail int, c long")
    )


def build_vocabulary(counts: DataFrame, listed: int = LISTED) -> tuple[Vocabulary, int]:
    """The vocabulary, and the smallest count of a listed word.

    Brings a histogram of counts (eight steps to each doubling), at most ``listed`` words
    and one sum per tail class to the driver.
    """
    histogram = sorted(
        counts.groupBy(F.floor(8 * F.log2("c")).alias("step"))
        .agg(F.count("*").alias("n"), F.sum("c").alias("c"), F.min("c").alias("least"))
        .collect(),
        reverse=True,
    )
    words, tokens = sum(r["n"] for r in histogram), sum(r["c"] for r in histogram)
    least, total = (histogram[0]["c"] + 1 if histogram else 1), 0
    for r in histogram:
        if total + r["n"] > listed:
            break
        least, total = r["least"], total + r["n"]
    top = counts.filter(F.col("c") >= least).toPandas().sort_values("h")
    h, c = top["h"].to_numpy(np.int64), top["c"].to_numpy(np.int64)
    order = np.lexsort((h, -c))[:SHORT_WORDS]
    # Classes of about equal counts: frequent words in small classes.
    mass = np.cumsum(c[order] ** 0.5)
    cuts = np.floor(SHORT_CLASSES * (mass - 1e-9) / mass[-1]) if len(order) else np.empty(0)
    class_of = np.unique(cuts, return_inverse=True)[1].astype(np.int32)
    n_short_classes = int(class_of.max()) + 1 if len(class_of) else 0
    short = np.full(len(h), -1, dtype=np.int32)
    short[order] = np.arange(len(order))
    tail_total = np.full(TAIL_CLASSES, SMOOTHING)
    for r in counts.groupBy("tail").agg(F.sum(F.col("c") + F.lit(SMOOTHING)).alias("z")).collect():
        tail_total[r["tail"]] += r["z"]
    tails = top["tail"].to_numpy()[order]
    np.subtract.at(tail_total, tails, c[order] + SMOOTHING)
    start = np.searchsorted(class_of, np.arange(n_short_classes + 1)).astype(np.int64)
    vocabulary = Vocabulary(h, c, short, class_of, start, tail_total, int(tokens), int(words))
    return vocabulary, int(least)


class Scratch(dict):
    """Arrays that are written over again and again, so that their pages are touched once."""

    def room(self, name: str, shape: tuple[int, ...], kind) -> np.ndarray:
        size = math.prod(shape)
        flat = self.get((name, kind))
        if flat is None or flat.size < size:
            flat = self[name, kind] = np.empty(size, kind)
        return flat[:size].reshape(shape)

    def __reduce__(self):
        return Scratch, ()


def _exp2(x: np.ndarray, scratch: Scratch) -> None:
    """``2 ** x`` in place, for ``x`` between -120 and 120.

    In float32 from whole steps over the array, which are cheaper than the library's
    function: a polynomial (off by 4e-6 at most) of what rounding leaves, and the whole
    part added to the exponent's bits.
    """
    if x.dtype != np.float32:
        np.exp2(x, out=x)
        return
    whole, y = (scratch.room(name, x.shape, x.dtype) for name in ("whole", "powers"))
    np.add(x, _ROUND, out=whole)  # its last bits hold the whole part
    np.subtract(whole, _ROUND, out=y)
    x -= y
    np.multiply(x, _POWERS[0], out=y)
    for c in _POWERS[1:-1]:
        y += c
        y *= x
    y += _POWERS[-1]
    bits = whole.view(np.int32)
    bits <<= 23
    np.add(y.view(np.int32), bits, out=x.view(np.int32))


class Model:
    """Weights of the unit and of the two softmaxes, all float32.

    The unit's weights are three parts: of the update gate, of the reset gate and of the
    content.  Gates are ``(1 + tanh(x / 2)) / 2``, the logistic function.  The last row of
    ``cw`` (classes) and ``ww`` (words) are biases: states get a one at their end for them.
    """

    NAMES = ("embed", "u", "cw", "ww")

    def __init__(self, vocabulary: Vocabulary, hidden: int = HIDDEN, seed: int = 7):
        draw = np.random.default_rng(seed)
        k = vocabulary.n_short + TAIL_CLASSES
        self.hidden, self.start = hidden, vocabulary.class_start
        self.n_short, self.scratch = vocabulary.n_short, Scratch()
        self.class_of = np.concatenate(
            (vocabulary.class_of, len(self.start) - 1 + np.arange(TAIL_CLASSES, dtype=np.int32))
        )
        normal = lambda *shape: (draw.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)
        parts = lambda w: np.ascontiguousarray(w.reshape(-1, 3, hidden).transpose(1, 0, 2))
        self.embed = parts(normal(k, 3 * hidden))  # input weights and biases of each symbol
        self.u = parts(normal(hidden, 3 * hidden))
        cw, ww = normal(hidden, vocabulary.n_classes), normal(hidden, max(self.n_short, 1))
        order = np.flatnonzero(vocabulary.short >= 0)
        counts = np.full(max(self.n_short, 1), SMOOTHING)
        counts[vocabulary.short[order]] += vocabulary.counts[order]
        totals = np.concatenate((np.bincount(vocabulary.class_of, counts[: self.n_short]), vocabulary.tail_total))
        wb, cb = (np.log(x / x.sum()).astype(np.float32) for x in (counts, totals))
        self.cw, self.ww = np.vstack((cw, cb)), np.vstack((ww, wb))

    def halved(self) -> tuple[np.ndarray, np.ndarray]:
        """``embed`` and ``u`` as ``move`` takes them, the gates' parts halved."""
        half = np.array([0.5, 0.5, 1], self.u.dtype)[:, None, None]
        return self.embed * half, self.u * half

    def step(self, symbols: np.ndarray, h: np.ndarray):
        """One step for a batch; also what the way back needs."""
        embed, u = self.halved()
        new, content = np.empty_like(h), np.empty_like(h)
        unit = np.empty((3, *h.shape), h.dtype)
        self.move(embed.take(symbols, axis=1), h, u, unit, content, new)
        return new, (*unit, content)

    @staticmethod
    def move(a: np.ndarray, h: np.ndarray, u: np.ndarray, unit: np.ndarray, content: np.ndarray, new: np.ndarray):
        """One step from ``h`` to ``new``; leaves both gates and the content's part in ``unit``."""
        np.matmul(h, u, out=unit)
        gates = unit[:2]
        gates += a[:2]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        np.multiply(unit[1], unit[2], out=content)
        content += a[2]
        np.tanh(content, out=content)
        np.subtract(h, content, out=new)
        new *= unit[0]
        new += content

    @property
    def weights(self) -> dict[str, np.ndarray]:
        return {n: getattr(self, n) for n in self.NAMES}

    def with_weights(self, weights: dict[str, np.ndarray]) -> Model:
        """The same model with its own copy of other weights."""
        other = copy.copy(self)
        for n in self.NAMES:
            setattr(other, n, weights[n].astype(np.float32))
        return other

    def output(self, h: np.ndarray, symbols: np.ndarray, grad: dict | None = None):
        """Natural log of P(class) and, for short-listed words, of P(word | class).

        With ``grad``, adds up the gradients of minus their sum and returns that for ``h``,
        which is written over by the next call.
        """
        (n, d), kind, room = h.shape, h.dtype, self.scratch.room
        k = self.class_of[symbols]
        # Small numbers are sorted by counting; tail classes come last and need no second softmax.
        order = np.argsort(k.astype(np.uint8 if self.cw.shape[1] < 256 else np.uint16), kind="stable")
        k, symbols = k[order], symbols[order]
        cuts = np.searchsorted(k, np.arange(len(self.start)))
        short = int(cuts[-1])
        one = room("one", (n, d + 1), kind)
        one[:, :d] = h.take(order, axis=0, out=room("taken", (n, d), kind), mode="clip")
        one[:, d] = 1
        logs, back = np.empty(n, kind), None if grad is None else room("sorted", h.shape, kind)
        tame, whole = self._is_tame(self.cw), np.array([0, self.cw.shape[1]])
        for at in range(0, n, ROWS):
            rows = slice(at, min(at + ROWS, n))
            logs[rows] = self._softmax(
                one[rows], np.array([0, rows.stop - at]), k[rows], self.cw, whole, tame,
                grad and (grad["cw"], back[rows]),
            )
        more = None if grad is None else room("more", (short, d), kind)
        logs[:short] += self._softmax(
            one[:short], cuts, symbols[:short] - self.start[k[:short]], self.ww, self.start,
            self._is_tame(self.ww), grad and (grad["ww"], more),
        )
        out = np.empty(n, kind)
        out[order] = logs
        if grad is None:
            return out, None
        back[:short] += more
        place = np.empty(n, np.intp)
        place[order] = np.arange(n)
        return out, back.take(place, axis=0, out=room("taken", (n, d), kind), mode="clip")

    def _softmax(
        self, h: np.ndarray, cuts: np.ndarray, places: np.ndarray, w: np.ndarray, start: np.ndarray,
        tame: bool, grad: tuple | None,
    ) -> np.ndarray:
        """Natural log of the share of each row's place in the softmax of its class.

        Rows ``cuts[c]`` to ``cuts[c + 1]`` are of class ``c``, whose weights are the columns
        ``start[c]`` to ``start[c + 1]`` of ``w``.  With ``grad`` (for ``w`` and ``h``) adds to
        the first and fills the second.
        """
        rows, columns = np.diff(cuts), np.diff(start)
        ends = np.cumsum(rows * columns)
        flat = self.scratch.room("logits", (int(ends[-1]) if len(ends) else 0,), h.dtype)
        classes = [
            (slice(*ab), slice(*cd), flat[end - n * m : end].reshape(n, m))
            for ab, cd, end, n, m in zip(
                itertools.pairwise(cuts.tolist()), itertools.pairwise(start.tolist()),
                ends.tolist(), rows.tolist(), columns.tolist(), strict=True,
            )
            if n
        ]
        mine = np.cumsum(np.repeat(columns, rows))
        mine -= np.repeat(columns, rows)
        mine += places
        binary = w * np.asarray(_LOG2E, w.dtype)
        for r, c, e in classes:
            np.matmul(h[r], binary[:, c], out=e)
            if not tame:
                e -= e.max(axis=1, keepdims=True)
                np.maximum(e, -100, out=e)
        logs = flat.take(mine) / np.asarray(_LOG2E, h.dtype)
        _exp2(flat, self.scratch)
        total = np.empty(len(h), h.dtype)
        ones = np.ones(columns.max(initial=0), h.dtype)
        for r, _, e in classes:
            np.matmul(e, ones[: e.shape[1]], out=total[r])
        logs -= np.log(total)
        if grad is not None:
            # Rows are divided by their totals where they are narrow.
            flat[mine] -= total
            total = np.reciprocal(total, out=total)[:, None]
            shared = np.multiply(h, total, out=self.scratch.room("shared", h.shape, h.dtype))
            of_w, of_h = grad
            back = w[:-1].T
            for r, c, e in classes:
                of_w[:, c] += shared[r].T @ e
                np.matmul(e, back[c], out=of_h[r])
            of_h *= total
        return logs

    def _is_tame(self, weights: np.ndarray) -> bool:
        """No logit can be so large or small that its exponential is not a float32: states
        lie between -1 and 1.  Else the largest of each row is taken away first."""
        return float(np.abs(weights).sum(axis=0).max()) < 60


def window_gradient(
    model: Model, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray, end: int = -1
):
    """Loss, gradients and last state of one window; ``inputs[t]`` is read before ``targets[t]``.

    The state starts anew where ``end`` is read, and no gradient passes there.
    """
    d, (steps, batch), kind = model.hidden, inputs.shape, model.u.dtype
    grad = {n: np.zeros_like(getattr(model, n)) for n in Model.NAMES if n not in ("u", "embed")}
    room = lambda name, *shape: model.scratch.room(name, (*shape, steps, batch, d), kind)
    fresh = [np.flatnonzero(row) for row in inputs == end]
    embed, u = model.halved()
    embedded = embed.take(inputs, axis=1, out=room("embedded", 3), mode="clip")
    before, content, unit = room("before"), room("content"), room("unit", 3)
    states = model.scratch.room("states", (steps + 1, batch, d), kind)
    states[0] = h
    for t in range(steps):
        before[t] = states[t]  # the state as this step finds it
        if len(fresh[t]):
            before[t, fresh[t]] = 0
        model.move(embedded[:, t], before[t], u, unit[:, t], content[t], states[t + 1])
    last = states[-1].copy()
    logs, back = model.output(states[1:].reshape(-1, d), targets.ravel(), grad)
    back = back.reshape(steps, batch, d)
    # What does not depend on the gradient from later steps, for all steps at once.
    z, r, inside = unit
    one_less = np.subtract(1, z, out=room("one_less"))
    to_z = np.subtract(before, content, out=room("to_z"))
    to_z *= z
    to_z *= one_less
    to_content = np.multiply(content, content, out=content)
    np.subtract(1, to_content, out=to_content)
    to_content *= one_less
    to_r = np.subtract(1, r, out=one_less)
    to_r *= r
    to_r *= inside
    inner = embedded  # its place: gradients as the recurrent weights see them
    carried, through = np.zeros((batch, d), kind), np.empty((3, batch, d), kind)
    ut = np.ascontiguousarray(model.u.transpose(0, 2, 1))
    for t in range(steps - 1, -1, -1):
        dh = back[t]
        dh += carried
        now = inner[:, t]
        np.multiply(dh, to_z[t], out=now[0])
        moved = to_content[t]
        moved *= dh  # of the new content, from here on
        np.multiply(moved, to_r[t], out=now[1])
        np.multiply(moved, r[t], out=now[2])
        np.matmul(now, ut, out=through)
        np.multiply(dh, z[t], out=carried)
        for part in through:
            carried += part
        if len(fresh[t]):
            carried[fresh[t]] = 0
    grad["u"] = before.reshape(-1, d).T @ inner.reshape(3, -1, d)
    inner[2] = to_content
    grad["embed"] = _sums_by_symbol(
        inputs.ravel(), inner.reshape(3, -1, d), np.zeros_like(model.embed), model.scratch
    )
    return -float(logs.sum()), grad, last


def _sums_by_symbol(
    symbols: np.ndarray, parts: np.ndarray, out: np.ndarray, scratch: Scratch
) -> np.ndarray:
    """Adds the rows of each of the ``parts`` up by symbol; equal ones are brought together first."""
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    symbols, kind = symbols[order], parts.dtype
    first = np.flatnonzero(np.diff(symbols, prepend=-1))
    rows = parts.take(order, axis=1, out=scratch.room("rows", parts.shape, kind), mode="clip")
    if rows.shape[2] % 2 == 0:  # as complex numbers two at a time
        rows = rows.view(np.result_type(kind, np.complex64))
    out[:, symbols[first]] = np.add.reduceat(rows, first, axis=1).view(kind)
    return out


class Trainer:
    """Adam on the mean loss of windows, over blocks of documents that come one by one."""

    def __init__(self, model: Model, end: int, rate: float = RATE):
        self.model, self.end, self.rate, self.updates, self.tokens = model, end, rate, 0, 0
        self.first = {n: np.zeros_like(w) for n, w in model.weights.items()}
        self.second = {n: np.zeros_like(w) for n, w in model.weights.items()}

    def read(self, symbols: np.ndarray) -> None:
        """Train on a run of documents, each with its end; every token is predicted once."""
        symbols = symbols.astype(np.int32)
        streams = int(min(STREAMS, max(1, len(symbols) // (WINDOW * UPDATES))))
        length = len(symbols) // streams
        whole = length * streams
        self._streams(symbols[:whole].reshape(streams, length).T)
        if whole < len(symbols):  # what equal streams leave over, as a short one of its own
            self._streams(symbols[whole:, None])

    def _streams(self, run: np.ndarray) -> None:
        run = np.ascontiguousarray(run)
        start = np.full((1, run.shape[1]), self.end, run.dtype)
        before = np.vstack((start, run[:-1]))
        h = np.zeros((run.shape[1], self.model.hidden), np.float32)
        for at in range(0, len(run), WINDOW):
            inputs, targets = before[at : at + WINDOW], run[at : at + WINDOW]
            _, grad, h = window_gradient(self.model, inputs, targets, h, self.end)
            self._update(grad, inputs.size)

    def _update(self, grad: dict[str, np.ndarray], tokens: int) -> None:
        """One step of Adam; ``first`` and ``second`` are kept 10 and 100 times as large."""
        self.updates += 1
        self.tokens += tokens
        k = self.updates
        weights = self.model.weights
        for n in grad:
            all_of = (grad[n], self.first[n], self.second[n], weights[n])
            # Part by part where there are three: those stay in the processor's cache.
            for arrays in zip(*all_of, strict=True) if grad[n].ndim == 3 else [all_of]:
                self._move(*arrays, k, tokens)

    def _move(self, g: np.ndarray, first: np.ndarray, second: np.ndarray, w: np.ndarray, k: int, tokens: int) -> None:
        g *= 1 / tokens
        first *= 0.9
        first += g
        g *= g
        second *= 0.99
        second += g
        size = np.sqrt(second, out=g)
        size *= 0.1 / np.sqrt(1 - 0.99**k)
        size += 1e-8
        moved = np.divide(first, size, out=size)
        moved *= 0.1 * self.rate / (1 - 0.9**k)
        w -= moved


def _averaged(one, two):
    """Two ``(tokens, weights)`` as one, weights averaged by tokens."""
    (n, a), (m, b) = one, two
    return n + m, {k: (n * a[k] + m * b[k]) / (n + m) for k in a}


def _end_symbol(vocabulary: Vocabulary) -> int:
    at = int(np.searchsorted(vocabulary.hashes, END))
    known = at < len(vocabulary.hashes) and vocabulary.hashes[at] == END
    return int(vocabulary.short[at]) if known and vocabulary.short[at] >= 0 else vocabulary.n_short


class Lookup:
    """Places of 64-bit hashes in a sorted list of distinct ones.

    Hashes are spread evenly, so their first bits say where to look but for a step or two.
    """

    def __init__(self, hashes: np.ndarray):
        self.bits = max(1, len(hashes).bit_length())
        self.hashes = np.append(hashes, np.iinfo(np.int64).max)
        sizes = np.bincount(self._start(hashes), minlength=1 << self.bits)
        self.first = np.concatenate(([0], np.cumsum(sizes)))

    def _start(self, h: np.ndarray) -> np.ndarray:
        return (h >> (64 - self.bits)) + (1 << (self.bits - 1))

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """The place of each, -1 for those that are not listed."""
        at = self.first[self._start(h)]
        found = self.hashes[at]
        late = np.flatnonzero(found < h)
        while len(late):
            at[late] += 1
            found[late] = self.hashes[at[late]]
            late = late[found[late] < h[late]]
        at[(found != h) | (at == len(self.hashes) - 1)] = -1
        return at


def symbols_of(
    vocabulary: Vocabulary, lookup: Lookup, h: np.ndarray, tails: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Symbol of each token (a short-listed word or a tail class) and its listed place or -1."""
    at = lookup(h)
    if not len(vocabulary.hashes):
        return tails.astype(np.int32), at
    short = np.where(at >= 0, vocabulary.short[at], -1)
    return np.where(short >= 0, short, vocabulary.n_short + tails).astype(np.int32), at


def document_logs(model: Model, end: int, documents: list[np.ndarray], rows: int = 65_536) -> np.ndarray:
    """Natural log-likelihood of each document's symbols, read from a fresh state to its end.

    Longer documents first, so that the ones still running are always the first rows; the
    state goes on from window to window.
    """
    order = np.argsort([-len(d) for d in documents], kind="stable")
    lengths = np.array([len(documents[i]) for i in order])
    out = np.zeros(len(documents))
    if not len(order):
        return out
    flat = np.concatenate([documents[i] for i in order])
    offset = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    d, (embed, u), room = model.hidden, model.halved(), model.scratch.room
    kind = embed.dtype
    h, content = np.zeros((len(order), d), kind), np.empty((len(order), d), kind)
    before, owners = np.full(len(order), end, np.int32), np.arange(len(order))
    at = 0
    while at < lengths[0]:
        running = int(np.searchsorted(-lengths, -at))
        steps = int(min(max(1, rows // running), lengths[0] - at))
        active = np.searchsorted(-lengths, -np.arange(at, at + steps)).tolist()
        states = room("states", (sum(active), d), kind)
        symbols = np.empty(len(states), np.int32)
        done = 0
        for t, n in enumerate(active, at):
            mine = slice(done, done + n)
            embedded = embed.take(before[:n], axis=1, out=room("embedded", (3, n, d), kind), mode="clip")
            model.move(embedded, h[:n], u, room("unit", (3, n, d), kind), content[:n], states[mine])
            h = states[mine]
            before = symbols[mine] = flat[offset[:n] + t]
            done += n
        h = h.copy()  # its place is written over
        logs, _ = model.output(states, symbols)
        out[order] += np.bincount(
            np.concatenate([owners[:n] for n in active]), weights=logs, minlength=len(order)
        )
        at += steps
    return out


def learn_model(lots: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Fit on all tokens of ``lots``, each in the round that is its turn."""
    spark, model, end = lots.sparkSession, Model(vocabulary), _end_symbol(vocabulary)
    for k in range(rounds):
        states = _train_round(lots.filter(F.col("turn") == k), vocabulary, model, end, RATE * (1 - k / rounds))
        found = merged_states(written(states, staging_dir(spark, "weights")), _averaged)
        if found is not None:
            model = model.with_weights(found[1])
    return model


def _train_round(
    lots: DataFrame, vocabulary: Vocabulary, model: Model, end: int, rate: float
) -> DataFrame:
    """``part, state``: tokens and weights of each task that has seen any."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = Lookup(vocabulary.hashes)
        trainer = Trainer(model.with_weights(model.weights), end, rate)
        held: list[np.ndarray] = []
        for batch in batches:
            for lot in batch.itertuples():
                symbols = symbols_of(vocabulary, lookup, *_words_of(lot))[0].astype(np.int16)
                held.append(symbols[_places_of(lot)])
                if sum(map(len, held)) >= BLOCK_TOKENS:
                    trainer.read(np.concatenate(held))
                    held = []
        if held:
            trainer.read(np.concatenate(held))
        if trainer.tokens:
            state = pickle.dumps((trainer.tokens, trainer.model.weights))
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "state": [state]})

    return lots.select("words", "tails", "places", "tokens").mapInPandas(run, "part long, state binary")


def _lots_together(batches: Iterator[pd.DataFrame]) -> Iterator[list]:
    """Lots in lists of about twice ``SCORED_TOKENS`` tokens."""
    some, tokens = [], 0
    for batch in batches:
        for lot in batch.itertuples():
            some.append(lot)
            tokens += lot.tokens
            if tokens >= 2 * SCORED_TOKENS:
                yield some
                some, tokens = [], 0
    if some:
        yield some


def score_documents(docs: DataFrame, training: DataFrame | Column) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    ``training`` are the rows to learn from: a condition on ``docs`` or a table.  All have
    ``doc_id`` and ``text``, NULL texts are empty.  ``base_score`` is the smoothed
    word-frequency model, ``score`` this one; both are log10 probabilities of the whole text.
    """
    spark = docs.sparkSession
    turn = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(17)), F.lit(ROUNDS)).cast("int")
    rest = F.lit(-1)  # not learnt from
    if isinstance(training, DataFrame):
        texts = docs.select("doc_id", "text", rest.alias("turn"), F.lit(True).alias("scored")).unionByName(
            training.select("doc_id", "text", turn.alias("turn"), F.lit(False).alias("scored"))
        )
    else:
        texts = docs.select(
            "doc_id", "text", F.when(training, turn).otherwise(rest).alias("turn"), F.lit(True).alias("scored")
        )
    lots = written(text_lots(texts), staging_dir(spark, "lots"), "turn")
    learnt = lots.filter(F.col("turn") >= 0)
    size = lots.agg(
        F.count_if(F.col("turn") >= 0).alias("learnt"), F.sum(F.expr("IF(scored, tokens, 0)")).alias("scored")
    ).first()
    tasks = spark.sparkContext.defaultParallelism
    counts = written(
        word_counts(learnt, max(tasks, size["learnt"] // LOTS_COUNTED)), staging_dir(spark, "words")
    )
    vocabulary, least = build_vocabulary(counts)
    model = learn_model(learnt, vocabulary)
    end = _end_symbol(vocabulary)
    base_log, tail_log = np.log10(vocabulary.base_total), np.log10(vocabulary.tail_total)

    def facts_of(lot, lookup: Lookup, count_logs: np.ndarray) -> tuple[pd.DataFrame, list[np.ndarray]]:
        """What the counts say about each text of a lot, and its symbols."""
        words, tails = _words_of(lot)
        n, ids = (np.frombuffer(x, np.int64) for x in (lot.sizes, lot.ids))
        places = _places_of(lot)
        symbols, listed = symbols_of(vocabulary, lookup, words, tails)
        logs = count_logs[listed]
        extra = np.where(symbols >= vocabulary.n_short, logs - tail_log[tails], 0.0)
        known, ends = listed >= 0, np.cumsum(n)
        sums = [np.add.reduceat(x[places], ends - n) for x in (known.astype(np.int64), logs - base_log, extra)]
        # Words that are not listed, by text and place.
        rare = np.flatnonzero(~known[places])
        owners = np.searchsorted(ends, rare, side="right")
        rare, times = np.unique(owners * len(words) + places[rare], return_counts=True)
        cuts = np.searchsorted(rare, np.arange(1, len(n)) * len(words))
        facts = pd.DataFrame(
            {
                "doc_id": pd.arrays.IntegerArray(ids.copy(), np.frombuffer(lot.no_id, bool).copy()),
                "n_tokens": n,
                "n_known": sums[0],
                "base": sums[1],
                "score": sums[2],
                "rare": np.split(words[rare % len(words)], cuts),
                "times": np.split(times, cuts),
            }
        )
        return facts, np.split(symbols.astype(np.int16)[places], ends[:-1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The vocabulary travels with the task: 20 bytes for each listed word.
        serial, lookup = TaskContext.get().partitionId() << 40, Lookup(vocabulary.hashes)
        # Of each listed word; last, at -1, what the others have here.
        count_logs = np.append(np.log10(vocabulary.counts + SMOOTHING), 0.0)
        for some in _lots_together(batches):
            facts, parts = zip(*(facts_of(lot, lookup, count_logs) for lot in some), strict=True)
            out = pd.concat(facts, ignore_index=True)
            out["score"] += document_logs(model, end, list(itertools.chain(*parts))) / _LN10
            out.insert(0, "row", serial + np.arange(len(out)))
            serial += len(out)
            yield out

    rows = written(
        lots.filter("scored")
        .select("tokens", "ids", "no_id", "sizes", "words", "tails", "places")
        .coalesce(max(tasks, (size["scored"] or 0) // SCORED_TOKENS))
        .mapInPandas(
            run,
            "row long, doc_id long, n_tokens long, n_known long, base double, score double, "
            "rare array<long>, times array<long>",
        ),
        staging_dir(spark, "scores"),
    )
    unlisted = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("h"), F.col("r.times").alias("times")
    )
    # Each word is there once, so its side of a partition is small and needs no sorting.
    rarer = counts.filter(F.col("c") < least).select("h", "c").hint("shuffle_hash")
    more = (
        unlisted.join(rarer, "h", "left")
        .selectExpr("row", "times", "coalesce(c, 0) AS c")
        .groupBy("row")
        .agg(
            F.expr("sum(IF(c > 0, times, 0)) AS known"),
            F.expr(f"sum(times * log10(c + {SMOOTHING}D)) AS logs"),
        )
    )
    return rows.select("row", "doc_id", "n_tokens", "n_known", "base", "score").join(
        more, "row", "left"
    ).selectExpr(
        "doc_id",
        "n_tokens",
        "n_known + coalesce(known, 0) AS n_known",
        f"CAST({vocabulary.tokens} AS BIGINT) AS train_tokens",
        "base + coalesce(logs, 0D) AS base_score",
        "score + coalesce(logs, 0D) AS score",
    )
