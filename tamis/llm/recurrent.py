"""A gated recurrent language model in numpy, with a class-factored softmax.

Texts are sequences of small integers. They are laid end to end on parallel streams, and the
streams are cut into windows. The hidden state is carried from window to window and reset where
a text begins, in training as in scoring, so a text of any length is one text; in training the
gradient stops at the window's edge.

A class is a run of tokens that follow each other by frequency. A step pays for all classes and
for the tokens of one class, so classes of frequent tokens are small and those of rare ones large.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
SIZE = 1024  # tokens of the smallest model
END, UNKNOWN = 0, 1  # END also stands before the first token of a text
WINDOW = 32  # steps of one window
STREAMS = 256  # at most so many streams side by side
LEAST_WINDOWS = 40  # fewer streams for short input, so that there are so many windows
CHUNK = 2_000_000  # tokens laid out together in training
RATE = 0.01
LEAST = 1e-30
SAFE = 60.0  # size of an exponent that needs no shift
SAFE_STEPS = 16  # updates for which that holds: each changes a weight by at most 2.4 times the rate
CELLS = 24_576  # of a softmax held at a time, so that it stays in the caches

Parameters = dict[str, np.ndarray]


def class_edges(shares: np.ndarray) -> np.ndarray:
    """First token of every class, and the number of tokens.

    ``END`` and ``UNKNOWN`` are alone in theirs. A class ends where the square roots of its
    tokens' shares sum to one, which makes the expected cost of a step least: a token of share p
    adds about sqrt(p) to the number of classes and p / sqrt(p) to the words of the class looked at.
    """
    filled = np.floor(np.cumsum(np.sqrt(shares[2:])))
    starts = 2 + np.flatnonzero(np.diff(filled, prepend=-1.0) > 0)
    return np.array([END, UNKNOWN, *starts, len(shares)], np.int64)


def shapes(edges: np.ndarray) -> dict[str, tuple[int, ...]]:
    """Of a model with these classes; the last column of the outputs is the bias."""
    tokens, classes = int(edges[-1]), len(edges) - 1
    return {
        "embed": (tokens, HIDDEN),
        "input": (HIDDEN, 3 * HIDDEN),
        "state": (HIDDEN, 3 * HIDDEN),
        "gate_bias": (3 * HIDDEN,),
        "class_out": (classes, HIDDEN + 1),
        "word_out": (tokens, HIDDEN + 1),
    }


def initial(shares: np.ndarray, seed: int = 8) -> Parameters:
    """Small random weights; the biases give every token its share, which falls from token 2 on."""
    rng = np.random.default_rng(seed)
    edges = class_edges(shares)
    p = {k: rng.normal(0, 0.15, shape).astype(np.float32) for k, shape in shapes(edges).items()}
    p["gate_bias"][:] = 0
    shares = np.maximum(shares, 1e-12)
    by_class = np.add.reduceat(shares, edges[:-1])
    p["class_out"][:, -1] = np.log(by_class)
    p["word_out"][:, -1] = np.log(shares / np.repeat(by_class, np.diff(edges)))
    return p


def flat(p: Parameters) -> np.ndarray:
    return np.concatenate([x.ravel() for x in p.values()])


def shaped(values: np.ndarray, edges: np.ndarray) -> Parameters:
    out, at = {}, 0
    for k, shape in shapes(edges).items():
        n = int(np.prod(shape))
        out[k] = values[at : at + n].reshape(shape).astype(np.float32)
        at += n
    return out


@dataclass(frozen=True)
class Streams:
    """Texts end to end: step by stream, the longest stream first. ``text`` is -1 where a stream
    has run out."""

    given: np.ndarray
    wanted: np.ndarray
    first: np.ndarray
    text: np.ndarray

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``given``, ``wanted``, ``first``, ``text`` of the steps of a window and the streams
        that have not run out before it."""
        for at in range(0, len(self.given), WINDOW):
            cut = slice(at, at + WINDOW), slice(0, int((self.text[at] >= 0).sum()))
            yield self.given[cut], self.wanted[cut], self.first[cut], self.text[cut]


def laid_out(sequences: list[np.ndarray]) -> Streams:
    """``sequences`` of token numbers, each with ``END`` as its last. Longest first, each goes
    to the stream that is shortest so far."""
    total = sum(map(len, sequences))
    width = max(1, min(STREAMS, len(sequences), total // (WINDOW * LEAST_WINDOWS) + 1))
    loads = [(0, s) for s in range(width)]
    places = np.zeros((len(sequences), 2), np.int64)
    for i in sorted(range(len(sequences)), key=lambda i: -len(sequences[i])):
        load, s = heapq.heappop(loads)
        places[i] = load, s
        heapq.heappush(loads, (load + len(sequences[i]), s))
    column = np.empty(width, np.int64)
    column[[s for _, s in sorted(loads, reverse=True)]] = np.arange(width)
    steps = max(load for load, _ in loads)
    given = np.zeros((steps, width), np.int32)
    wanted = np.zeros((steps, width), np.int32)
    first = np.zeros((steps, width), bool)
    text = np.full((steps, width), -1, np.int32)
    for i, words in enumerate(sequences):
        at, s = places[i, 0], column[places[i, 1]]
        stop = at + len(words)
        wanted[at:stop, s] = words
        given[at, s] = END
        given[at + 1 : stop, s] = words[:-1]
        first[at, s] = True
        text[at:stop, s] = i
    return Streams(given, wanted, first, text)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _driven(p: Parameters, tokens: np.ndarray | slice = slice(None)) -> np.ndarray:
    """What every one of the tokens adds to the gates."""
    return p["embed"][tokens] @ p["input"] + p["gate_bias"]


def _forward(p: Parameters, driven: np.ndarray, first: np.ndarray, h: np.ndarray, trace: list | None):
    """Hidden states of all steps of a window, and the last."""
    steps, width = driven.shape[:2]
    out = np.empty((steps, width, HIDDEN), np.float32)
    two = 2 * HIDDEN
    resets = first.any(1)
    for t in range(steps):
        if resets[t]:
            h = np.where(first[t][:, None], np.float32(0), h)
        fed = h @ p["state"]
        gates = _sigmoid(driven[t, :, :two] + fed[:, :two])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(driven[t, :, two:] + r * fed[:, two:])
        new = n + z * (h - n)
        if trace is not None:
            trace.append((h, z, r, n, fed[:, two:]))
        out[t] = h = new
    return out, h


def _with_one(states: np.ndarray) -> np.ndarray:
    """A one after every state, which the bias is multiplied by."""
    return np.concatenate([states, np.ones((len(states), 1), states.dtype)], 1)


def _safe(out: np.ndarray) -> bool:
    """States are at most one in size, so small weights need no shift."""
    return bool(np.abs(out).sum(1).max() < SAFE)


def _softmax(
    out: np.ndarray, edges: np.ndarray, used: np.ndarray, group: np.ndarray, goal: np.ndarray, safe: bool, n: int = 0
) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None, list[slice]]:
    """Of every step the chance of its goal, a row of ``out``, by the softmax of its group: the
    rows from one edge to the next. With ``n``, also the gradients of the summed loss divided by
    ``n``, by ``out`` and by ``used``, and the rows that the first has: those of no other group
    are set.

    Steps are put in the order of their groups once, so that a group, of which there are many,
    costs few calls.
    """
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(len(edges)))
    used, goal = used[order], goal[order]
    kind = np.result_type(out, used)
    chance = np.ones(len(goal), kind)
    d_out, d_used = (np.empty_like(out), np.zeros(used.shape, kind)) if n else (None, None)
    touched = []
    # In a group of one, the chance is one.
    for c in np.flatnonzero((bounds[1:] > bounds[:-1]) & (np.diff(edges) > 1)).tolist():
        low, high = int(edges[c]), int(edges[c + 1])
        own, stop = out[low:high], int(bounds[c + 1])
        if n:
            touched.append(slice(low, high))
            d_out[low:high] = 0
        chunk = max(16, CELLS // len(own))
        for at in range(int(bounds[c]), stop, chunk):
            cut = slice(at, min(at + chunk, stop))
            held, wanted = used[cut], goal[cut] - low
            k = np.arange(len(wanted))
            e = own @ held.T  # one column per step, which numpy sums fast
            if not safe:
                e -= e.max(0)
            np.exp(e, out=e)
            sums = e.sum(0)
            chance[cut] = e[wanted, k] / sums
            if n:
                # The sums divide the few columns of the states instead of the many of the words.
                e[wanted, k] -= sums
                share = (1 / (sums * n))[:, None]
                d_out[low:high] += e @ (held * share)
                d_used[cut] = (e.T @ own) * share
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return chance[back], d_out, d_used[back] if n else None, touched


def log_likelihoods(p: Parameters, edges: np.ndarray, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of every whole sequence."""
    total = np.zeros(len(sequences))
    if not sequences:
        return total
    streams = laid_out(sequences)
    h = np.zeros((streams.given.shape[1], HIDDEN), np.float32)
    driven, classes = _driven(p), np.array([0, len(edges) - 1])
    of_class, of_word = p["class_out"], p["word_out"]
    safe = _safe(of_class), _safe(of_word)
    for given, wanted, first, text in streams.windows():
        states, h = _forward(p, driven[given], first, h[: given.shape[1]], None)
        real = np.flatnonzero(text.ravel() >= 0)
        used, goal = _with_one(states.reshape(-1, HIDDEN)[real]), wanted.ravel()[real].astype(np.int64)
        group = np.searchsorted(edges, goal, "right") - 1
        chance = _softmax(of_class, classes, used, np.zeros_like(group), group, safe[0])[0]
        chance *= _softmax(of_word, edges, used, group, goal, safe[1])[0]
        logs = np.log(np.maximum(chance, LEAST))
        total += np.bincount(text.ravel()[real], weights=logs, minlength=len(sequences))
    return total


@dataclass(frozen=True)
class Gradient:
    """By every parameter, but only in the rows listed; the rest of the array is not set."""

    values: Parameters
    rows: dict[str, list[slice] | np.ndarray]

    def parts(self) -> Iterator[tuple[str, slice | np.ndarray, np.ndarray]]:
        """Parameter, rows of it, gradient by those rows."""
        for k, x in self.values.items():
            if k == "embed":
                yield k, self.rows[k], x
            elif k in self.rows:
                for rows in self.rows[k]:
                    yield k, rows, x[rows]
            else:
                yield k, slice(None), x


def gradients(
    p: Parameters,
    edges: np.ndarray,
    given: np.ndarray,
    wanted: np.ndarray,
    first: np.ndarray,
    real: np.ndarray,
    h: np.ndarray,
    safe: bool = False,
) -> tuple[Gradient, np.ndarray, float]:
    """Gradients of the mean loss over the real steps of one window, by backpropagation through
    its steps; the state after it; the summed loss. Only the tokens and the classes of the window
    are looked at, however many the model has."""
    trace: list = []
    tokens, place = np.unique(given.ravel(), return_inverse=True)
    steps, width = given.shape
    states, last = _forward(p, _driven(p, tokens)[place].reshape(steps, width, -1), first, h, trace)
    flat_states = states.reshape(-1, HIDDEN)
    at_real = np.flatnonzero(real.ravel())
    used = _with_one(flat_states[at_real])
    goal = wanted.ravel()[at_real].astype(np.int64)
    group = np.searchsorted(edges, goal, "right") - 1
    n = max(len(goal), 1)
    g: Parameters = {}

    of_class, of_word = p["class_out"], p["word_out"]
    classes = np.array([0, len(of_class)])
    chance, g["class_out"], d_used, _ = _softmax(of_class, classes, used, np.zeros_like(group), group, safe, n)
    inner, g["word_out"], d_inner, touched = _softmax(of_word, edges, used, group, goal, safe, n)
    loss = -float(np.log(np.maximum(chance, LEAST)).sum() + np.log(np.maximum(inner, LEAST)).sum())
    d_used += d_inner
    d_states = np.zeros_like(flat_states)
    d_states[at_real] = d_used[:, :-1]
    d_states = d_states.reshape(states.shape)

    two = 2 * HIDDEN
    d_driven = np.empty((steps, width, 3 * HIDDEN), states.dtype)
    d_fed = np.empty((steps, width, 3 * HIDDEN), states.dtype)
    before = np.empty((steps, width, HIDDEN), states.dtype)
    back = np.ascontiguousarray(p["state"].T)
    resets = first.any(1)
    d_h = np.zeros((width, HIDDEN), states.dtype)
    for t in range(steps - 1, -1, -1):
        prior, z, r, new, fed_n = trace[t]
        d_h = d_h + d_states[t]
        kept = d_h * z
        d_n = (d_h - kept) * (1 - new * new)
        driven, fed = d_driven[t], d_fed[t]
        driven[:, :HIDDEN] = (prior - new) * kept * (1 - z)
        driven[:, HIDDEN:two] = d_n * fed_n * r * (1 - r)
        driven[:, two:] = d_n
        fed[:, :two] = driven[:, :two]
        fed[:, two:] = d_n * r
        before[t] = prior
        d_h = kept + fed @ back
        if resets[t]:
            d_h[first[t]] = 0
    d_driven = d_driven.reshape(-1, 3 * HIDDEN)
    g["state"] = before.reshape(-1, HIDDEN).T @ d_fed.reshape(-1, 3 * HIDDEN)
    g["gate_bias"] = d_driven.sum(0)
    # Per token first: the same token was given many times.
    order = np.argsort(place, kind="stable")
    by_token = np.add.reduceat(d_driven[order], np.searchsorted(place[order], np.arange(len(tokens))))
    g["input"] = p["embed"][tokens].T @ by_token
    g["embed"] = by_token @ p["input"].T
    return Gradient(g, {"embed": tokens, "word_out": touched}), last, loss


class Trainer:
    """Adam over the windows of whatever it is given, in the order given; one pass. Rows that a
    window does not touch keep their weights and their moments."""

    def __init__(self, p: Parameters, edges: np.ndarray, rate: float = RATE) -> None:
        self.p = {k: v.copy() for k, v in p.items()}
        self.edges = edges
        self.rate, self.step, self.seen, self.loss, self.safe = rate, 0, 0, 0.0, False
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}
        self.held: list[np.ndarray] = []
        self.tokens = 0

    def add(self, sequence: np.ndarray) -> None:
        """A whole text. Texts are held until they make up a chunk, so that windows do not depend
        on the batches in which texts come."""
        self.held.append(sequence)
        self.tokens += len(sequence)
        if self.tokens >= CHUNK:
            self.learn()

    def learn(self) -> None:
        """From the texts held."""
        if not self.held:
            return
        streams = laid_out(self.held)
        self.held, self.tokens = [], 0
        h = np.zeros((streams.given.shape[1], HIDDEN), np.float32)
        for given, wanted, first, text in streams.windows():
            real = text >= 0
            if self.step % SAFE_STEPS == 0:
                self.safe = _safe(self.p["class_out"]) and _safe(self.p["word_out"])
            h = h[: given.shape[1]]
            g, h, loss = gradients(self.p, self.edges, given, wanted, first, real, h, self.safe)
            self.seen += int(real.sum())
            self.loss += loss
            self._update(g, real.sum() / (WINDOW * streams.given.shape[1]))

    def _update(self, g: Gradient, share: float) -> None:
        """One step, as long as the share of the window that holds text: where most streams
        have run out, the few long texts left would turn the model to themselves."""
        self.step += 1
        parts = list(g.parts())
        norm = np.sqrt(sum(float(np.vdot(x, x)) for _, _, x in parts))
        scale = min(1.0, 1.0 / max(norm, 1e-9))
        ahead = self.rate * share * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        for k, rows, x in parts:
            # A class at a time, so that the arrays stay in the caches.
            m, v = self.m[k][rows], self.v[k][rows]
            m *= 0.9
            x *= np.float32(0.1 * scale)
            m += x
            x *= x
            v *= 0.99
            v += x
            if k == "embed":  # taken by number, so these are copies
                self.m[k][rows], self.v[k][rows] = m, v
            np.sqrt(v, out=x)
            x += 1e-6
            np.divide(m, x, out=x)
            x *= np.float32(ahead)
            self.p[k][rows] -= x
