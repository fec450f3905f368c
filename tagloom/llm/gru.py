"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation.

Token ids below `words` are the vocabulary, `PER_CLASS` ids to a class; the ids above are classes of their own for
words outside the vocabulary. p(token) = p(class | state) * p(token | class, state); for outside classes the second
factor is left to the caller.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np

PER_CLASS = 64
#: Tokens that a training lane takes at once.
BLOCK = 1024


class Gru:
    """Parameters by name in one float32 vector, so that models can be averaged and sent as one array."""

    def __init__(self, words: int, outside: int, size: int = 24, vector: np.ndarray | None = None):
        self.words, self.outside, self.size = words, outside, size
        self.word_classes = -(-words // PER_CLASS)
        classes = self.word_classes + outside
        shapes = {
            "embed": (words + outside, size),
            "input": (size, 3 * size),
            "state": (size, 3 * size),
            "gate_bias": (3 * size,),
            "reset_bias": (size,),
            "class": (size, classes),
            "class_bias": (classes,),
            "word": (self.word_classes, PER_CLASS, size),
            "word_bias": (self.word_classes, PER_CLASS),
        }
        total = sum(math.prod(s) for s in shapes.values())
        self.vector = np.zeros(total, dtype=np.float32) if vector is None else vector.astype(np.float32)
        self._shapes = shapes
        self._classes = self.class_of(np.arange(words + outside)).astype(np.int16)
        self.p = self._views(self.vector)

    def _views(self, vector: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self._shapes.items():
            n = math.prod(shape)
            out[name] = vector[at : at + n].reshape(shape)
            at += n
        return out

    def start(self, counts: np.ndarray, outside_counts: np.ndarray) -> Gru:
        """Small fixed random weights; biases such that the model begins as the unigram distribution."""
        random = np.random.default_rng(7)
        for name in ("embed", "input", "state"):
            self.p[name][:] = random.normal(0, 0.3 if name == "embed" else 1 / math.sqrt(self.size), self.p[name].shape)
        filled = np.zeros(self.word_classes * PER_CLASS)
        filled[: self.words] = counts
        grid = filled.reshape(self.word_classes, PER_CLASS)
        self.p["class_bias"][:] = np.log(np.concatenate([grid.sum(1), outside_counts]) + 0.5)
        self.p["word_bias"][:] = np.where(grid > 0, np.log(np.maximum(grid, 1)), -1e9)
        return self

    def states(self, inputs: np.ndarray, h: np.ndarray, keep: np.ndarray | None = None, embedded: np.ndarray | None = None):
        """States of a window (time x lanes), what their gradient needs and the last state. keep: 0 where a lane begins
        anew. embedded: the result of `embedded`, for one who has it.

        Inside, lanes are the last axis, so that what is done to all lanes of a unit runs over adjacent numbers."""
        p, n, (times, lanes) = self.p, self.size, inputs.shape
        if embedded is None and inputs.size < len(p["embed"]):
            x = np.take(p["embed"], inputs.ravel(), axis=0) @ p["input"]
            x += p["gate_bias"]
        else:
            x = np.take(self.embedded() if embedded is None else embedded, inputs.ravel(), axis=0)
        x = np.ascontiguousarray(x.reshape(times, lanes, 3 * n).transpose(0, 2, 1))
        gates = np.empty((times, 2 * n, lanes), dtype=h.dtype)
        before, inner, new, out = (np.empty((times, n, lanes), dtype=h.dtype) for _ in range(4))
        u, state, reset_bias = np.empty(x.shape[1:], dtype=h.dtype), np.ascontiguousarray(p["state"].T), p["reset_bias"][:, None]
        h = h.T
        for t in range(times):
            if keep is None:
                before[t] = h
            else:
                np.multiply(h, keep[t], out=before[t])
            h, g, made, following = before[t], gates[t], new[t], out[t]
            if lanes > 1:
                np.matmul(state, h, out=u)
            else:
                u[:, 0] = h[:, 0] @ p["state"]
            np.add(x[t, : 2 * n], u[: 2 * n], out=g)
            np.negative(g, out=g)
            np.exp(g, out=g)  # an overflow to infinity gives the right gate, 0
            g += 1
            np.reciprocal(g, out=g)
            np.add(u[2 * n :], reset_bias, out=inner[t])
            np.multiply(g[n:], inner[t], out=made)
            made += x[t, 2 * n :]
            np.tanh(made, out=made)
            np.subtract(h, made, out=following)
            following *= g[:n]
            following += made
            h = following
        return out.transpose(0, 2, 1), (gates, inner, new, before), h.T

    def embedded(self) -> np.ndarray:
        """What each token adds to the gates, for weights that stay as they are."""
        return self.p["embed"] @ self.p["input"] + self.p["gate_bias"]

    def class_of(self, targets: np.ndarray) -> np.ndarray:
        return np.where(targets < self.words, targets // PER_CLASS, targets - self.words + self.word_classes)

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None, weight=None):
        """Natural log-probability of each target, outside ones by class alone. With `grads`, the gradient of the
        weighted negative sum is added to it and that of the states returned too."""
        p, n, many = self.p, self.size, len(targets)
        classes = np.take(self._classes, targets)
        # one sort by class: the rows of a class are a slice from here on
        order = np.argsort(classes, kind="stable")
        classes, targets = np.take(classes, order), np.take(targets, order)
        # a last component of one takes the biases into the products
        lifted = np.ones((many, n + 1), dtype=states.dtype)
        lifted[:, :n] = np.take(states, order, axis=0)
        reach = max(float(states.max(initial=0)), -float(states.min(initial=0)))
        of_class, flat = _lifted(p["class"], p["class_bias"], reach, WIDTH)
        of_word, flat_words = _lifted(p["word"].transpose(0, 2, 1), p["word_bias"], reach)
        slices = np.searchsorted(classes, np.arange(self.word_classes + 1)).tolist()
        slices = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(slices, slices[1:])) if a < b]
        known = slices[-1][1].stop if slices else 0
        # the logits of the classes, and those of the words inside each token's class, in one array
        width = of_class.shape[1]
        logits = np.empty(many * width + known * PER_CLASS, dtype=states.dtype)
        outer, inner = logits[: many * width].reshape(many, width), logits[many * width :].reshape(known, PER_CLASS)
        np.matmul(lifted, of_class, out=outer)
        for c, rows in slices:
            np.matmul(lifted[rows], of_word[c], out=inner[rows])
        many_classes = len(p["class_bias"])
        if not flat:
            outer -= outer[:, :many_classes].max(1, keepdims=True)
            outer[:, many_classes:] = 0
        if not flat_words:
            inner -= inner.max(1, keepdims=True)
        at = np.arange(many)
        place = at * width + classes
        places = many * width + at[:known] * PER_CLASS + (targets[:known] - classes[:known].astype(np.int64) * PER_CLASS)
        chosen, chosen_words = np.take(logits, place), np.take(logits, places)
        np.exp(logits, out=logits)
        total = outer[:, :many_classes] @ np.ones(many_classes, dtype=logits.dtype)
        total_words, ones = np.empty(known, dtype=logits.dtype), np.ones(PER_CLASS, dtype=logits.dtype)
        for _, rows in slices:
            np.matmul(inner[rows], ones, out=total_words[rows])
        out = chosen - np.log(total)
        out[:known] += chosen_words - np.log(total_words)
        logs = np.empty_like(out)
        logs[order] = out
        if grads is None:
            return logs
        weight = weight[order]
        outer *= (weight / total)[:, None]
        inner *= (weight[:known] / total_words)[:, None]
        logits[place] -= weight
        logits[places] -= weight[:known]
        d_class = (lifted.T @ outer)[:, :many_classes]
        grads["class"] += d_class[:n]
        grads["class_bias"] += d_class[n]
        back = np.zeros((width, n), dtype=states.dtype)
        back[:many_classes] = p["class"].T
        d_states = outer @ back
        d_inner = np.empty((known, n), dtype=states.dtype)
        d_word = np.zeros((self.word_classes, PER_CLASS, n + 1), dtype=states.dtype)
        for c, rows in slices:
            np.matmul(inner[rows].T, lifted[rows], out=d_word[c])
            np.matmul(inner[rows], p["word"][c], out=d_inner[rows])
        grads["word"] += d_word[..., :n]
        grads["word_bias"] += d_word[..., n]
        d_states[:known] += d_inner
        places = np.empty_like(order)
        places[order] = at
        return logs, np.take(d_states, places, axis=0)

    def backward(self, inputs: np.ndarray, saved: tuple, d_out: np.ndarray, grads: dict, keep=None) -> None:
        """Add the gradient through the window's states; nothing flows to earlier windows or other documents."""
        p, n = self.p, self.size
        gates, inner, new, before = saved
        z, r = gates[:, :n], gates[:, n:]
        # what the gradient of a state is multiplied by, for all times at once
        rest = 1 - z
        to_new = new * new
        np.subtract(1, to_new, out=to_new)
        to_new *= rest
        to_z = before - new
        to_z *= z
        to_z *= rest
        to_r = inner * r
        to_r *= 1 - r
        d_out = np.ascontiguousarray(d_out.transpose(0, 2, 1))
        d_new = np.empty_like(d_out)
        d_u = np.empty((len(d_out), 3 * n, d_out.shape[2]), dtype=d_out.dtype)
        d_h, through = np.zeros_like(d_out[0]), np.empty_like(d_out[0])
        state = np.ascontiguousarray(p["state"].T)
        for t in range(len(inputs) - 1, -1, -1):
            d_h += d_out[t]
            g, made = d_u[t], d_new[t]
            np.multiply(d_h, to_z[t], out=g[:n])
            np.multiply(d_h, to_new[t], out=made)
            np.multiply(made, to_r[t], out=g[n : 2 * n])
            np.multiply(made, r[t], out=g[2 * n :])
            d_h *= z[t]
            if len(d_h[0]) > 1:
                d_h += np.matmul(p["state"], g, out=through)
            else:
                d_h[:, 0] += g[:, 0] @ state
            if keep is not None:
                d_h *= keep[t]
        flat = _rows(d_u)
        grads["state"] += _rows(before).T @ flat
        grads["reset_bias"] += flat[:, 2 * n :].sum(0)
        flat[:, 2 * n :] = _rows(d_new)
        grads["gate_bias"] += flat.sum(0)
        ids = inputs.ravel()
        grads["input"] += np.take(p["embed"], ids, axis=0).T @ flat
        d_embed = flat @ p["input"].T
        order = np.argsort(ids.astype(np.uint16), kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        grads["embed"][ids[first]] += np.add.reduceat(np.take(d_embed, order, axis=0), first, axis=0)

    def window_gradient(self, inputs, targets, weight, h, keep=None):
        """Negative log-likelihood of a window (time x lanes), its gradient as a vector, and the last state. keep: 0
        where a lane begins a document."""
        vector = np.zeros_like(self.vector)
        grads = self._views(vector)
        out, saved, last = self.states(inputs, h, keep)
        flat = out.reshape(-1, self.size)
        logs, d_states = self.log_probabilities(flat, targets.ravel(), grads, weight.ravel())
        self.backward(inputs, saved, d_states.reshape(out.shape), grads, keep)
        return -float((logs * weight.ravel()).sum()), vector, last

    def train(self, documents: Iterable[np.ndarray], first: int, lanes: int = 256, window: int = 16, rate: float = 0.02) -> int:
        """Adam over windows of `window` tokens that cover every token of every document. Lanes take documents one
        after the other; a document's state is carried across all its windows and starts at zero.

        `first` is the input before a document. Few tokens go in fewer lanes, so that there are updates enough.
        Returns the number of tokens learnt from.
        """
        documents = (ids for ids in documents if len(ids))
        ahead, held = [], 0
        for ids in documents:
            ahead.append(ids)
            held += len(ids)
            if held >= lanes * BLOCK and len(ahead) >= lanes:
                break
        lanes = min(lanes, max(8, held // BLOCK), len(ahead))
        if not lanes:
            return 0
        with np.errstate(over="ignore"):
            return self._train(_blocks(chain(ahead, documents), lanes, first), lanes, window, rate)

    def _train(self, blocks, lanes, window, rate) -> int:
        mean, square, work = (np.zeros_like(self.vector) for _ in range(3))
        h = np.zeros((lanes, self.size), dtype=np.float32)
        done = updates = 0
        for inputs, targets, mask, keep in blocks:
            for t in range(0, BLOCK, window):
                live = np.flatnonzero(mask[:, t])
                if not len(live):
                    break
                at = np.s_[live, t : t + window]
                weight, kept = mask[at].T, keep[at].T
                n = weight.sum()
                kept = kept if kept.min() == 0 else None
                _, grad, h[live] = self.window_gradient(inputs[at].T, targets[at].T, weight / n, h[live], kept)
                updates += 1
                norm = np.sqrt(float(grad @ grad))
                # a window that the last documents leave partly empty moves the weights by its share
                scale = rate * math.sqrt(1 - 0.99**updates) / (1 - 0.9**updates) * float(n) / (lanes * window)
                self._adam(grad, min(1.0, 1 / max(norm, 1e-9)), scale, mean, square, work)
                done += int(n)
        return done

    def _adam(self, grad, shrink: float, scale: float, mean, square, work) -> None:
        """One update in place; `work` is a buffer, and `grad` is used up."""
        grad *= shrink
        np.multiply(grad, grad, out=work)
        work *= 0.01
        square *= 0.99
        square += work
        grad *= 0.1
        mean *= 0.9
        mean += grad
        np.sqrt(square, out=work)
        work += 1e-6
        np.divide(mean, work, out=work)
        work *= scale
        self.vector -= work

    def score(self, documents: list[np.ndarray], first: int, lanes: int = 256, window: int = 16) -> np.ndarray:
        """Natural log-probability of each document. Lanes take documents one after the other; a document's state is
        carried across all its windows and starts at zero."""
        out = np.zeros(len(documents))
        order = sorted((i for i in range(len(documents)) if len(documents[i])), key=lambda i: -len(documents[i]))
        lanes = min(lanes, len(order))
        if not lanes:
            return out
        loads, queues = np.zeros(lanes, dtype=np.int64), [[] for _ in range(lanes)]
        for i in order:
            lane = int(loads.argmin())
            queues[lane].append(i)
            loads[lane] += len(documents[i])
        # longest lanes first, so that the lanes still running are always the first ones
        running = np.argsort(-loads, kind="stable")
        sizes = loads[running]
        targets = np.zeros((lanes, int(sizes[0])), dtype=np.int32)
        owner = np.full((lanes, int(sizes[0])), -1, dtype=np.int32)
        for row, lane in enumerate(running):
            own = queues[lane]
            targets[row, : sizes[row]] = np.concatenate([documents[i] for i in own])
            owner[row, : sizes[row]] = np.repeat(own, [len(documents[i]) for i in own])
        fresh = np.ones(owner.shape, dtype=bool)
        fresh[:, 1:] = owner[:, 1:] != owner[:, :-1]
        inputs = np.full(targets.shape, first, dtype=np.int32)
        inputs[:, 1:][~fresh[:, 1:]] = targets[:, :-1][~fresh[:, 1:]]
        h = np.zeros((lanes, self.size), dtype=np.float32)
        embedded = self.embedded()
        with np.errstate(over="ignore"):
            for t in range(0, int(sizes[0]), window):
                live = int(np.searchsorted(-sizes, -t, side="left"))
                at = np.s_[:live, t : t + window]
                keep = (~fresh[at].T).astype(np.float32)
                states, _, h = self.states(inputs[at].T, h[:live], keep if keep.min() == 0 else None, embedded)
                of, ids, flat = owner[at].T.ravel(), targets[at].T.ravel(), states.reshape(-1, self.size)
                if sizes[live - 1] < t + window:
                    valid = of >= 0
                    of, ids, flat = of[valid], ids[valid], flat[valid]
                out += np.bincount(of, weights=self.log_probabilities(flat, ids), minlength=len(documents))
        return out


#: Class logits are computed for a multiple of so many, for which the matrix product takes less time; those added count for nothing.
WIDTH = 16
#: Logits that a state can move by no more than this need no greatest value taken off before they are raised.
FLAT = 40.0


def _lifted(weights: np.ndarray, bias: np.ndarray, reach: float, width: int = 1) -> tuple[np.ndarray, bool]:
    """Weights (... x units x outputs) with the biases, less the greatest of them, as one more unit; and whether states
    of components up to `reach` keep all sums of the raised logits between exp(-FLAT) and exp(FLAT) an output. Zeros
    fill the last axis up to a multiple of `width`."""
    units, outputs = weights.shape[-2:]
    out = np.zeros((*weights.shape[:-2], units + 1, -(-outputs // width) * width), dtype=weights.dtype)
    out[..., :units, :outputs] = weights
    out[..., units, :outputs] = bias - bias.max(-1, keepdims=True)
    return out, reach * float(np.abs(weights).sum(-2).max(initial=0)) <= FLAT


def _rows(values: np.ndarray) -> np.ndarray:
    """Times x units x lanes as tokens x units."""
    return values.transpose(0, 2, 1).reshape(-1, values.shape[1])


def _blocks(documents: Iterator[np.ndarray], lanes: int, first: int):
    """Inputs, targets, mask and keep (lanes x BLOCK) until the documents are used up; a document goes on in the same
    lane of the next block."""
    left, last = [np.empty(0, dtype=np.int64)] * lanes, [first] * lanes
    while True:
        inputs, targets = (np.full((lanes, BLOCK), first, dtype=np.int32) for _ in range(2))
        mask, keep = np.zeros((lanes, BLOCK), dtype=np.float32), np.ones((lanes, BLOCK), dtype=np.float32)
        for lane in range(lanes):
            at = 0
            while at < BLOCK:
                ids = left[lane]
                if len(ids):
                    inputs[lane, at] = last[lane]
                else:
                    ids = next(documents, None)
                    if ids is None:
                        break
                    keep[lane, at] = 0
                now = ids[: BLOCK - at]
                to = at + len(now)
                targets[lane, at:to], mask[lane, at:to] = now, 1
                inputs[lane, at + 1 : to] = now[:-1]
                left[lane], last[lane] = ids[len(now) :], now[-1]
                at = to
        if not mask.any():
            return
        yield inputs, targets, mask, keep
