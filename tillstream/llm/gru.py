"""A gated recurrent language model in numpy with a class-factored softmax."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

MEMBERS = 64  # words of a class: word i is member i % MEMBERS of class i // MEMBERS
LN10 = float(np.log(10))
_BLOCK = 512  # columns of a product of a small matrix that are done at a time: BLAS is half as fast on wide ones


def _sigmoid(x):
    """In place."""
    np.exp(np.negative(x, out=x), out=x)
    return np.reciprocal(np.add(x, 1, out=x), out=x)


def _product(a, b, out=None):
    """`a @ b` by blocks of columns; two blocks or more are left to the last, which then rounds as the whole does."""
    out = np.empty((len(a), b.shape[1]), b.dtype) if out is None else out
    last = max(0, b.shape[1] // _BLOCK - 2) * _BLOCK
    for k in range(0, last, _BLOCK):
        np.matmul(a, b[:, k:k + _BLOCK], out=out[:, k:k + _BLOCK])
    np.matmul(a, b[:, last:], out=out[:, last:])
    return out


def _columns(x, order):
    """Columns of `x` in some order. The places are known to be good: `clip` spares a check of each."""
    return x.take(order, 1, mode="clip")


def _with_ones(x, order):
    """Columns in some order, and a row of ones below."""
    out = np.ones((len(x) + 1, len(order)), x.dtype)
    x.take(order, 1, out[:-1], "clip")
    return out


def _exp_and_sums(logits):
    """In place, and the sums of the columns. Logits here stay far from the limits of exp."""
    return np.exp(logits, out=logits), np.ones(len(logits), logits.dtype) @ logits


@dataclass
class Gru:
    """Parameters by name. A step turns the state `h` by word `x`; every word is predicted from the state before it."""

    at: dict[str, np.ndarray]

    @classmethod
    def start(cls, counts: np.ndarray, hidden: int, seed: int = 0, dtype=np.float32) -> "Gru":
        """Small random weights; output biases that make the first predictions the smoothed shares of `counts`."""
        rng = np.random.default_rng(seed)
        classes = -(-len(counts) // MEMBERS)
        mass = np.full(classes * MEMBERS, 1e-30)
        mass[: len(counts)] = counts + 0.1
        mass = mass.reshape(classes, MEMBERS)
        draw = lambda *shape: rng.normal(0, 0.1, shape).astype(dtype)
        return cls({
            "E": draw(len(counts), 3 * hidden), "U": draw(hidden, 3 * hidden), "b": np.zeros(3 * hidden, dtype),
            "C": draw(hidden, classes), "c": np.log(mass.sum(1) / mass.sum()).astype(dtype),
            "W": draw(classes, hidden, MEMBERS), "w": np.log(mass / mass.sum(1, keepdims=True)).astype(dtype),
        })

    @property
    def hidden(self) -> int:
        return len(self.at["U"])

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.at.values()])

    def filled(self, values: np.ndarray) -> "Gru":
        out, k = {}, 0
        for name, v in self.at.items():
            out[name] = values[k:k + v.size].reshape(v.shape).astype(v.dtype)
            k += v.size
        return Gru(out)

    def step(self, h: np.ndarray, a: np.ndarray):
        """`h` and `a` (words as gates' inputs) hold a column for each lane."""
        n = self.hidden
        g = self.at["U"].T @ h
        gates = g[:2 * n]
        gates += a[:2 * n]
        r, z = _sigmoid(gates).reshape(2, n, -1)
        new = r * g[2 * n:]
        new += a[2 * n:]
        np.tanh(new, out=new)
        out = new - h
        out *= z
        out += h
        return out, (r, z, new, g[2 * n:])

    def _by_word(self, words: np.ndarray):
        """The order of words, and the range of each class that occurs in that order, for one matrix product a class."""
        order = np.argsort(words.astype(np.uint16) if len(self.at["E"]) <= 1 << 16 else words, kind="stable")
        classes = words[order] // MEMBERS
        cuts = np.flatnonzero(np.diff(classes, prepend=-1))
        return order, [(int(classes[s]), int(s), int(e)) for s, e in zip(cuts, [*cuts[1:], len(order)])]

    def _outputs(self):
        """Weights of classes and members, with their biases as a last row."""
        p = self.at
        return np.concatenate((p["C"], p["c"][None])), np.concatenate((p["W"], p["w"][:, None]), 1)

    def _members(self, weights: np.ndarray, states: np.ndarray, ranges) -> np.ndarray:
        logits = np.empty((MEMBERS, states.shape[1]), states.dtype)
        for k, s, e in ranges:
            _product(weights[k].T, states[:, s:e], logits[:, s:e])
        return logits

    def log_probabilities(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each word after its state, a row of `states`."""
        return self._logs(np.ascontiguousarray(states.T), words)

    def _logs(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        order, ranges = self._by_word(words)
        states, words = _with_ones(states, order), words[order]
        of_class, of_member = self._outputs()
        every, found = np.arange(len(words)), np.zeros(len(words))
        for logits, own in ((_product(of_class.T, states), words // MEMBERS), (self._members(of_member, states, ranges), words % MEMBERS)):
            found += logits.take(own * len(words) + every)
            found -= np.log(_exp_and_sums(logits)[1].astype(np.float64))
        out = np.empty(len(words))
        out[order] = found
        return out

    def _states(self, words: np.ndarray, starts: np.ndarray, h: np.ndarray):
        """The state before each word of a window (steps x lanes), what its steps keep, and the state after it; a column
        for each lane. The state is zero where a text starts."""
        inputs = self.at["E"] + self.at["b"]
        going, breaks = (~starts).astype(h.dtype), starts.any(1).tolist()
        before, parts = [], []
        for t in range(len(words)):
            if breaks[t]:
                h = h * going[t]
            before.append(h)
            h, kept = self.step(h, inputs.take(words[t], 0).T)
            parts.append(kept)
        return before, parts, h, going

    def score(self, texts: list[np.ndarray], lanes: int = 512, window: int = 32) -> np.ndarray:
        """Natural log-likelihood of each whole word sequence, from a zero state that is carried from window to window.

        The texts are laid end to end in lanes of about the longest one's length.
        """
        lens = np.array([len(t) for t in texts], np.int64)
        out = np.zeros(len(texts) + 1)  # the last for what is beyond a lane's end
        lanes = min(lanes, -(-int(lens.sum()) // max(int(lens.max(initial=0)), 1)))
        if not lanes:
            return out[:-1]
        filled = [(0, lane) for lane in range(lanes)]
        places = []
        for k in np.argsort(-lens, kind="stable").tolist():
            at, lane = filled[0]
            places.append((k, lane, at))
            heapq.heapreplace(filled, (at + int(lens[k]), lane))
        steps = max(at for at, _ in filled)
        words, owner = np.zeros((lanes, steps), np.int32), np.full((lanes, steps), len(texts), np.int32)
        starts = np.zeros((lanes, steps + 1), bool)
        for k, lane, at in places:
            words[lane, at:at + lens[k]], owner[lane, at:at + lens[k]], starts[lane, at] = texts[k], k, True
        h = np.zeros((self.hidden, lanes), self.at["U"].dtype)
        for at in range(0, steps, window):
            part = slice(at, min(at + window, steps))
            own = np.ascontiguousarray(words[:, part].T)
            before, _, h, _ = self._states(own, starts[:, part].T, h)
            out += np.bincount(owner[:, part].T.ravel(), self._logs(np.concatenate(before, 1), own.ravel()), len(out))
        return out[:-1]

    def gradients(self, words: np.ndarray, starts: np.ndarray, h: np.ndarray):
        """Summed loss of a window (steps x lanes), its gradients, and the state after it (lanes x hidden).

        `starts` is true where a word is its text's first: the state is zero there. Errors go back to the window's
        first step and no further; the state goes on into the next window.
        """
        p, n = self.at, self.hidden
        (steps, lanes), flat = words.shape, words.ravel()
        before, parts, h, going = self._states(words, starts, h.T)
        breaks = starts.any(1).tolist()
        order, ranges = self._by_word(flat)
        past = np.concatenate(before, 1)
        states, found = _with_ones(past, order), flat[order]
        of_class, of_member = self._outputs()
        every, loss = np.arange(len(flat)), 0.0

        def errors(logits, own):
            nonlocal loss
            at = own * len(flat) + every
            loss -= float(logits.take(at).sum(dtype=np.float64))
            d, sums = _exp_and_sums(logits)
            loss += float(np.log(sums).sum(dtype=np.float64))
            d *= 1 / sums
            d.reshape(-1)[at] -= 1
            return d

        d = errors(_product(of_class.T, states), found // MEMBERS)
        grad_c, d_sorted = states @ d.T, _product(p["C"], d)
        d = errors(self._members(of_member, states, ranges), found % MEMBERS)
        grad_w, d_members = np.zeros_like(of_member), np.empty_like(d_sorted)
        for k, s, e in ranges:
            own = d[:, s:e]
            np.matmul(states[:, s:e], own.T, out=grad_w[k])
            _product(p["W"][k], own, d_members[:, s:e])
        d_sorted += d_members
        places = np.empty_like(order)
        places[order] = every
        d_states = _columns(d_sorted, places)

        # Rows of `d_inputs`: reset, update and new gate by their words; `d_new` by the state. A block for each step.
        d_inputs, d_news = np.empty((steps, 3 * n, lanes), h.dtype), np.empty((steps, n, lanes), h.dtype)
        dh, kept, factor = np.zeros_like(h), np.empty_like(h), np.empty_like(h)
        one, of_gates, of_new = h.dtype.type(1), p["U"][:, :2 * n], p["U"][:, 2 * n:]
        for t in range(steps - 1, -1, -1):
            (r, z, new, g), hp, d_new = parts[t], before[t], d_news[t]
            d_r, d_z, d_n = d_inputs[t].reshape(3, n, lanes)
            np.multiply(new, new, out=factor)
            np.subtract(one, factor, out=factor)
            np.multiply(dh, z, out=kept)
            np.multiply(kept, factor, out=d_n)
            np.multiply(d_n, r, out=d_new)
            np.subtract(one, r, out=factor)
            factor *= g
            np.multiply(d_new, factor, out=d_r)
            np.subtract(new, hp, out=d_z)
            d_z *= dh
            np.subtract(one, z, out=factor)
            factor *= z
            d_z *= factor
            dh -= kept
            dh += of_gates @ d_inputs[t, :2 * n]
            dh += of_new @ d_new
            dh += d_states[:, t * lanes:(t + 1) * lanes]
            if breaks[t]:
                dh *= going[t]
        d_inputs, d_news = (x.transpose(1, 0, 2).reshape(-1, len(flat)) for x in (d_inputs, d_news))
        grads = {
            "E": np.zeros_like(p["E"]), "U": np.concatenate((past @ d_inputs[:2 * n].T, past @ d_news.T), 1), "b": d_inputs.sum(1),
            "C": grad_c[:-1], "c": grad_c[-1], "W": grad_w[:, :-1], "w": grad_w[:, -1],
        }
        cuts = np.flatnonzero(np.diff(found, prepend=-1))
        grads["E"][found[cuts]] = np.add.reduceat(_columns(d_inputs, order), cuts, axis=1).T
        return loss, grads, h.T

    def train(self, texts: list[np.ndarray], lanes: int | None = None, window: int = 16, rate: float = 0.1) -> "Gru":
        """One pass by Adagrad over the texts, laid end to end and cut into lanes, with truncated backpropagation.

        By default there are 48 lanes, and up to 256 as far as some 400 steps are left.
        """
        texts = [t for t in texts if len(t)]
        stream = np.concatenate(texts)
        lanes = lanes or min(256, max(48, len(stream) // (window * 400)))
        first = np.zeros(len(stream), bool)
        first[np.cumsum([0] + [len(t) for t in texts[:-1]])] = True
        lanes = max(1, min(lanes, len(stream) // window))
        steps = len(stream) // lanes
        words = stream[: lanes * steps].reshape(lanes, steps).T
        starts = first[: lanes * steps].reshape(lanes, steps).T.copy()
        starts[0] = True
        model = Gru({k: v.copy() for k, v in self.at.items()})
        seen = {k: np.full_like(v, 1e-2) for k, v in model.at.items()}
        h = np.zeros((lanes, self.hidden), model.at["U"].dtype)
        for at in range(0, steps, window):
            part = words[at:at + window]
            _, grads, h = model.gradients(part, starts[at:at + window], h)
            for k, g in grads.items():
                g /= lanes
                seen[k] += g * g
                model.at[k] -= rate * g / np.sqrt(seen[k])
        return model
