"""A gated recurrent language model with class-factored output.

Tokens are the ``HEAD`` commonest words of the training texts and classes of all other words by their look. The output is
factored: first the class, then the word within it. Head classes hold ``CLASS_WORDS`` words of neighbouring frequency and
have a softmax of their own; within a tail class a word has its share of the class's training tokens, add-one smoothed
with room for one unseen word. Everything is plain numpy: training by back-propagation truncated to windows, with the
state handed on from window to window, and so is scoring, so a text's log-likelihood covers it from its first word to its end.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

HEAD, CLASS_WORDS, TAIL_CLASSES = 2_048, 64, 32
HIDDEN = 24
WINDOW = 16
#: Streams trained side by side and tokens whose probabilities are worked out at once: both fit the processor's cache, and
#: neither is a power of two, at which rows of a matrix would fall on the same lines of it.
STREAMS, PIECE = 500, 8_000
#: Tokens of one softmax, scores whose exponentials 32-bit numbers can sum, and parameters moved at once.
SHARES, SMALL, MOVED = 2_000, 60.0, 1 << 14
LEAST_UPDATES = 64
#: The first two bytes of the first letter beyond ASCII.
BEYOND = re.compile(rb"[\x80-\xff].?", re.DOTALL)
NAMES = ("inputs", "recurrent", "class_weight", "class_bias", "word_weight", "word_bias")


def tail_class(word: bytes) -> int:
    """The class of a word outside the head: by its first letter beyond ASCII and its last character."""
    return _class_of(b"" if word.isascii() else BEYOND.search(word)[0], word[-1:])


@lru_cache(1 << 16)
def _class_of(letter: bytes, last: bytes) -> int:
    return zlib.crc32(letter + b"\0" + (b"" if last.isalnum() or last >= b"\x80" else last)) % TAIL_CLASSES


def _scores(hidden: np.ndarray, weight: np.ndarray, small: bool) -> np.ndarray:
    """A row of scores for each token, less its largest one unless none is beyond ``SMALL``: 32-bit numbers can sum their exponentials."""
    scores = hidden @ weight
    if not small:
        scores -= scores.max(axis=1, keepdims=True)
    return scores


def _exponentials(scores: np.ndarray) -> np.ndarray:
    """``scores`` become their exponentials; the sum of each row."""
    np.exp(scores, out=scores)
    return scores @ np.ones(scores.shape[1], dtype=scores.dtype)


def _logs(scores: np.ndarray, picked: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log of the picked share of each row."""
    chosen = scores[at[: len(scores)], picked]
    return (chosen - np.log(_exponentials(scores))).astype(np.float64)


def _slopes(scores: np.ndarray, picked: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``scores`` become the shares of each row, less one where picked."""
    scores *= (1 / _exponentials(scores))[:, None]
    scores[at[: len(scores)], picked] -= 1
    return scores


def _side_by_side(begins: np.ndarray, size: int, streams: int) -> Iterator[tuple[np.ndarray, list[int]]]:
    """``size`` tokens of texts with these first places, in at most so many streams of whole texts that are read side by side:
    places of the tokens, step by step, and how many streams are left in each step; about ``PIECE`` tokens at once.
    """
    _, firsts = np.unique(begins * streams // size, return_index=True)
    starts = begins[firsts]
    lengths = np.diff(starts, append=size)
    by_length = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[by_length], lengths[by_length]
    left = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    upto = np.cumsum(left)
    step = done = 0
    while step < len(left):
        last = max(step + 1, int(np.searchsorted(upto, done + PIECE, side="right")))
        yield np.concatenate([starts[: left[t]] + t for t in range(step, last)]), left[step:last].tolist()
        step, done = last, upto[last - 1]


class Gru:
    """Parameters, by name in ``weights``; ``head`` words in the model."""

    def __init__(self, head: int, weights: dict[str, np.ndarray]):
        self.head, self.weights = head, weights
        self.rooms: dict[str, np.ndarray] = {}
        self.head_classes = -(-head // CLASS_WORDS)

    @classmethod
    def fresh(cls, head_counts: np.ndarray, tail_counts: np.ndarray, seed: int = 11) -> Gru:
        """A model that starts as the unigram law of the counts."""
        rng = np.random.default_rng(seed)
        head = len(head_counts)
        model = cls(head, {})
        masses = [head_counts[k : k + CLASS_WORDS].sum() for k in range(0, head, CLASS_WORDS)] + list(tail_counts)
        share = np.array(masses, dtype=np.float64) + 1
        model.weights = {
            "inputs": rng.normal(0, 0.1, (head + TAIL_CLASSES + 1, 3 * HIDDEN)),
            "recurrent": rng.normal(0, 0.5 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)),
            "class_weight": rng.normal(0, 0.05, (HIDDEN, len(share))),
            "class_bias": np.log(share / share.sum()),
            "word_weight": rng.normal(0, 0.02, (head, HIDDEN)),
            "word_bias": np.log(head_counts + 1.0),
        }
        model.weights = {k: v.astype(np.float32) for k, v in model.weights.items()}
        return model

    def classes(self, tokens: np.ndarray) -> np.ndarray:
        return np.where(tokens < self.head, tokens // CLASS_WORDS, self.head_classes + tokens - self.head)

    def step(self, inputs: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The next state of each row, and what the way back needs."""
        table, recurrent = self._by_gate()
        return self._step(table.take(inputs, axis=1), state, recurrent)

    def _by_gate(self) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and recurrent weights by gate, so that each gate's units lie side by side; those of the first two are halved."""
        both = (self.weights[name].reshape(-1, 3, HIDDEN).transpose(1, 0, 2) for name in ("inputs", "recurrent"))
        table, recurrent = (np.ascontiguousarray(a) for a in both)
        table[:2] *= 0.5
        recurrent[:2] *= 0.5
        return table, recurrent

    def _step(self, x: np.ndarray, state: np.ndarray, recurrent: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The same from the inputs by gate."""
        a = state @ recurrent
        gates = a[:2]
        gates += x[:2]
        np.tanh(gates, out=gates)  # the logistic function by way of tanh of half cannot overflow
        gates *= 0.5
        gates += 0.5
        keep, reset, inner = a
        new = reset * inner
        new += x[2]
        np.tanh(new, out=new)
        kept = state - new
        kept *= keep
        return kept + new, (keep, reset, inner, new, kept)

    def output(self, hidden: np.ndarray, tokens: np.ndarray, gradients: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray | None, np.ndarray | None]:
        """Natural log probability of each token (of its class, for the tail); with ``gradients``, to which it adds, the slopes of
        ``hidden`` instead.
        """
        return self._output(np.concatenate([hidden, np.ones_like(hidden[:, :1])], axis=1), tokens, gradients)

    def _output(self, hidden: np.ndarray, tokens: np.ndarray, gradients: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray | None, np.ndarray | None]:
        """The same with a last column of ones in ``hidden``, which stands for the bias."""
        w = self.weights
        of_class = np.concatenate([w["class_weight"], w["class_bias"][None]])
        of_word = np.concatenate([w["word_weight"].T, w["word_bias"][None]])
        reach = max(hidden.max(initial=1), -hidden.min(initial=0))
        most = max(np.abs(a).sum(axis=0).max(initial=0) for a in (of_class, of_word))
        small = bool(reach * most < SMALL)
        found = np.empty(len(tokens)) if gradients is None else None
        slope = None if gradients is None else np.empty((len(tokens), HIDDEN), dtype=hidden.dtype)
        for at in range(0, len(tokens), PIECE):
            part = slice(at, at + PIECE)
            kinds = self.classes(tokens[part])
            order = np.argsort(kinds.astype(np.int16), kind="stable")
            logs, back = self._piece(hidden[part].take(order, axis=0), tokens[part][order], kinds[order], of_class, of_word, small, gradients)
            if gradients is None:
                found[part][order] = logs
            else:
                place = np.empty_like(order)
                place[order] = np.arange(len(order))
                slope[part] = back.take(place, axis=0)
        return found, slope

    def _piece(
        self,
        hidden: np.ndarray,
        tokens: np.ndarray,
        kinds: np.ndarray,
        of_class: np.ndarray,
        of_word: np.ndarray,
        small: bool,
        gradients: dict[str, np.ndarray] | None,
    ) -> tuple[np.ndarray | None, np.ndarray | None]:
        """Log probabilities of tokens that are sorted by class or, with ``gradients``, slopes; scores have a row for each token."""
        at = np.arange(SHARES)
        if gradients is None:
            found = np.empty(len(tokens))
            for low in range(0, len(tokens), SHARES):
                part = slice(low, low + SHARES)
                found[part] = _logs(_scores(hidden[part], of_class, small), kinds[part], at)
            for words, part in self._by_class(kinds):
                found[part] += _logs(_scores(hidden[part], of_word[:, words], small), tokens[part] - words.start, at)
            return found, None
        slope = np.empty((len(tokens), HIDDEN), dtype=hidden.dtype)
        weight = of_class[:HIDDEN].T.copy()
        for low in range(0, len(tokens), SHARES):
            part = slice(low, low + SHARES)
            own = hidden[part]
            scores = _slopes(_scores(own, of_class, small), kinds[part], at)
            sums = own.T @ scores
            gradients["class_weight"] += sums[:HIDDEN]
            gradients["class_bias"] += sums[HIDDEN]
            np.matmul(scores, weight, out=slope[part])
        for words, part in self._by_class(kinds):
            own = hidden[part]
            scores = _slopes(_scores(own, of_word[:, words], small), tokens[part] - words.start, at)
            sums = scores.T @ own
            gradients["word_weight"][words] += sums[:, :HIDDEN]
            gradients["word_bias"][words] += sums[:, HIDDEN]
            slope[part] += scores @ self.weights["word_weight"][words]
        return None, slope

    def _by_class(self, kinds: np.ndarray) -> Iterator[tuple[slice, slice]]:
        """Of tokens that are sorted by class: the words of each head class and some of its tokens at once."""
        bounds = np.searchsorted(kinds, np.arange(self.head_classes + 1)).tolist()
        for k in range(self.head_classes):
            words = slice(k * CLASS_WORDS, min(self.head, (k + 1) * CLASS_WORDS))
            for low in range(bounds[k], bounds[k + 1], SHARES):
                yield words, slice(low, min(bounds[k + 1], low + SHARES))

    def log_likelihoods(self, texts: list[np.ndarray], streams: int = 2 * STREAMS) -> np.ndarray:
        """Natural log-likelihood of each whole text (without the shares within tail classes).

        The texts are laid end to end in parallel streams of about one length, so that few steps have few rows. A text
        lies in one stream as a whole, and the state starts anew with it.
        """
        out, lengths = np.zeros(len(texts)), np.array([len(t) for t in texts], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")[: np.count_nonzero(lengths)]
        if not len(order):
            return out
        start = self.head + TAIL_CLASSES
        flat = np.concatenate([texts[k] for k in order])
        begins = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
        before = np.empty(len(flat), dtype=np.uint16)
        before[1:] = flat[:-1]
        before[begins] = start
        logs = np.empty(len(flat), dtype=np.float32)
        table, recurrent = self._by_gate()
        state = np.zeros((streams, HIDDEN), dtype=np.float32)
        for at, left in _side_by_side(begins, len(flat), streams):
            inputs, hidden = before[at].astype(np.int64), np.ones((len(at), HIDDEN + 1), dtype=np.float32)
            low = 0
            for n in left:
                part = slice(low, low + n)
                state = state[:n]
                state[np.flatnonzero(inputs[part] == start)] = 0
                state, _ = self._step(table.take(inputs[part], axis=1), state, recurrent)
                hidden[part, :HIDDEN] = state
                low += n
            logs[at] = self._output(hidden, flat[at].astype(np.int64))[0]
        out[order] = np.add.reduceat(logs, begins, dtype=np.float64)
        return out

    def train(self, texts: list[np.ndarray], rate: float = 0.01, streams: int = STREAMS) -> None:
        """One pass over the texts, laid end to end in parallel streams, by Adam with an update for each window.

        The state is handed on from window to window and starts anew with each text. What is left behind the last whole
        row of streams is one more, shorter stream.
        """
        texts = [t for t in texts if len(t)]
        if not texts:
            return
        start = self.head + TAIL_CLASSES
        tokens = np.concatenate(texts).astype(np.int64)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]])] = start
        streams = max(1, min(streams, len(tokens) // (LEAST_UPDATES * WINDOW)))  # few texts make narrow windows, not few updates
        length = len(tokens) // streams
        whole, rest = streams * length, len(tokens) % streams
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        n = -(-length // WINDOW) + -(-rest // WINDOW)
        turn = 0
        for part, wide in ((slice(0, whole), streams), (slice(whole, None), 1)):
            seen, said = (np.ascontiguousarray(a[part].reshape(wide, -1).T) for a in (before, tokens))
            state = np.zeros((wide, HIDDEN), dtype=np.float32)
            for at in range(0, len(said), WINDOW):
                state, gradients = self.gradients(seen[at : at + WINDOW], said[at : at + WINDOW], state)
                # A short stream moves the model by its share of a full window's tokens.
                scale = rate * (1 - 0.9 * turn / n) * min(1.0, said[at : at + WINDOW].size / min(streams * WINDOW, whole))
                turn += 1
                self._move(gradients, first, second, np.float32(scale * np.sqrt(1 - 0.99**turn) / (1 - 0.9**turn)))

    def _move(self, gradients: dict[str, np.ndarray], first: dict[str, np.ndarray], second: dict[str, np.ndarray], step: np.float32) -> None:
        """One update by Adam, in place, in pieces that stay in the processor's cache.

        ``first`` and ``second`` hold ten times the running mean and a hundred times that of the squares: their ratio is the same.
        """
        for name in gradients:
            whole = [a.reshape(-1) for a in (gradients[name], first[name], second[name], self.weights[name])]
            for at in range(0, len(whole[0]), MOVED):
                g, one, two, weight = (a[at : at + MOVED] for a in whole)
                one *= np.float32(0.9)
                two *= np.float32(0.99)
                one += g
                np.multiply(g, g, out=g)
                two += g
                np.sqrt(two, out=g)
                g += np.float32(1e-4)
                np.divide(one, g, out=g)
                g *= step
                weight -= g

    def gradients(self, before: np.ndarray, tokens: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Last state, and the mean gradients of one window (steps by streams) with what comes before it held fixed."""
        w, start = self.weights, self.head + TAIL_CLASSES
        steps, wide = tokens.shape
        table, recurrent = self._by_gate()
        hidden = self._room("hidden", (steps, wide, HIDDEN + 1), state.dtype)  # its last column stays one
        olds = self._room("olds", (steps, wide, HIDDEN), state.dtype)
        memories, fresh = [], [np.flatnonzero(inputs == start) for inputs in before]
        for t, inputs in enumerate(before):
            olds[t] = state
            olds[t, fresh[t]] = 0
            state, memory = self._step(table.take(inputs, axis=1), olds[t], recurrent)
            hidden[t, :, :HIDDEN] = state
            memories.append(memory)
        gradients = {k: np.zeros_like(v) for k, v in w.items()}
        _, slope = self._output(hidden.reshape(-1, HIDDEN + 1), tokens.ravel(), gradients)
        slope = slope.reshape(steps, wide, HIDDEN)
        # Four blocks of columns: the new state behind its reset gate, both gates, the new state itself. The first three are
        # the slopes of the recurrent sums, the last three those of the inputs.
        back = self._room("back", (steps, wide, 4 * HIDDEN), state.dtype)
        weight = np.concatenate([w["recurrent"][:, 2 * HIDDEN :], w["recurrent"][:, : 2 * HIDDEN]], axis=1).T.copy()
        later = np.zeros_like(state)
        of_recurrent = np.zeros((3 * HIDDEN, HIDDEN), dtype=state.dtype)
        for t in range(steps - 1, -1, -1):
            keep, reset, inner, new, kept = memories[t]
            d = slope[t] + later
            later = d * keep
            d -= later
            np.multiply(d, kept, out=back[t, :, HIDDEN : 2 * HIDDEN])
            new *= new
            np.subtract(1, new, out=new)
            d *= new
            back[t, :, 3 * HIDDEN :] = d
            d *= reset
            back[t, :, :HIDDEN] = d
            reset *= d
            d -= reset
            np.multiply(d, inner, out=back[t, :, 2 * HIDDEN : 3 * HIDDEN])
            later += back[t, :, : 3 * HIDDEN] @ weight
            of_recurrent += back[t, :, : 3 * HIDDEN].T @ olds[t]
            later[fresh[t]] = 0
        gradients["recurrent"][:, : 2 * HIDDEN] = of_recurrent[HIDDEN:].T
        gradients["recurrent"][:, 2 * HIDDEN :] = of_recurrent[:HIDDEN].T
        self._sum_by_input(back.reshape(-1, 4 * HIDDEN), before.ravel(), gradients["inputs"])
        for g in gradients.values():
            g /= tokens.size
        return state, gradients

    def _sum_by_input(self, back: np.ndarray, inputs: np.ndarray, sums: np.ndarray) -> None:
        """Sums of the last three blocks of ``back`` for each input: inputs that occur equally often are summed together."""
        times = np.bincount(inputs, minlength=len(sums))
        by_times = np.argsort(times, kind="stable")
        rank = np.empty(len(times), dtype=np.int16)
        rank[by_times] = np.arange(len(times))
        order = np.argsort(rank[inputs], kind="stable")
        at = 0
        for n, first, many in zip(*(a.tolist() for a in np.unique(times[by_times], return_index=True, return_counts=True)), strict=True):
            if n:
                block = back.take(order[at : at + many * n], axis=0)[:, HIDDEN:]
                sums[by_times[first : first + many]] = block.reshape(many, n, 3 * HIDDEN).sum(axis=1)
                at += many * n

    def _room(self, name: str, shape: tuple[int, ...], kind: np.dtype) -> np.ndarray:
        """Memory that one window after the other uses, ones at first: asked for anew, it would be handed back and cleared each time."""
        held = self.rooms.get(name)
        if held is None or held.shape != shape or held.dtype != kind:
            held = self.rooms[name] = np.ones(shape, dtype=kind)
        return held

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[n].ravel() for n in NAMES])

    def with_flat(self, values: np.ndarray) -> Gru:
        parts, at = {}, 0
        for name in NAMES:
            shape = self.weights[name].shape
            size = int(np.prod(shape))
            parts[name] = values[at : at + size].astype(np.float32).reshape(shape)
            at += size
        return Gru(self.head, parts)
