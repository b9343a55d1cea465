"""A small gated recurrent language model in numpy, with a class-factored output.

Token ids are ranks by frequency; id 0 ends a document and also stands before its first
token. Ids are cut into classes of equal size in this order; the last id stands for all
rare words and is a class of its own.
"""

from __future__ import annotations

import numpy as np

#: Tokens whose logits are worked out at a time, so that these stay in the cache.
BLOCK = 1 << 11
SHAPES = ("embed", "input", "bias", "state", "classes", "class_bias", "words", "word_bias")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class GatedModel:
    def __init__(self, size: int, members: int = 32, width: int = 12, flat: np.ndarray | None = None) -> None:
        self.size, self.members, self.width = size, members, width
        self.rare = size - 1
        self.groups = -(-self.rare // members) + 1
        shapes = {
            "embed": (size, width),
            "input": (width, 3 * width),
            "bias": (3 * width,),
            "state": (width, 3 * width),
            "classes": (width, self.groups),
            "class_bias": (self.groups,),
            "words": (self.groups - 1, width, members),
            "word_bias": (self.groups - 1, members),
        }
        ends = np.cumsum([int(np.prod(s)) for s in shapes.values()])
        self.length = int(ends[-1])
        self.flat = np.zeros(self.length, np.float32) if flat is None else flat.astype(np.float32)
        self.views, self.slots = {}, {}
        for (name, shape), end in zip(shapes.items(), ends.tolist(), strict=True):
            self.slots[name] = slice(end - int(np.prod(shape)), end)
            self.views[name] = self.flat[self.slots[name]].reshape(shape)
        last = self.rare - (self.groups - 2) * members
        self.absent = np.zeros((self.groups - 1, members), np.float32)
        self.absent[-1, last:] = -1e9

    @classmethod
    def start(cls, counts: np.ndarray, members: int = 32, width: int = 12) -> GatedModel:
        """Random small weights; output biases that give the counted frequencies."""
        model = cls(len(counts), members, width)
        draw = np.random.default_rng(1)
        for name in ("embed", "input", "state", "classes", "words"):
            model.views[name][:] = draw.normal(0, 0.1, model.views[name].shape)
        padded = np.full((model.groups - 1) * members, 1e-9)
        padded[: model.rare] = counts[:-1] + 0.5
        padded = padded.reshape(-1, members)
        model.views["word_bias"][:] = np.log(padded / padded.sum(axis=1, keepdims=True)) * (padded > 1e-6)
        total = np.r_[padded.sum(axis=1), counts[-1] + 0.5]
        model.views["class_bias"][:] = np.log(total / total.sum())
        return model

    def step(self, given: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state of each row, and what led to it."""
        return tuple(x.T for x in self.step_columns(given.T, state.T))

    def step_columns(self, given: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """A step with a column for each lane, so that sums and slices run over long rows."""
        w = self.width
        inner = self.views["state"].T @ state
        gates = sigmoid(given[: 2 * w] + inner[: 2 * w])
        keep, reset = gates[:w], gates[w:]
        fresh = np.tanh(given[2 * w :] + reset * inner[2 * w :])
        return fresh + keep * (state - fresh), keep, reset, fresh, inner[2 * w :]

    def by_class(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Class of each target, places in the order of classes, and (class, start, end) there of those with words."""
        group = np.where(targets == self.rare, self.groups - 1, targets // self.members).astype(np.uint16)
        order = np.argsort(group, kind="stable")
        edges = np.searchsorted(group[order], np.arange(self.groups)).tolist()
        return group, order, [(c, lo, hi) for c, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if hi > lo]

    def log_probability(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probability of each target after its state."""
        return self.log_probability_columns(states.T, targets)

    def log_probability_columns(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        group, order, parts = self.by_class(targets)
        out = np.empty(len(targets), np.float32)
        for lo in range(0, len(out), BLOCK):
            cut = slice(lo, lo + BLOCK)
            logits = self.views["classes"].T @ states[:, cut]
            logits += self.views["class_bias"][:, None]
            logits -= logits.max(axis=0)
            out[cut] = logits[group[cut], np.arange(logits.shape[1])]
            out[cut] -= np.log(np.exp(logits, out=logits).sum(axis=0))
        dealt = np.take(states, order, axis=1)
        for c, lo, hi in parts:
            for start in range(lo, hi, BLOCK):
                at = order[start : min(start + BLOCK, hi)]
                inner = self.views["words"][c].T @ dealt[:, start : start + len(at)]
                inner += (self.views["word_bias"][c] + self.absent[c])[:, None]
                inner -= inner.max(axis=0)
                own = inner[targets[at] - c * self.members, np.arange(len(at))]
                out[at] += own - np.log(np.exp(inner, out=inner).sum(axis=0))
        return out

    def gradient(self, before: np.ndarray, targets: np.ndarray, first: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the mean loss of one window (steps x lanes), and the state after it."""
        v, w = self.views, self.width
        steps, lanes = targets.shape
        grad = np.zeros(self.length, np.float32)
        g = {name: grad[slot].reshape(v[name].shape) for name, slot in self.slots.items()}
        ids = before.reshape(-1)
        x = np.take(np.ascontiguousarray(v["embed"].T), ids, axis=1)
        given = (v["input"].T @ x + v["bias"][:, None]).reshape(3 * w, steps, lanes)
        state = np.ascontiguousarray(state.T)
        kept, states, earlier = [], np.empty((w, steps, lanes), np.float32), np.empty((w, steps, lanes), np.float32)
        for t in range(steps):
            earlier[:, t] = state = np.where(first[t], np.float32(0), state)
            new, *rest = self.step_columns(given[:, t], state)
            kept.append((state, *rest))
            state = states[:, t] = new
        flat, goal = states.reshape(w, -1), targets.reshape(-1)
        n = np.float32(len(goal))
        group, order, parts = self.by_class(goal)
        back = np.empty_like(flat)
        for lo in range(0, len(goal), BLOCK):
            cut = slice(lo, lo + BLOCK)
            share = v["classes"].T @ flat[:, cut]
            share += v["class_bias"][:, None]
            share -= share.max(axis=0)
            np.exp(share, out=share)
            share /= share.sum(axis=0) * n
            share[group[cut], np.arange(share.shape[1])] -= 1 / n
            g["classes"] += flat[:, cut] @ share.T
            g["class_bias"] += share.sum(axis=1)
            back[:, cut] = v["classes"] @ share
        dealt = np.take(flat, order, axis=1)
        own = np.zeros_like(dealt)
        for c, lo, hi in parts:
            inner = v["words"][c].T @ dealt[:, lo:hi]
            inner += (v["word_bias"][c] + self.absent[c])[:, None]
            inner -= inner.max(axis=0)
            np.exp(inner, out=inner)
            inner /= inner.sum(axis=0) * n
            inner[goal[order[lo:hi]] - c * self.members, np.arange(hi - lo)] -= 1 / n
            g["words"][c] = dealt[:, lo:hi] @ inner.T
            g["word_bias"][c] = inner.sum(axis=1)
            own[:, lo:hi] = v["words"][c] @ inner
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        back += np.take(own, place, axis=1)
        back = back.reshape(w, steps, lanes)
        to_given, to_inner = np.empty_like(given), np.empty_like(given)
        later = np.zeros((w, lanes), np.float32)
        for t in range(steps - 1, -1, -1):
            state_t, keep, reset, fresh, inner = kept[t]
            now = back[:, t] + later
            d_fresh = now * (1 - keep) * (1 - fresh * fresh)
            d_keep = now * (state_t - fresh) * keep * (1 - keep)
            d_reset = d_fresh * inner * reset * (1 - reset)
            to_given[:w, t], to_given[w : 2 * w, t], to_given[2 * w :, t] = d_keep, d_reset, d_fresh
            to_inner[:w, t], to_inner[w : 2 * w, t], to_inner[2 * w :, t] = d_keep, d_reset, d_fresh * reset
            later = now * keep + v["state"] @ to_inner[:, t]
            later[:, first[t]] = 0
        g["state"][:] = earlier.reshape(w, -1) @ to_inner.reshape(3 * w, -1).T
        flat_given = to_given.reshape(3 * w, -1)
        g["input"][:] = x @ flat_given.T
        g["bias"][:] = flat_given.sum(axis=1)
        for k, d_x in enumerate(v["input"] @ flat_given):
            g["embed"][:, k] = np.bincount(ids, weights=d_x, minlength=self.size)
        return grad, state.T


def lanes(lengths: np.ndarray, count: int) -> list[list[int]]:
    """Documents dealt to lanes of about equal length, the fullest lane first."""
    import heapq

    heap = [(0, k) for k in range(max(1, min(count, len(lengths))))]
    dealt: list[list[int]] = [[] for _ in heap]
    for row in np.argsort(-lengths, kind="stable").tolist():
        load, k = heapq.heappop(heap)
        dealt[k].append(row)
        heapq.heappush(heap, (load + int(lengths[row]), k))
    return sorted(dealt, key=lambda rows: -int(lengths[rows].sum()))


class Lanes:
    """Documents side by side: step ``t`` holds a token of each of the first ``active[t]`` lanes."""

    def __init__(self, documents: list[np.ndarray], count: int) -> None:
        lengths = np.array([len(d) for d in documents], np.int64)
        self.dealt = lanes(lengths, count)
        sizes = [int(lengths[rows].sum()) for rows in self.dealt]
        self.tokens = np.zeros((max(sizes), len(sizes)), np.int32)
        self.first = np.zeros(self.tokens.shape, bool)
        self.starts = np.zeros(len(documents), np.int64)
        self.lane = np.zeros(len(documents), np.int64)
        for k, rows in enumerate(self.dealt):
            at = 0
            for row in rows:
                self.tokens[at : at + lengths[row], k] = documents[row]
                self.first[at, k] = True
                self.starts[row], self.lane[row] = at, k
                at += int(lengths[row])
        self.before = np.zeros_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[self.first] = 0
        self.active = np.searchsorted(-np.array(sizes), -np.arange(len(self.tokens)), side="left")
        self.lengths = lengths


def learn(
    model: GatedModel, documents: list[np.ndarray], past: np.ndarray, count: int = 512, window: int = 16, rate: float = 0.05
) -> int:
    """One pass over all documents by truncated backpropagation; the number of tokens.

    Every document is run through whole, its state going on from window to window;
    every window gives a gradient, which ends at the window's start. ``past`` sums
    squared gradients, by which the steps of each weight are scaled.
    """
    table = Lanes(documents, count)
    state = np.zeros((len(table.dealt), model.width), np.float32)
    total = len(table.tokens)
    for at in range(0, total, window):
        end = min(at + window, total)
        wide = int(table.active[end - 1])
        cut = slice(at, end), slice(0, wide)
        grad, state = model.gradient(table.before[cut], table.tokens[cut], table.first[cut], state[:wide])
        grad *= np.float32(min(1.0, 1.0 / (float(np.sqrt((grad * grad).sum())) + 1e-9)))
        past += grad * grad
        model.flat -= np.float32(rate) * grad / np.sqrt(past)
    return int(table.lengths.sum())


def score(model: GatedModel, documents: list[np.ndarray], count: int = 1024, block: int = 64) -> np.ndarray:
    """Natural log probability of each whole document, its state carried from start to end."""
    out = np.zeros(len(documents))
    if not documents:
        return out
    table = Lanes(documents, count)
    given_of = np.ascontiguousarray((model.views["embed"] @ model.views["input"] + model.views["bias"]).T)
    state = np.zeros((model.width, len(table.dealt)), np.float32)
    sums = np.zeros((len(table.tokens) + 1, len(table.dealt)))
    for at in range(0, len(table.tokens), block):
        end = min(at + block, len(table.tokens))
        kept, goals, places = [], [], []
        for t in range(at, end):
            wide = int(table.active[t])
            state = np.where(table.first[t, :wide], np.float32(0), state[:, :wide])
            state = model.step_columns(np.take(given_of, table.before[t, :wide], axis=1), state)[0]
            kept.append(state)
            goals.append(table.tokens[t, :wide])
            places.append((t + 1, wide))
        values = model.log_probability_columns(np.concatenate(kept, axis=1), np.concatenate(goals))
        done = 0
        for t, wide in places:
            sums[t, :wide] = values[done : done + wide]
            done += wide
    np.cumsum(sums, axis=0, out=sums)
    return sums[table.starts + table.lengths, table.lane] - sums[table.starts, table.lane]
