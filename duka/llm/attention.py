"""A small causal self-attention language model in numpy.

One attention layer with a relative-position bias, one feed-forward layer, and
a two-level output: CLASSES classes of MEMBERS subwords each, first the class,
then the subword in its class. The subwords are dealt to the classes in turn by
falling corpus count; the last place stands for all rarer subwords, among which
one has its (smoothed) corpus frequency. The corpus frequencies of classes and
members are the prior of the output layers.
"""

from __future__ import annotations

import math

import numpy as np

WIDTH = 40          # of the vectors
CLASSES = 64
MEMBERS = 32
FRONT = 512         # subwords with an input row of their own
RARE = 64           # input rows that the others share
STRIDE = 16         # tokens that a window scores
CONTEXT = 16        # tokens before them that it sees as well
SPAN = STRIDE + CONTEXT
BEGIN = FRONT + RARE
PART = 64           # windows computed at once
OFTEN = 16          # places from which an input row is summed by itself
SAFE = 60           # logits up to here need no shift before they are raised
SLICE = 1 << 14     # weights stepped at once


class Vocabulary:
    """Classes of subword ids by corpus counts."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, np.float64) + 0.5
        order = np.lexsort((np.arange(len(counts)), -counts))
        place = np.empty(len(counts), np.int64)
        place[order] = np.arange(len(counts))
        self.input = np.where(place < FRONT, place, FRONT + place % RARE).astype(np.int32)
        slot = np.minimum(place, CLASSES * MEMBERS - 1)
        self.output = slot.astype(np.int32)     # class slot % CLASSES, member slot // CLASSES
        rest = slot == CLASSES * MEMBERS - 1
        self.inside = np.where(rest, np.log(counts / max(1e-9, counts[rest].sum())), 0.0)
        mass = np.bincount(slot, counts, CLASSES * MEMBERS).reshape(MEMBERS, CLASSES).T
        mass = np.maximum(mass, 1e-3)
        self.prior = (np.log(mass.sum(1) / mass.sum()).astype(np.float32),
                      np.log(mass / mass.sum(1, keepdims=True)).astype(np.float32))


def initial(prior: tuple[np.ndarray, np.ndarray], seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    d = WIDTH
    shapes = {"E": (BEGIN + 1, d), "Q": (d, d), "K": (d, d), "V": (d, d), "O": (d, d), "W1": (d, 2 * d),
              "W2": (2 * d, d), "U": (d, CLASSES), "M": (CLASSES, d, MEMBERS)}
    spread = {"E": 0.5, "U": 0.05, "M": 0.05}
    p = {k: (r.standard_normal(s) * spread.get(k, s[0] ** -0.5)).astype(np.float32) for k, s in shapes.items()}
    return p | {"R": np.zeros(SPAN, np.float32), "b1": np.zeros(2 * d, np.float32), "c": prior[0].copy(),
                "m": prior[1].copy()}


_OFFSET = (np.arange(STRIDE) + CONTEXT)[:, None] - np.arange(SPAN)[None]
_CAUSAL = _OFFSET >= 0
_REACH = np.maximum(_OFFSET, 0)
_ONES = np.ones(PART * STRIDE, np.float32)
_ZEROS = np.zeros((PART * STRIDE, 2 * WIDTH), np.float32)


def count(ends: np.ndarray) -> np.ndarray:
    """Windows of each text."""
    return -(-np.diff(np.r_[0, ends]) // STRIDE)


def windows(ends: np.ndarray, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts that end at `ends` in a flat token array: (positions, open,
    live): the SPAN positions of every window (or of `some`, by number), which
    of them lie in the text, and which of the last STRIDE are scored (each
    token once)."""
    starts, n = np.r_[0, ends[:-1]], count(ends)
    last = np.cumsum(n)
    some = np.arange(n.sum()) if some is None else some
    text = np.searchsorted(last, some, "right")
    start, end = starts[text][:, None], ends[text][:, None]
    at = start + STRIDE * (some - (last - n)[text])[:, None] + np.arange(-CONTEXT, STRIDE)[None]
    inside = (at >= start) & (at < end)
    return np.clip(at, 0, max(0, (ends[-1] if len(ends) else 1) - 1), out=at), inside, inside[:, CONTEXT:]


class _Room(dict):
    """Float arrays that are used again, by name."""

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        n = math.prod(shape)
        if name not in self or self[name].size < n:
            self[name] = np.empty(n, np.float32)
        return self[name][:n].reshape(shape)


def _tables(p: dict) -> tuple[np.ndarray, np.ndarray]:
    """Of each input row: itself and its query; its key and its value (with the output weights)."""
    e = p["E"]
    return (np.concatenate([e, e @ (p["Q"] * np.float32(WIDTH ** -0.5))], 1),
            np.concatenate([e @ p["K"], e @ (p["V"] @ p["O"])], 1))


def _mix(p: dict, a: np.ndarray, v: np.ndarray, own: np.ndarray, h: np.ndarray, z: np.ndarray, g: np.ndarray) -> None:
    """States g (windows * STRIDE, WIDTH) from the attention a, which is made to shares here; h and z: what led to them."""
    a *= (1 / (a @ _ONES[:SPAN] + np.float32(1e-30)))[..., None]
    np.matmul(a, v, out=h.reshape(own.shape))
    h.reshape(own.shape)[...] += own
    np.matmul(h, p["W1"], out=z)
    z += p["b1"]
    np.maximum(z, _ZEROS[:len(z)], out=z)
    np.matmul(z, p["W2"], out=g)
    g += h


def _slope(y: np.ndarray, t: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """weight * (softmax of each row, less 1 at column t), written over y."""
    if max(y.max(), -y.min()) > SAFE:
        y -= y.max(1, keepdims=True)
    np.exp(y, out=y)
    y *= (weight / (y @ _ONES[:y.shape[1]]))[:, None]
    y.reshape(-1)[np.arange(len(t)) * y.shape[1] + t] -= weight
    return y


def _row_sums(x: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sums of the values of each input row x."""
    n = np.bincount(x, minlength=rows)
    rank = np.argsort(-n, kind="stable")        # frequent rows first
    place = np.empty(rows, np.int16)
    place[rank] = np.arange(rows, dtype=np.int16)
    order, n = np.argsort(place[x], kind="stable"), n[rank]
    first, out, ones = np.cumsum(n) - n, np.zeros((rows, values.shape[1]), np.float32), np.ones(n[0], np.float32)
    last = np.searchsorted(-n, -np.arange(OFTEN + 1)).tolist()     # rows of more than 0, 1, .. places
    heavy = last[OFTEN]
    for i, (j, k) in enumerate(zip(first[:heavy].tolist(), n[:heavy].tolist())):
        np.matmul(ones[:k], values.take(order[j:j + k], 0), out=out[i])
    for k in range(OFTEN):                      # the k-th place of all others at once
        if last[k] <= heavy:
            break
        out[heavy:last[k]] += values.take(order[first[heavy:last[k]] + k], 0)
    back = np.empty_like(out)
    back[rank] = out
    return back


def _by_class(of: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of the targets by class, and (class, from, to) of the classes that have some."""
    order = np.argsort(of.astype(np.int16), kind="stable")
    cuts = np.r_[0, np.cumsum(np.bincount(of, minlength=CLASSES))].tolist()
    return order, [(c, i, j) for c, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if i < j]


class Scorer:
    """Natural-log probabilities by fixed weights. The attention of one input row to another is a table entry."""

    def __init__(self, p: dict):
        self.p, self.room = p, _Room()
        asking, asked = _tables(p)
        self.own = asking[:, :WIDTH].copy()
        # one more row, of places outside the text, has no weight
        self.share = np.zeros((BEGIN + 1, BEGIN + 2), np.float32)
        np.exp(asking[:, WIDTH:] @ asked[:, :WIDTH].T, out=self.share[:, :-1])
        self.value = np.concatenate([asked[:, WIDTH:], np.zeros((1, WIDTH), np.float32)])
        self.near = np.where(_CAUSAL, np.exp(p["R"][_REACH]), np.float32(0))
        self.c, self.m = np.exp(p["c"]), np.exp(p["m"])

    def __call__(self, x: np.ndarray, inside: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each window's STRIDE targets."""
        p, d, room, size, t = self.p, WIDTH, self.room, len(x), target.reshape(-1)
        of, member = t % CLASSES, t // CLASSES
        hit, total = p["c"][of], np.empty((2, len(t)), np.float32)
        states = room("g", len(t), d)
        asked, x = np.where(inside, x, BEGIN + 1), x[:, CONTEXT:].astype(np.int64)
        for k in range(0, size, PART):
            xq, xk = x[k:k + PART], asked[k:k + PART]
            n, i, j = len(xq), k * STRIDE, (k + len(xq)) * STRIDE
            a, own, v = room("a", n, STRIDE, SPAN), room("own", n, STRIDE, d), room("v", n, SPAN, d)
            self.share.reshape(-1).take((xq * (BEGIN + 2))[..., None] + xk[:, None], out=a, mode="clip")
            a *= self.near
            self.own.take(xq, 0, out=own, mode="clip")
            self.value.take(xk, 0, out=v, mode="clip")
            g = states[i:j]
            _mix(p, a, v, own, room("h", j - i, d), room("z", j - i, 2 * d), g)
            y = np.matmul(g, p["U"], out=room("y", j - i, CLASSES))
            hit[i:j] += y.reshape(-1)[np.arange(j - i) * CLASSES + of[i:j]]
            np.exp(y, out=y)
            np.matmul(y, self.c, out=total[0, i:j])
        order, some = _by_class(of)
        gs, w, sums = states.take(order, 0), room("w", len(t), MEMBERS), np.empty(len(t), np.float32)
        for c, i, j in some:                    # one product per class
            np.matmul(gs[i:j], p["M"][c], out=w[i:j])
        hit[order] += w.reshape(-1)[np.arange(len(t)) * MEMBERS + member[order]]
        np.exp(w, out=w)
        for c, i, j in some:
            np.matmul(w[i:j], self.m[c], out=sums[i:j])
        total[1, order] = sums
        hit += p["m"][of, member]
        return (hit - np.log(total[0]) - np.log(total[1])).reshape(target.shape)


def log_scores(p: dict, x: np.ndarray, inside: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural-log probability of each window's STRIDE targets."""
    return Scorer(p)(x, inside, target)


class Learner:
    """Weights that are fitted with Adam, one batch of windows after the other."""

    def __init__(self, weights: dict):
        ends = np.cumsum([0, *(w.size for w in weights.values())]).tolist()
        self.flat = np.zeros((4, ends[-1]), np.float32)
        self.p, self.m, self.s, self.grad = ({name: f[i:j].reshape(w.shape) for (name, w), i, j in zip(weights.items(), ends, ends[1:])}
                                             for f in self.flat)
        for name, w in weights.items():
            self.p[name][...] = w
        self.steps, self.room = 0, _Room()

    def step(self, x: np.ndarray, ok: np.ndarray, on: np.ndarray, t: np.ndarray, rate: float) -> None:
        """One step along the slope at the input rows x (windows, SPAN) and targets t of the live places `on`; every query
        attends to the positions of its text at or before it."""
        p, d, room, grad, size = self.p, WIDTH, self.room, self.grad, len(x)
        on, t = on.reshape(-1), t.reshape(-1)
        self.flat[3].fill(0)
        of, member = t % CLASSES, t // CLASSES
        weight = (on / max(1, on.sum())).astype(np.float32)
        # inputs are table rows, so their queries, keys and values are too
        (asking, asked), bias, parts = _tables(p), np.where(_CAUSAL, p["R"][_REACH], np.float32(-60)), []
        dg, back = room("dg", len(t), d), np.ascontiguousarray(p["U"].T)
        for n in range(0, size, PART):          # parts whose arrays stay in the cache
            eq, kv, a = (room(name, size, *shape)[n:n + PART] for name, shape in (
                ("eq", (STRIDE, 2 * d)), ("kv", (SPAN, 2 * d)), ("a", (STRIDE, SPAN))))
            asking.take(x[n:n + PART, CONTEXT:], 0, out=eq, mode="clip")
            asked.take(x[n:n + PART], 0, out=kv, mode="clip")
            q, k, v = eq[..., d:], kv[..., :d], kv[..., d:]
            np.matmul(q, k.transpose(0, 2, 1), out=a)
            a += bias
            np.exp(a, out=a)
            a *= ok[n:n + PART, None]
            i, j = n * STRIDE, (n + len(a)) * STRIDE
            h, z, g = (room(name, len(t), width)[i:j] for name, width in (("h", d), ("z", 2 * d), ("g", d)))
            _mix(p, a, v, eq[..., :d], h, z, g)
            y = np.matmul(g, p["U"], out=room("y", j - i, CLASSES))
            y += p["c"]
            y = _slope(y, of[i:j], weight[i:j])
            grad["U"] += g.T @ y
            grad["c"] += _ONES[:j - i] @ y
            np.matmul(y, back, out=dg[i:j])
            parts.append((n, i, j, k, v, q, a, h, z))
        order, some = _by_class(of)
        gs, w, ds = room("g", len(t), d).take(order, 0), room("w", len(t), MEMBERS), room("ds", len(t), d)
        for c, i, j in some:                    # one product per class
            np.matmul(gs[i:j], p["M"][c], out=w[i:j])
        w += p["m"].take(of[order], 0)
        w, back = _slope(w, member[order], weight[order]), np.ascontiguousarray(p["M"].transpose(0, 2, 1))
        for c, i, j in some:
            np.matmul(gs[i:j].T, w[i:j], out=grad["M"][c])
            np.matmul(w[i:j], back[c], out=ds[i:j])
            np.matmul(self.ones(j - i), w[i:j], out=grad["m"][c])
        place = np.empty(len(t), np.int64)
        place[order] = np.arange(len(t))
        dg += ds.take(place, 0)
        dkv, dhq, dr = room("dkv", *x.shape, 2 * d), room("dhq", size, STRIDE, 2 * d), np.zeros((STRIDE, SPAN), np.float32)
        back1, back2 = np.ascontiguousarray(p["W1"].T), np.ascontiguousarray(p["W2"].T)
        for n, i, j, k, v, q, a, h, z in parts:
            dz = np.matmul(dg[i:j], back2, out=room("dz", j - i, 2 * d))
            dz *= z > 0
            grad["W2"] += (dg[i:j].T @ z).T
            grad["W1"] += h.T @ dz
            grad["b1"] += _ONES[:j - i] @ dz
            dh = np.matmul(dz, back1, out=room("dh", j - i, d))
            dh += dg[i:j]
            dh = dh.reshape(q.shape)
            da = np.matmul(dh, v.transpose(0, 2, 1), out=room("da", *a.shape))
            da -= (np.multiply(da, a, out=room("daa", *a.shape)) @ _ONES[:SPAN])[..., None]
            da *= a
            dr += da.sum(0)
            of_kv, of_hq = dkv[n:n + len(q)], dhq[n:n + len(q)]
            np.matmul(da.transpose(0, 2, 1), q, out=of_kv[..., :d])
            np.matmul(a.transpose(0, 2, 1), dh, out=of_kv[..., d:])
            np.matmul(da, k, out=of_hq[..., d:])
            of_hq[..., :d] = dh
        grad["R"] += np.bincount(_REACH.reshape(-1), (dr * _CAUSAL).reshape(-1), SPAN).astype(np.float32)
        # the slopes of an input row's query, key and value are sums over its places
        asked = _row_sums(x.reshape(-1), dkv.reshape(-1, 2 * d), BEGIN + 1)
        asking = _row_sums(x[:, CONTEXT:].reshape(-1), dhq.reshape(-1, 2 * d), BEGIN + 1)
        scale, e = np.float32(d ** -0.5), p["E"]
        values = e.T @ asked[:, d:]
        grad["Q"] += e.T @ asking[:, d:] * scale
        grad["K"] += e.T @ asked[:, :d]
        grad["V"] += values @ p["O"].T
        grad["O"] += p["V"].T @ values
        grad["E"] += (asking[:, :d] + asking[:, d:] @ p["Q"].T * scale + asked[:, :d] @ p["K"].T
                      + asked[:, d:] @ (p["V"] @ p["O"]).T)
        self.steps += 1
        for k in range(0, self.flat.shape[1], SLICE):
            self.adam(*self.flat[:, k:k + SLICE], rate)

    def ones(self, n: int) -> np.ndarray:
        return _ONES[:n] if n <= len(_ONES) else np.ones(n, np.float32)

    def adam(self, p: np.ndarray, m: np.ndarray, s: np.ndarray, g: np.ndarray, rate: float) -> None:
        """The step of some weights p along their slopes g."""
        n, u = self.steps, self.room("adam", len(p))
        m *= np.float32(0.9)
        m += np.multiply(g, np.float32(0.1), out=u)
        s *= np.float32(0.98)
        g *= g
        s += np.multiply(g, np.float32(0.02), out=u)
        np.multiply(s, np.float32(1 / (1 - 0.98 ** n)), out=u)
        np.sqrt(u, out=u)
        u += np.float32(1e-7)
        np.divide(m, u, out=u)
        u *= np.float32(rate / (1 - 0.9 ** n))
        p -= u

    def learn(self, inputs: np.ndarray, targets: np.ndarray, ends: np.ndarray, share: tuple[int, int] = (0, 1),
              repeat: int = 1, most: int = 1, done: float = 0.0, part: float = 1.0, batch: int = 192,
              rate: float = 8e-3, seed: int = 7) -> int:
        """Learn each window of share k of n once, or up to `repeat` times within `most` steps; the
        number of windows. The rate falls over the training's second half; `done` of it is past, this is `part`."""
        order = np.random.default_rng(seed).permutation(count(ends).sum())[share[0]::share[1]]
        if not len(order):
            return 0
        at, inside, live = windows(ends, order)
        x, t = inputs[at], targets[at[:, CONTEXT:]]
        picks = np.tile(np.arange(len(order)), max(1, min(repeat, -(-most * batch // len(order)))))
        for k in range(0, len(picks), batch):
            w = picks[k:k + batch]
            now = min(1.0, 2 * max(0.0, 1 - done - part * k / len(picks)))
            self.step(x[w], inside[w], live[w], t[w], rate * now)
        return len(order)


def train(prior: tuple, inputs: np.ndarray, targets: np.ndarray, ends: np.ndarray, steps: int = 1000,
          batch: int = 192, rate: float = 8e-3, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights fitted to the windows of one token array, in about `steps` steps at least."""
    learner = Learner(initial(prior, seed))
    if len(inputs):
        learner.learn(inputs, targets, ends, repeat=steps * batch, most=steps, batch=batch, rate=rate, seed=seed)
    return learner.p
