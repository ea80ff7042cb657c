"""The gated recurrent network of ``language_model``, in numpy.

A document is a stream of tokens that ends with the end token; the state is
zero behind an end.  Output is factored: a softmax over classes, then one over
the words of the token's class.  Class 0 holds the end token alone, classes
1 to ``CLASSES`` hold the head words by frequency, the rest are the shape
classes of all other words, whose members are not told apart here.
"""

from __future__ import annotations

import functools
import heapq
import math

import numpy as np

HIDDEN, CLASSES, PER_CLASS = 24, 64, 64
HEAD = CLASSES * PER_CLASS
#: last-byte groups of the shape classes; the last is any other byte
ENDINGS = (b".", b",", b"!", b"%", b"&", b"#", b"$", b"*", b"|?;:", b"0123456789", b"aeiou", b"bcdfghjklmnpqrstvwxyz")
SHAPES = 2 * (len(ENDINGS) + 1)
OUTPUTS = 1 + CLASSES + SHAPES
#: input number of the end token, of head word k (1 + k), of shape s (1 + HEAD + s)
INPUTS = 1 + HEAD + SHAPES
#: tokens whose states are kept before their probabilities are taken
STACK = 32_768

_GROUP = np.full(256, len(ENDINGS), dtype=np.int64)
for _k, _chars in enumerate(ENDINGS):
    _GROUP[list(_chars)] = _k


def shape(word: bytes) -> int:
    """The shape class of a word: its last byte's group, and whether it has
    bytes beyond ASCII."""
    return int(_GROUP[word[-1]]) * 2 + (not word.isascii())


def shapes(last: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """The shape classes of words by their last bytes and whether they have
    bytes beyond ASCII."""
    return _GROUP[last] * 2 + wide


def initial(log_share: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Random weights; output biases start at the log shares of the classes
    and, after those, of the head words in their class."""
    rng = np.random.default_rng(seed)
    f = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
    return {"E": f(INPUTS, 3 * HIDDEN, scale=0.1), "U": f(HIDDEN, 3 * HIDDEN, scale=HIDDEN ** -0.5),
            "Wc": f(HIDDEN, OUTPUTS, scale=0.05), "bc": log_share[:OUTPUTS].astype(np.float32),
            "Ww": f(CLASSES, PER_CLASS, HIDDEN, scale=0.05),
            "bw": log_share[OUTPUTS:].reshape(CLASSES, PER_CLASS).astype(np.float32)}


def output_class(x: np.ndarray) -> np.ndarray:
    """The output class of input numbers."""
    return np.where(x == 0, 0, np.where(x <= HEAD, (x - 1) // PER_CLASS + 1, x - HEAD + CLASSES))


def _gates(p: dict, apart: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Input weights gate by gate, so that a step's arrays are contiguous, and
    state weights; those of the two logistic gates are negated.  ``apart``:
    state weights gate by gate too, faster, but rounded in another way, which
    training would carry on."""
    e, u, h = np.ascontiguousarray(p["E"].reshape(-1, 3, HIDDEN).transpose(1, 0, 2)), p["U"].copy(), HIDDEN
    for w in (e[:2], u[:, :2 * h]):
        np.negative(w, out=w)
    return e, np.ascontiguousarray(u.reshape(-1, 3, h).transpose(1, 0, 2)) if apart else u


def _step(p: dict, s: np.ndarray, x: np.ndarray, gates: tuple[np.ndarray, np.ndarray] | None = None):
    """One GRU step: new state and what the backward pass needs."""
    e, u = _gates(p) if gates is None else gates
    g, a = np.take(e, x, axis=1), np.matmul(s, u)
    if a.ndim == 2:
        a = a.reshape(len(s), 3, HIDDEN).transpose(1, 0, 2)
    zr = g[:2]
    zr += a[:2]
    a = np.ascontiguousarray(a[2])
    np.exp(zr, out=zr)
    zr += 1
    np.reciprocal(zr, out=zr)
    z, r = zr
    n = r * a
    n += g[2]
    np.tanh(n, out=n)
    new = s - n
    new *= z
    new += n
    new[x == 0] = 0
    return new, z, r, n, a


#: rows worked through at a time, so that their logits stay in the cache
ROWS = 1024


def _spans(a: int, b: int):
    return [slice(k, min(k + ROWS, b)) for k in range(a, b, ROWS)]


def _by_class(cls: np.ndarray):
    """(class, begin, end) for every head class in sorted classes."""
    cuts = np.searchsorted(cls, np.arange(1, CLASSES + 2)).tolist()
    return [(c, cuts[c], cuts[c + 1]) for c in range(CLASSES) if cuts[c] < cuts[c + 1]]


def _room(room: dict, name: str, shape: tuple, kind) -> np.ndarray:
    """An array with any content out of ``room``: fresh pages for the large
    arrays of every window cost as much as the arithmetic on them."""
    n, have = math.prod(shape), room.get(name)
    if have is None or len(have) < n or have.dtype != kind:
        have = room[name] = np.empty(n, dtype=kind)
    return have[:n].reshape(shape)


def _extended(p: dict) -> tuple[np.ndarray, np.ndarray]:
    """Output weights that take a state with a constant 1 behind it."""
    return np.vstack([p["Wc"], p["bc"]]), np.concatenate([p["Ww"], p["bw"][:, :, None]], axis=2)


def _with_one(s: np.ndarray) -> np.ndarray:
    out = np.ones((len(s), s.shape[1] + 1), dtype=s.dtype)
    out[:, :-1] = s
    return out


def _bounded(weights: np.ndarray, axis: int) -> bool:
    """Whether no state, whose numbers lie between -1 and 1, gives a logit
    beyond 79 with these weights; ``axis`` runs along the state and the 1."""
    return bool(np.abs(weights).sum(axis=axis).max() < 79)


def _safe(logits: np.ndarray) -> np.ndarray:
    """Logits whose exponentials and their row sums neither overflow nor
    vanish: rows are shifted by their largest where any is far from 0."""
    if logits.min() < -80 or logits.max() > 80:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


@functools.cache
def _ones(n: int, kind: np.dtype) -> np.ndarray:
    return np.ones(n, dtype=kind)


@functools.cache
def _numbers() -> np.ndarray:
    return np.arange(ROWS)


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ _ones(x.shape[1], x.dtype)


def token_logprobs(p: dict, s: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Natural log probabilities of tokens ``x`` given the states ``s`` before
    them (for shape classes, of the class)."""
    order = np.argsort(x.astype(np.int16), kind="stable")
    x, s = x[order], _with_one(s[order])
    wc, ww = _extended(p)
    cls, word = output_class(x), (x - 1) % PER_CLASS
    picked, total, room = np.empty(len(x), dtype=s.dtype), np.empty(len(x), dtype=s.dtype), {}

    def add(part, weights, which, bounded):
        logits = np.matmul(s[part], weights, out=_room(room, "q", (part.stop - part.start, weights.shape[1]), s.dtype))
        if not bounded:
            logits = _safe(logits)
        picked[part] = logits[_numbers()[:len(logits)], which[part]]
        total[part] = _row_sums(np.exp(logits, out=logits))

    bounded = _bounded(wc, 0)
    for part in _spans(0, len(x)):
        add(part, wc, cls, bounded)
    lp = picked - np.log(total)
    bounded, begin = _bounded(ww, 2), int(np.searchsorted(cls, 1))
    for c, a, b in _by_class(cls):
        for part in _spans(a, b):
            add(part, ww[c].T, word, bounded)
    end = int(np.searchsorted(cls, CLASSES + 1))
    lp[begin:end] += picked[begin:end] - np.log(total[begin:end])
    out = np.empty_like(lp)
    out[order] = lp
    return out


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents dealt to lanes of about equal length, longest lane first."""
    heap = [(0, k) for k in range(min(lanes, len(lengths)))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-lengths, kind="stable").tolist():
        total, k = heapq.heappop(heap)
        out[k].append(d)
        heapq.heappush(heap, (total + int(lengths[d]), k))
    return sorted(out, key=lambda ds: -sum(int(lengths[d]) for d in ds))


def score_documents(p: dict, docs: list[np.ndarray], lanes: int = 1024) -> np.ndarray:
    """Natural log probability of every token stream (each ending in 0).  The
    lanes run side by side, step by step; a lane's state is carried from token
    to token, so a document of any length is scored as a whole.  The states
    of many steps are stacked before the softmax."""
    total = np.zeros(len(docs))
    if not len(docs):
        return total
    lengths = np.array([len(d) for d in docs], dtype=np.int64)
    deal = lanes_of(lengths, lanes)
    order = np.array([d for ds in deal for d in ds])
    flat = np.concatenate([docs[d] for d in order]).astype(np.int64)
    size = np.array([lengths[ds].sum() for ds in deal])
    start = np.cumsum(size) - size
    #: how many lanes are longer than t, for every step t
    live = np.searchsorted(-size, -np.arange(int(size[0])), side="left").tolist()
    state, gates = np.zeros((len(deal), HIDDEN), dtype=np.float32), _gates(p, apart=True)
    lp = np.empty(len(flat))
    states, places, have = [], [], 0
    for t, w in enumerate(live):
        at = start[:w] + t
        s = state[:w]
        state = _step(p, s, flat[at], gates)[0]
        states.append(s)
        places.append(at)
        have += w
        if have >= STACK or t + 1 == len(live):
            at = np.concatenate(places)
            lp[at] = token_logprobs(p, np.concatenate(states), flat[at])
            states, places, have = [], [], 0
    total[order] = np.add.reduceat(lp, np.cumsum(lengths[order]) - lengths[order])
    return total


def train(p: dict, stream: np.ndarray, lanes: int = 64, back: int = 20, rate: float = 0.08,
          squares: dict | None = None) -> dict:
    """One pass of truncated backpropagation over a token stream, cut into
    up to ``lanes`` parallel streams, what is left over into fewer; states
    carry from window to window, gradients stop at its start.  Adagrad.
    Updates ``p`` in place, and ``squares`` where given."""
    squares, room = start(p) if squares is None else squares, {}
    while len(stream):
        width = min(lanes, max(1, len(stream) // back))
        n = len(stream) // width
        grid = stream[:n * width].reshape(width, n).T
        state = np.zeros((width, HIDDEN), dtype=np.float32)
        for at in range(0, n, back):
            state = _window(p, squares, state, grid[at:at + back], rate, room)
        stream = stream[n * width:]
    return p


def start(p: dict) -> dict[str, np.ndarray]:
    """Adagrad's sums of squares before the first step."""
    return {k: np.full_like(v, 1e-3) for k, v in p.items()}


def _update(p: dict, squares: dict, name: str, grad: np.ndarray, rate: float, at=slice(None)) -> None:
    total = squares[name][at]
    total += grad * grad
    squares[name][at] = total
    step = rate * grad
    step /= np.sqrt(total)
    p[name][at] -= step


def _window(p: dict, squares: dict, state: np.ndarray, grid: np.ndarray, rate: float, room: dict | None = None) -> np.ndarray:
    h, steps, gates, room = HIDDEN, len(grid), _gates(p), {} if room is None else room
    array = lambda name, *shape: _room(room, name, shape, state.dtype)
    past = array("past", steps, *state.shape)
    saved, s = [], state
    for t, x in enumerate(grid):
        past[t] = s
        s, *step = _step(p, s, x, gates)
        saved.append(step)
    x, share = grid.ravel(), np.float32(1.0 / state.shape[0])
    flat = past.reshape(-1, h)
    # tokens in order are classes in order: one sorting serves both layers and the inputs
    order = np.argsort(x.astype(np.int16), kind="stable")
    xs, one, ds = x[order], array("one", len(x), h + 1), array("ds", len(x), h)
    one[:, :h], one[:, h] = np.take(flat, order, axis=0, out=ds, mode="clip"), 1
    cls, word, (wc, ww) = output_class(xs), (xs - 1) % PER_CLASS, _extended(p)
    slope = array("slope", len(x), h)
    slope[...] = 0

    def back(part, weights, which, bounded):
        left = one[part]
        q = np.matmul(left, weights, out=array("q", len(left), weights.shape[1]))
        if not bounded:
            q = _safe(q)
        np.exp(q, out=q)
        q *= (share / _row_sums(q))[:, None]
        q[_numbers()[:len(q)], which[part]] -= share
        slope[part] += q @ weights[:h].T
        return left.T @ q

    def added(parts, weights, which, bounded):
        return functools.reduce(np.add, [back(part, weights, which, bounded) for part in parts])

    gc = added(_spans(0, len(xs)), wc, cls, _bounded(wc, 0))
    used, bounded = _by_class(cls), _bounded(ww, 2)
    gw = [added(_spans(a, b), ww[c].T, word, bounded).T for c, a, b in used]
    ds[order] = slope
    ds = ds.reshape(steps, -1, h)
    dg, da = (array(k, steps, state.shape[0], 3 * h) for k in ("dg", "da"))
    carry = np.zeros_like(state)
    for t in range(steps - 1, -1, -1):
        s0, xt, (z, r, n, a) = past[t], grid[t], saved[t]
        d = carry
        d[xt == 0] = 0
        dn = 1 - z
        dn *= d
        dz = s0 - n
        dz *= z
        dz *= dn
        np.multiply(n, n, out=n)
        np.subtract(1, n, out=n)
        dn *= n
        a *= dn
        dr = 1 - r
        dr *= r
        dr *= a
        g = dg[t]
        g[:, :h], g[:, h:2 * h], g[:, 2 * h:] = dz, dr, dn
        da[t] = g
        dn *= r
        da[t, :, 2 * h:] = dn
        d *= z
        d += da[t] @ p["U"].T
        d += ds[t]
        carry = np.minimum(np.maximum(d, -1, out=d), 1, out=d)
    du = flat.T @ da.reshape(-1, 3 * h)
    begin = np.flatnonzero(np.append(True, xs[1:] != xs[:-1]))
    de = np.add.reduceat(np.take(dg.reshape(-1, 3 * h), order, axis=0, out=array("sorted", len(x), 3 * h), mode="clip"), begin, axis=0)
    _update(p, squares, "E", de, rate, xs[begin])
    _update(p, squares, "U", du, rate)
    _update(p, squares, "Wc", gc[:h], rate)
    _update(p, squares, "bc", gc[h], rate)
    if used:
        at, gw = np.array([c for c, _, _ in used]), np.stack(gw)
        _update(p, squares, "Ww", gw[:, :, :h], rate, at)
        _update(p, squares, "bw", gw[:, :, h], rate, at)
    return s
