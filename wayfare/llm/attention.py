"""A small causal self-attention model in numpy: one layer, one head, over classes of subword ids.

``forward`` gives the log-probability of every token's class from the tokens
before it in its window; ``train`` fits the weights by Adam. All arrays are single
precision.
"""

from __future__ import annotations

import numpy as np

#: a window scores its last WINDOW - CONTEXT tokens; the others are context that the window before scored
WIDTH, HIDDEN, WINDOW, CONTEXT = 16, 32, 32, 4


def initial(inputs: int, classes: int, seed: int = 5) -> dict[str, np.ndarray]:
    """Small random weights; the output starts at nothing, so that ``follow`` alone speaks."""
    rng = np.random.default_rng(seed)
    draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    return {
        "embed": (rng.standard_normal((inputs, WIDTH)) * 0.3).astype(np.float32),
        "place": (rng.standard_normal((WINDOW, WIDTH)) * 0.1).astype(np.float32),
        "attend": draw(WIDTH, 3 * WIDTH),
        "mix": draw(2 * WIDTH, HIDDEN), "lift": np.zeros(HIDDEN, np.float32),
        "out": np.zeros((HIDDEN, classes), np.float32),
    }


_MASK = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_LATER = np.triu(np.full((WINDOW, WINDOW), -1e30, np.float32), 1)
_SCALE = np.float32(1 / np.sqrt(WIDTH))
_ACROSS = np.arange(WIDTH)



def _layers(w: dict, x_ids: np.ndarray, bound: bool = True):
    """``x_ids`` (B, T): the input at each place, which already precedes the token to predict.

    Attention is ``exp`` of scores, masked, and divided by its sum after the
    values are mixed: fewer passes over the (B, T, T) table. ``bound`` takes the greatest
    score off first, which keeps any weights in range.
    """
    b, t = x_ids.shape
    x = np.take(w["embed"], x_ids, axis=0)
    xp = x + w["place"][:t]
    qkv = (xp.reshape(-1, WIDTH) @ w["attend"]).reshape(b, t, 3 * WIDTH)
    q, k = qkv[:, :, :WIDTH] * _SCALE, qkv[:, :, WIDTH : 2 * WIDTH]
    v = np.ones((b, t, WIDTH + 1), np.float32)
    v[:, :, :WIDTH] = qkv[:, :, 2 * WIDTH :]
    a = np.matmul(q, k.transpose(0, 2, 1))
    if bound:
        a += _LATER[:t, :t]
        a -= a.max(axis=2, keepdims=True)
    np.exp(a, out=a)
    a *= _MASK[:t, :t]
    c = np.matmul(a, v)
    total = c[:, :, WIDTH:]
    both = np.empty((b, t, 2 * WIDTH), np.float32)
    both[:, :, :WIDTH] = x
    np.divide(c[:, :, :WIDTH], total, out=both[:, :, WIDTH:])
    both = both.reshape(-1, 2 * WIDTH)
    h = both @ w["mix"]
    h += w["lift"]
    np.maximum(h, 0, out=h)
    return xp, q, k, v[:, :, :WIDTH], a, total, both, h


def _class_scores(w: dict, follow: np.ndarray, x_ids: np.ndarray, before: np.ndarray, y: np.ndarray, bound: bool):
    b, t = x_ids.shape
    n = y.shape[1]
    h = _layers(w, x_ids, bound)[-1].reshape(b, t, HIDDEN)[:, t - n :].reshape(-1, HIDDEN)
    z = h @ w["out"]
    z += np.take(follow, before.ravel(), axis=0)
    if bound:
        z -= z.max(axis=1, keepdims=True)
    flat = y.ravel()
    own = z[np.arange(len(flat)), flat]
    np.exp(z, out=z)
    return (own - np.log(z @ np.ones(z.shape[1], np.float32))).reshape(y.shape)


def log_probabilities(w: dict, follow: np.ndarray, x_ids: np.ndarray, before: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural log-probability of the classes ``y`` (B, n) at the last n places of each window.

    ``before`` (B, n) is the class of the token before each, and ``follow`` the log of how
    often classes follow each other, to which the layers add what the context tells.
    """
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        out = _class_scores(w, follow, x_ids, before, y, bound=False)
    return out if np.isfinite(out).all() else _class_scores(w, follow, x_ids, before, y, bound=True)


def gradients(w: dict, follow: np.ndarray, x_ids: np.ndarray, before: np.ndarray, y: np.ndarray, real: np.ndarray) -> tuple[dict, float]:
    """Mean loss over the ``real`` places and its gradients; ``follow`` stays as it was counted.

    Large tables are worked on in place. The order of every sum is kept: Adam makes
    whole steps of differences in rounding.
    """
    b, t = x_ids.shape
    xp, q, k, v, a, total, both, h = _layers(w, x_ids)
    a /= total
    p = h @ w["out"]
    p += np.take(follow, before.ravel(), axis=0)
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    flat, on = y.ravel(), real.ravel().astype(np.float32)
    n = max(float(on.sum()), 1.0)
    rows = np.arange(len(flat))
    own = p[rows, flat]
    loss = float(-(np.log(own + 1e-20) * on).sum() / n)
    p[rows, flat] = own - 1
    p *= (on / n)[:, None]
    g = {"out": h.T @ p}
    dh = p @ w["out"].T
    dh *= h > 0
    g["mix"], g["lift"] = both.T @ dh, dh.sum(axis=0)
    dboth = (dh @ w["mix"].T).reshape(b, t, 2 * WIDTH)
    dx, dc = dboth[:, :, :WIDTH].copy(), dboth[:, :, WIDTH:]
    ds = np.matmul(dc, v.transpose(0, 2, 1))
    ds -= (ds * a).sum(axis=2, keepdims=True)
    ds *= a
    dqkv = np.empty((b, t, 3 * WIDTH), np.float32)
    np.multiply(np.matmul(ds, k), _SCALE, out=dqkv[:, :, :WIDTH])
    dqkv[:, :, WIDTH : 2 * WIDTH] = np.matmul(ds.transpose(0, 2, 1), q)
    dqkv[:, :, 2 * WIDTH :] = np.matmul(a.transpose(0, 2, 1), dc)
    dqkv = dqkv.reshape(-1, 3 * WIDTH)
    g["attend"] = xp.reshape(-1, WIDTH).T @ dqkv
    dxp = (dqkv @ w["attend"].T).reshape(b, t, WIDTH)
    g["place"] = np.zeros_like(w["place"])
    g["place"][:t] = dxp.sum(axis=0)
    dx += dxp
    # by flat places: numpy adds at single numbers far faster than at rows
    g["embed"] = np.zeros_like(w["embed"])
    np.add.at(g["embed"].reshape(-1), (x_ids.reshape(-1, 1) * WIDTH + _ACROSS).ravel(), dx.ravel())
    return g, loss


def train(
    w: dict, follow: np.ndarray, x_ids: np.ndarray, before: np.ndarray, y: np.ndarray, real: np.ndarray,
    rate: float, seed: int, batch: int = 32,
) -> dict:
    """One pass of Adam over the windows in seeded order; all weights lie in one array, of which ``w`` holds views."""
    flat = np.concatenate([v.ravel() for v in w.values()])
    g, m, s, by = (np.zeros_like(flat) for _ in range(4))
    wide = np.zeros(len(flat))
    new, slope, at = {}, {}, 0
    for n, v in w.items():
        new[n], slope[n] = (f[at : at + v.size].reshape(v.shape) for f in (flat, g))
        at += v.size
    order, step = np.random.default_rng(seed).permutation(len(x_ids)), 0
    for at in range(0, len(order), batch):
        own = order[at : at + batch]
        found, _ = gradients(new, follow, x_ids[own], before[own], y[own], real[own])
        for n, v in found.items():
            slope[n][...] = v
        step += 1
        scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        np.subtract(g, m, out=by)
        by *= 0.1
        m += by
        g *= g
        g -= s
        g *= 0.001
        s += g
        np.sqrt(s, out=g)
        g += 1e-8
        # in double precision until the step is taken
        np.multiply(m, scale, out=wide)
        wide /= g
        flat -= wide.astype(np.float32)
    return new
