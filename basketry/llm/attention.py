"""A small causal self-attention language model over ids, in numpy.

One attention layer with a learned bias for each distance reads the ids before
a place; its output and the last id's embedding give the next id's class and
its member of the class (ids are split into ``CLASSES`` equal classes by the
company they keep), so a place costs two small softmaxes instead of one over
all ids. Queries, keys and values of an id are rows of tables. Places are put
in the order of their next id's class once, so a class takes one product with
the columns of all classes and of its members side by side.

Long sequences go in windows of ``CONTEXT`` + ``STRIDE`` places that overlap
by CONTEXT, so that each place is scored once, in batches, with a causal mask.
A document begins in a context of end ids.
"""

from __future__ import annotations

import numpy as np

from basketry.llm.shared import ship

ship(__name__)

CLASSES = 32
WIDTH, HEAD = 32, 16
CONTEXT, STRIDE = 8, 24
SPACE = CLASSES * CLASSES  #: ids of the model, the last one stands for all others
LENGTH = CONTEXT + STRIDE
NONE = 65535
AT_ONCE = 192  #: windows scored at a time, which a core's cache holds
BATCH, RATE = 192, 0.01  #: windows of a training step, and its rate at first
MASK = np.where(np.tril(np.ones((LENGTH, LENGTH))) > 0, 0, -1e9).astype(np.float32)[CONTEXT:]
DISTANCE = np.clip(np.arange(CONTEXT, LENGTH)[:, None] - np.arange(LENGTH)[None, :], 0, LENGTH - 1)


def classes(pairs: np.ndarray) -> np.ndarray:
    """A permutation of the ids whose consecutive runs of CLASSES ids are the
    classes: the ids are halved again and again along the main axis of what
    comes before them. pairs[i, j]: how often j follows i."""
    before = np.sqrt(pairs / np.maximum(1, pairs.sum(axis=0, keepdims=True))).T
    after = np.sqrt(pairs / np.maximum(1, pairs.sum(axis=1, keepdims=True)))
    traits = np.concatenate([before, after], axis=1)
    u, s, _ = np.linalg.svd(traits - traits.mean(axis=0), full_matrices=False)
    traits = u[:, :24] * s[:24]

    def split(ids: np.ndarray) -> np.ndarray:
        if len(ids) <= CLASSES:
            return ids
        own = traits[ids] - traits[ids].mean(axis=0)
        axis = np.linalg.svd(own, full_matrices=False)[2][0]
        ids = ids[np.argsort(own @ axis, kind="stable")]
        return np.concatenate([split(ids[:len(ids) // 2]), split(ids[len(ids) // 2:])])

    return split(np.arange(SPACE))


def windows(sequences: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (n, LENGTH), next ids (n, STRIDE) and which of them count."""
    n = np.array([len(ids) + 1 for ids in sequences])
    k = -(-n // STRIDE)
    size = CONTEXT + 1 + k * STRIDE
    begin = np.cumsum(size) - size
    line = np.full(size.sum(), end, np.int32)
    at = np.repeat(begin + CONTEXT + 1 - (np.cumsum(n - 1) - (n - 1)), n - 1)
    at += np.arange(len(at))
    line[at] = np.concatenate(sequences)
    within = (np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)) * STRIDE
    rows = np.lib.stride_tricks.sliding_window_view(line, LENGTH + 1)[np.repeat(begin, k) + within]
    return rows[:, :LENGTH], rows[:, CONTEXT + 1:], np.arange(STRIDE) < (np.repeat(n, k) - within)[:, None]


def packed_windows(sequences: list[np.ndarray], end: int) -> np.ndarray:
    """The windows as rows of LENGTH + 1 ids; ``NONE`` where none counts."""
    x, y, counts = windows(sequences, end)
    return np.concatenate([x[:, :CONTEXT + 1], np.where(counts, y, NONE)], axis=1).astype(np.uint16)


def unpacked_windows(rows: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What :func:`windows` gave for the rows."""
    counts = rows[:, CONTEXT + 1:] != NONE
    ids = np.where(rows == NONE, end, rows).astype(np.int32)
    return ids[:, :LENGTH], ids[:, CONTEXT + 1:], counts


def start(order: np.ndarray, seed: int = 3) -> dict:
    """Fresh weights; ``order`` is the permutation of :func:`classes`."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.normal(size=shape) * 0.1).astype(np.float32)
    place = np.empty(SPACE, np.int32)
    place[order] = np.arange(SPACE)
    return {"place": place, "E": draw(SPACE, WIDTH), "Q": draw(SPACE, HEAD), "K": draw(SPACE, HEAD), "V": draw(SPACE, HEAD),
            "O": draw(HEAD, WIDTH), "D": np.linspace(0, -2, LENGTH).astype(np.float32), "C": draw(WIDTH + 1, CLASSES),
            "M": draw(CLASSES, WIDTH + 1, CLASSES)}


def finished(w: dict) -> dict:
    """The tables that :func:`forward` reads: queries with their scale, keys
    beside values, embeddings with a one for the bias, for each class its logit
    columns beside those of its members, and the factor of each distance, 0 for
    places that come later."""
    kind = w["E"].dtype
    e, o = np.ones((SPACE, WIDTH + 1), kind), np.zeros((HEAD, WIDTH + 1), kind)
    e[:, :WIDTH], o[:, :WIDTH] = w["E"], w["O"]
    both = np.empty((CLASSES, WIDTH + 1, 2 * CLASSES), kind)
    both[:, :, :CLASSES], both[:, :, CLASSES:] = w["C"], w["M"]
    bias = w["D"][DISTANCE] + MASK
    return {"place": w["place"], "q": w["Q"] * kind.type(HEAD ** -0.5), "kv": np.concatenate([w["K"], w["V"]], axis=1),
            "e": e, "o": o, "both": both, "decay": np.exp(bias - bias.max(axis=1, keepdims=True)).astype(kind)}


def tables(w: dict) -> dict:
    """The tables that :func:`probability` reads: what depends on one id, on two
    ids, or on an id and the next id's class alone is worked out once for all.
    near: exp of a query and a key, None where weights are odd; ahead: the
    logits of an id's embedding in each class; after: those of the values."""
    t = finished(w)
    near = t["q"] @ w["K"].T
    ahead = np.matmul(t["e"], t["both"]).transpose(1, 0, 2).reshape(SPACE * CLASSES, -1)
    return {"place": w["place"], "near": None if _far(near) else np.exp(near), "q": t["q"], "K": w["K"], "V": w["V"],
            "decay": t["decay"], "ahead": ahead, "after": np.matmul(t["o"], t["both"])}


def _far(x: np.ndarray) -> bool:
    """Whether a number is far from 0; none is but where weights are odd."""
    return max(x.max(initial=0), -x.min(initial=0)) > 60


def _attention(q: np.ndarray, k: np.ndarray, decay: np.ndarray) -> np.ndarray:
    """What each place gives to those up to it, but for a factor."""
    a = np.matmul(q, k.transpose(0, 2, 1))
    if _far(a):
        a += MASK
        a -= a.max(axis=2, keepdims=True)
    np.exp(a, out=a)
    a *= decay
    return a


def _exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of each run of CLASSES numbers but for a factor, and its sum."""
    runs, ones = x.reshape(-1, CLASSES), np.ones(CLASSES, x.dtype)
    if _far(x):
        runs -= runs.max(axis=1, keepdims=True)
    np.exp(runs, out=runs)
    return x, (runs @ ones).reshape(len(x), -1)


def _by_class(place: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Classes of the next ids in their order, that order of the places, the two
    columns of each among all logits, and where each class begins."""
    place = place.take(y.ravel()).astype(np.uint16)
    order = np.argsort((place // CLASSES).astype(np.uint8), kind="stable")
    place = place.take(order)
    kind = (place // CLASSES).astype(np.intp)
    goal = np.empty((len(place), 2), np.intp)
    row = np.arange(len(place)) * (2 * CLASSES)
    np.add(row, kind, out=goal[:, 0])
    np.add(row, place % CLASSES + CLASSES, out=goal[:, 1])
    return kind, order, goal, np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()


def forward(t: dict, x: np.ndarray, y: np.ndarray) -> dict:
    """All that leads to the probability of each next id, for the tables ``t``
    of :func:`finished`. Places stand in the ``order`` of their next id's class
    (``cuts``: where each begins) from ``h``, the state before them, on: ``p``
    has the exponentials of the classes and of the members, ``total`` their
    sums, ``goal`` where the two numbers of the next id stand."""
    x = x.astype(np.intp)
    now = x[:, CONTEXT:].ravel()
    q = t["q"].take(now, axis=0).reshape(len(x), STRIDE, HEAD)
    kv = t["kv"].take(x, axis=0)
    a = _attention(q, kv[:, :, :HEAD], t["decay"])
    whole = a.reshape(-1, LENGTH) @ np.ones(LENGTH, a.dtype)
    o = np.matmul(a, kv[:, :, HEAD:]).reshape(-1, HEAD)
    o /= whole[:, None]
    kind, order, goal, cuts = _by_class(t["place"], y)
    seen = o.take(order, axis=0)
    h = t["e"].take(now.take(order), axis=0)
    h += seen @ t["o"]
    p = np.empty((len(h), 2 * CLASSES), h.dtype)
    for c, (i, j) in enumerate(zip(cuts, cuts[1:])):
        if j > i:
            np.matmul(h[i:j], t["both"][c], out=p[i:j])
    p, total = _exponentials(p)
    return {"q": q, "kv": kv, "a": a, "whole": whole, "o": o, "order": order, "cuts": cuts, "seen": seen, "h": h,
            "p": p, "total": total, "goal": goal}


def probability(w: dict, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The model's probability of each next id (n, STRIDE); ``w``: the weights,
    or what :func:`tables` makes of them. The same as by :func:`forward`, from
    its products of single ids."""
    t, out = w if "near" in w else tables(w), np.empty(y.shape, np.float32)
    for i in range(0, len(x), AT_ONCE):
        own, to = x[i:i + AT_ONCE].astype(np.intp), out[i:i + AT_ONCE].reshape(-1)
        now = own[:, CONTEXT:]
        if t["near"] is None:
            a = _attention(t["q"].take(now, axis=0), t["K"].take(own, axis=0), t["decay"])
        else:
            a = t["near"].ravel().take(now[:, :, None] * SPACE + own[:, None, :], mode="wrap")
            a *= t["decay"]
        whole = a.reshape(-1, LENGTH) @ np.ones(LENGTH, a.dtype)
        o = np.matmul(a, t["V"].take(own, axis=0)).reshape(-1, HEAD)
        o /= whole[:, None]
        kind, order, goal, cuts = _by_class(t["place"], y[i:i + AT_ONCE])
        p = t["ahead"].take(now.take(order) * CLASSES + kind, axis=0)
        seen, logits = o.take(order, axis=0), np.empty_like(p)
        for c, (j, k) in enumerate(zip(cuts, cuts[1:])):
            if k > j:
                np.matmul(seen[j:k], t["after"][c], out=logits[j:k])
        p += logits
        p, total = _exponentials(p)
        p = p.ravel().take(goal)
        p /= total
        to[order] = p[:, 0] * p[:, 1]
    return out


def _scatter(ids: np.ndarray, grads: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``grads`` by id."""
    out = np.zeros((SPACE, grads.shape[1]), grads.dtype)
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    twos = np.result_type(grads.dtype, np.complex64)  # two numbers are added as one
    out.view(twos)[ids[first]] = np.add.reduceat(grads.take(order, axis=0).view(twos), first, axis=0)
    return out


def gradient(w: dict, x: np.ndarray, y: np.ndarray, counts: np.ndarray, loss: bool = True) -> tuple[float | None, dict]:
    """Mean negative log probability of the places that count (not without
    ``loss``), and its gradient."""
    t = finished(w)
    f = forward(t, x, y)
    a, kv, o, order, h, p = (f[k] for k in ("a", "kv", "o", "order", "h", "p"))
    weight = (counts.ravel() / max(1, counts.sum())).astype(h.dtype)[order][:, None]
    goal, runs = f["goal"], p.reshape(-1, 2, CLASSES)
    own = p.ravel().take(goal)
    mean_loss = float(-(np.log(own / f["total"] + 1e-30) * weight).sum()) if loss else None
    weights = weight / f["total"]
    runs *= weights[:, :, None]
    p.ravel()[goal] = own * weights - weight
    both, dh = np.zeros_like(t["both"]), np.empty((len(p), WIDTH), h.dtype)
    for c, (i, j) in enumerate(zip(f["cuts"], f["cuts"][1:])):
        if j > i:
            np.matmul(h[i:j].T, p[i:j], out=both[c])
            np.matmul(p[i:j], t["both"][c, :WIDTH].T, out=dh[i:j])
    g = {"C": both[:, :, :CLASSES].sum(axis=0), "M": both[:, :, CLASSES:], "O": f["seen"].T @ dh}
    do = np.empty_like(o)
    do[order] = dh @ w["O"].T
    do /= f["whole"][:, None]
    mean = np.einsum("ij,ij->i", do, o).reshape(len(x), STRIDE, 1)
    do = do.reshape(len(x), STRIDE, HEAD)
    da = np.matmul(do, kv[:, :, HEAD:].transpose(0, 2, 1))
    da -= mean
    da *= a
    dkv = np.empty_like(kv)
    np.matmul(da.transpose(0, 2, 1), f["q"], out=dkv[:, :, :HEAD])
    np.matmul(a.transpose(0, 2, 1), do, out=dkv[:, :, HEAD:])
    g["D"] = np.bincount(DISTANCE.ravel(), da.sum(axis=0).ravel(), LENGTH).astype(h.dtype)
    ids = x.astype(np.uint16)
    dkv = _scatter(ids.ravel(), dkv.reshape(-1, 2 * HEAD))
    g["K"], g["V"] = dkv[:, :HEAD], dkv[:, HEAD:]
    ids = ids[:, CONTEXT:].ravel()
    g["Q"] = _scatter(ids, np.matmul(da, kv[:, :, :HEAD]).reshape(-1, HEAD)) * h.dtype.type(HEAD ** -0.5)
    g["E"] = _scatter(ids[order], dh)
    return mean_loss, g


def moments(w: dict) -> dict:
    """Fresh state of Adam: two moments of each weight and the steps so far."""
    names = [n for n in w if n != "place"]
    return {"steps": 0, "first": {n: np.zeros_like(w[n]) for n in names}, "second": {n: np.zeros_like(w[n]) for n in names}}


def keep_freed() -> None:
    """Freeing one large block makes the C library keep freed arrays of a few
    MB for the next step instead of giving them back to the system."""
    np.empty(30 << 20, np.uint8)


def _views(flat: np.ndarray, w: dict, names: list[str]) -> dict:
    """The arrays that lie one after the other in ``flat``, shaped as in ``w``."""
    cuts = np.cumsum([w[n].size for n in names])[:-1]
    return {n: part.reshape(w[n].shape) for n, part in zip(names, np.split(flat, cuts))}


def trained(w: dict, state: dict, rows: np.ndarray, begin: float, upto: float, end: int, passes: int = 1, seed: int = 5) -> tuple[dict, dict]:
    """Adam over all the ``rows`` of :func:`packed_windows`, ``passes`` times in
    random order. begin, upto: the share of the whole training that is done
    before and after; the rate falls to zero with it."""
    rng = np.random.default_rng(seed)
    names = list(state["first"])
    flat, first, second = (np.concatenate([m[n].ravel() for n in names]) for m in (w, state["first"], state["second"]))
    w, slope = {"place": w["place"]} | _views(flat, w, names), np.empty_like(flat)
    keep_freed()
    parts = _views(slope, w, names)
    first *= 10  # sums in place of means
    second *= 50
    step, each = state["steps"], -(-len(rows) // BATCH)
    for one in range(passes):
        for i, pick in enumerate(np.array_split(rng.permutation(len(rows)), each)):
            step += 1
            done = begin + (upto - begin) * (one * each + i) / (passes * each)
            _, g = gradient(w, *unpacked_windows(rows[pick], end), loss=False)
            for n in names:
                parts[n][...] = g[n]
            now = RATE * min(1, step / 50) * (1 - done) * (1 - 0.98 ** step) ** 0.5 / (1 - 0.9 ** step)
            first *= 0.9
            first += slope
            slope *= slope
            second *= 0.98
            second += slope
            np.sqrt(second, out=slope)
            slope += 1e-8 * 50 ** 0.5
            np.divide(first, slope, out=slope)
            slope *= now * 0.1 * 50 ** 0.5
            flat -= slope
    first *= 0.1
    second *= 0.02
    return w, {"steps": step, "first": _views(first, w, names), "second": _views(second, w, names)}
