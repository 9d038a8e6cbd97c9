"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled windows. It labels every byte
position of a text; a document's probabilities are the means over its positions. Long texts are read in windows that each start
from an empty state, so any number of windows of a block run side by side and memory does not grow with a text's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fold, in_blocks, ship

HIDDEN, WINDOW, CHUNK = 8, 128, 1024
#: The training sample: documents per language, windows per document, characters per window.
SAMPLE_DOCS, SAMPLE_WINDOWS, SAMPLE_CHARS = 150, 6, 96
STEPS, BATCH, RATE, SEED = 250, 64, 0.02, 7
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


class Model(NamedTuple):
    labels: list[str]
    weights: dict[str, np.ndarray]


def _init(classes: int, hidden: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {}
    for d in "fb":
        for gate in "zrn":
            w[f"x{gate}{d}"] = rng.normal(0, 0.3, (256, hidden))
            w[f"u{gate}{d}"] = rng.normal(0, 0.3, (hidden, hidden))
        w[f"xz{d}"] += 1.0  # gates start open towards the past
        w[f"v{d}"] = rng.normal(0, 0.3, (hidden, classes))
    w["c"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in w.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _scan(w: dict[str, np.ndarray], d: str, x: np.ndarray, on: np.ndarray | None, keep: bool = False, flip: bool = False):
    """States after each step over x (steps, rows); ``on`` resets rows to the empty state where it is 0. ``keep``: for training.

    ``flip`` gives the states of the last step first.
    """
    steps, rows = x.shape
    x = x.astype(np.intp)
    xz, xr, xn, uz, ur, un = (w[name + d] for name in ("xz", "xr", "xn", "uz", "ur", "un"))
    h = np.zeros((rows, w["uzf"].shape[0]), np.float32)
    states, kept = np.empty((steps, *h.shape), np.float32), []
    for t in range(steps):
        b = x[t]
        z = _sigmoid(xz.take(b, axis=0) + h @ uz)
        r = _sigmoid(xr.take(b, axis=0) + h @ ur)
        m = h @ un
        n = xn.take(b, axis=0) + r * m
        np.tanh(n, out=n)
        if keep:
            kept.append((h, z, r, m, n))
        h = n + z * (h - n)
        if on is not None:
            h *= on[t][:, None]
        states[steps - 1 - t if flip else t] = h
    return states, kept


def _back(w, d, x, on, kept, grads, dstates) -> None:
    """Backpropagation through time for one direction; adds to ``grads``."""
    dh = np.zeros_like(dstates[0])
    for t in range(len(x) - 1, -1, -1):
        h, z, r, m, n = kept[t]
        dh = (dh + dstates[t]) * on[t][:, None]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * m * r * (1 - r)
        dm = dn * r
        for gate, g in (("z", dz), ("r", dr), ("n", dn)):
            np.add.at(grads[f"x{gate}{d}"], x[t], g)
        grads["uz" + d] += h.T @ dz
        grads["ur" + d] += h.T @ dr
        grads["un" + d] += h.T @ dm
        dh = dh * z + dz @ w["uz" + d].T + dr @ w["ur" + d].T + dm @ w["un" + d].T


def _outputs(w: dict[str, np.ndarray], forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """Class probabilities, classes first: long rows keep the arithmetic on whole cache lines.

    States lie within (-1, 1), so logits stay far from overflow; the clip makes sure of it.
    """
    steps, rows, hidden = forward.shape
    p = w["vf"].T @ forward.reshape(-1, hidden).T
    p += w["vb"].T @ backward.reshape(-1, hidden).T
    p += w["c"][:, None]
    np.clip(p, -60, 60, out=p)
    np.exp(p, out=p)
    p /= p.sum(axis=0)
    return p.reshape(-1, steps, rows)


def _padded(raw: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(steps, rows) bytes and a mask of the same shape."""
    lengths = np.array([len(r) for r in raw])
    x = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw), np.uint8).reshape(len(raw), width).T
    return x, (np.arange(width)[:, None] < lengths).astype(np.float32)


def loss_and_gradients(w: dict[str, np.ndarray], x: np.ndarray, on: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions, each labelled with its window's language, and its gradients."""
    forward, kept_f = _scan(w, "f", x, on, keep=True)
    backward, kept_b = _scan(w, "b", x[::-1], on[::-1], keep=True)
    p = np.moveaxis(_outputs(w, forward, np.ascontiguousarray(backward[::-1])), 0, 2)
    total = on.sum()
    rows = np.arange(len(y))
    loss = -float((np.log(p[:, rows, y] + 1e-9) * on).sum() / total)
    dlogits = p.copy()
    dlogits[:, rows, y] -= 1
    dlogits *= (on / total)[:, :, None]
    grads = {k: np.zeros_like(v) for k, v in w.items()}
    grads["c"] = dlogits.sum(axis=(0, 1))
    grads["vf"] = np.einsum("tbh,tbc->hc", forward, dlogits)
    grads["vb"] = np.einsum("tbh,tbc->hc", backward[::-1], dlogits)
    _back(w, "f", x, on, kept_f, grads, dlogits @ w["vf"].T)
    _back(w, "b", x[::-1], on[::-1], kept_b, grads, (dlogits @ w["vb"].T)[::-1])
    return loss, grads


def fit(windows: list[bytes], labels: list[str], steps: int = STEPS, hidden: int = HIDDEN) -> Model:
    """Adam over random batches that draw every language alike. The same windows give the same weights."""
    names = sorted(set(labels))
    rng = np.random.default_rng(SEED)
    w = _init(len(names), hidden, rng)
    by = [[x for x, l in zip(windows, labels) if l == name and x] for name in names]
    if sum(bool(b) for b in by) < 2:
        return Model(names, w)
    with_rows = [k for k, b in enumerate(by) if b]
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        y = np.array([with_rows[k] for k in rng.integers(0, len(with_rows), BATCH)])
        raw = [by[k][rng.integers(0, len(by[k]))] for k in y]
        x, on = _padded(raw, max(map(len, raw)))
        _, grads = loss_and_gradients(w, x, on, y)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            np.clip(g, -1, 1, out=g)
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            w[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return Model(names, w)


def position_probabilities(model: Model, x: np.ndarray, on: np.ndarray) -> np.ndarray:
    """Class probabilities (classes, steps, rows) at every position of windows."""
    w, mask = model.weights, None if on.all() else on
    forward, _ = _scan(w, "f", x, mask)
    backward, _ = _scan(w, "b", x[::-1], None if mask is None else mask[::-1], flip=True)
    return _outputs(w, forward, backward)


def pooled(model: Model, raw: list[bytes]) -> np.ndarray:
    """Mean probabilities over the positions of each text; zeros for an empty one."""
    data = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.array([len(r) for r in raw], np.int64)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(raw)), counts)
    inside = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * WINDOW
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + inside
    lengths = np.minimum(WINDOW, sizes[owner] - inside)
    out = np.zeros((len(raw), len(model.labels)))
    order = np.argsort(-lengths, kind="stable")  # full windows together: they need no mask
    for k in range(0, len(order), CHUNK):
        rows = order[k:k + CHUNK]
        steps = np.arange(lengths[rows].max())[:, None]
        on = (steps < lengths[rows]).astype(np.float32)
        x = data[np.minimum(starts[rows] + steps, len(data) - 1)]
        p = position_probabilities(model, x, on)
        if not on.all():
            p *= on
        np.add.at(out, owner[rows], p.sum(axis=1).T)
    return out / np.maximum(sizes, 1)[:, None]


def predict(model: Model, texts: list[str]) -> list[tuple[str, float]]:
    """(language, probability); ``und`` and 0 without a letter or without a trained language."""
    known = [bool(model.labels) and LETTER.search(t) is not None for t in texts]
    p = pooled(model, [t.encode() if k else b"" for t, k in zip(texts, known)]) if model.labels else None
    out = []
    for i, k in enumerate(known):
        if not k:
            out.append((UNKNOWN, 0.0))
        else:
            best = int(p[i].argmax())
            out.append((model.labels[best], float(min(1.0, p[i, best]))))
    return out


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[list[bytes], list[str]]:
    """Windows of a bounded sample of labelled learning documents: at most SAMPLE_DOCS for each language, drawn by a hash of id and text.

    Equal rows are collapsed before anything is collected, so a repeated id or text, or many rows without an id, weigh as what they say.
    """
    learn = (docs.filter((fold(id_col, 4) != 2) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))
    counts = {r.lang: r.n for r in learn.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], []
    span = 1 << 30
    draw = F.pmod(F.xxhash64("id", "text", F.lit(SEED)), F.lit(span))
    below = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(span, span * 3 * SAMPLE_DOCS // (2 * n))))])
    window = lambda k: F.substr("text", (F.pmod(F.xxhash64("id", F.lit(k)), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    drawn = (learn.withColumn("draw", draw).filter(F.col("draw") < below[F.col("lang")])
             .select("lang", "draw", "id", F.array(*[window(k) for k in range(SAMPLE_WINDOWS)]).alias("windows")).distinct().collect())
    windows, labels, taken = [], [], dict.fromkeys(counts, 0)
    for r in sorted(drawn, key=lambda r: (r.lang, r.draw, str(r.id), r.windows)):
        if taken[r.lang] < SAMPLE_DOCS:
            taken[r.lang] += 1
            windows += [w.encode() for w in r.windows]
            labels += [r.lang] * len(r.windows)
    return windows, labels


PREDICTION = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    return fit(*sample(docs, id_col, text_col, lang_col))


def identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language and probability of every row of ``docs``, from the text alone.

    A null text, and one without a letter, is ``und`` with score 0; so is everything if nothing could be learned. Of equal
    probabilities the alphabetically first language wins. A null id counts as the empty text for the fold; repeated rows stay;
    other columns are not read.
    """
    ship(docs.sparkSession)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predicted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from in_blocks(columns, lambda part: list(zip(*predict(model, part.to_pylist()))), PREDICTION)

    return (docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, 4) == 2).alias("held_out"), predicted(F.col(text_col)).alias("p"))
            .select("doc_id", "held_out", "p.*"))
