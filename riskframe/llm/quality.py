"""Quality classifier: gated attention over the passages of a document (multiple-instance learning).

Every passage of ``PASSAGE`` words is encoded by character and word statistics and a learned layer. A gated
attention (Ilse et al., 2018) weighs the passages: a_k ~ exp(w . (tanh(V h_k) * sigmoid(U h_k))), and the
weighted mean of the encodings is scored. Only documents carry labels; which passages matter is learned.

Training takes at most ``max_labels`` labelled documents, chosen by a hash of their id; all passages of these
documents are used. Scoring covers all documents and whole texts, in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, fresh, stage, text_bytes

PASSAGE = 48
MAX_LABELS = 8_000
_SIGNS = b".,;:!?'\"-%#&$*|@/\\<>{}[]()=+_~^"
_KINDS = np.full(256, 4)
_KINDS[ord("a") : ord("z") + 1] = 0
_KINDS[ord("A") : ord("Z") + 1] = 1
_KINDS[ord("0") : ord("9") + 1] = 2
_KINDS[128:] = 3
for _i, _c in enumerate(_SIGNS):
    _KINDS[_c] = 5 + _i
WIDTH = 5 + len(_SIGNS) + 12


def passages(text: bytes | None, size: int = PASSAGE) -> np.ndarray:
    """One row of statistics for every ``size`` words; a text without words has one row of zeros."""
    lines = (text or b"").split(b"\n")
    words: list[bytes] = []
    line_of: list[int] = []
    seen: dict[bytes, int] = {}
    old_line: list[bool] = []
    for line in lines:
        parts = line.split()
        if parts:
            old = seen.setdefault(b" ".join(parts), len(old_line)) != len(old_line)
            words += parts
            line_of += [len(old_line)] * len(parts)
            old_line.append(old)
    n = len(words)
    if not n:
        return np.zeros((1, WIDTH), np.float32)
    lengths = np.fromiter(map(len, words), np.int64, n)
    kinds = _KINDS[np.frombuffer(b"".join(words), np.uint8)]
    codes: dict[bytes, int] = {}
    code = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    starts = np.arange(0, n, size)
    part = np.arange(n) // size
    m = np.diff(np.append(starts, n)).astype(float)
    mean = lambda values: np.add.reduceat(values, starts, dtype=float) / m
    ends = np.cumsum(lengths)
    lead, tail = kinds[ends - lengths], kinds[ends - 1]
    width = 5 + len(_SIGNS)
    share = np.bincount(np.repeat(part * width, lengths) + kinds, minlength=len(starts) * width).reshape(-1, width)
    share = share / share.sum(axis=1, keepdims=True)
    distinct = np.bincount(np.unique(part * n + code) // n, minlength=len(starts))
    average = mean(lengths)
    columns = (
        np.ones(len(starts)),
        average / 8,
        np.sqrt(np.maximum(mean(lengths * lengths) - average**2, 0)) / 8,
        mean(lengths <= 3),
        distinct / m,
        mean(np.concatenate(([False], code[1:] == code[:-1]))),
        mean(tail >= 4),
        mean(lead >= 4),
        mean(lead == 1),
        mean(np.array(old_line)[np.array(line_of)]),
        mean(np.log1p(np.bincount(code)[code])) / 4,
        np.log1p(m) / 4,
    )
    return np.column_stack((np.sqrt(share), *columns)).astype(np.float32)


@dataclass
class Model:
    """Weights of the encoder, the attention and the score; None of them without training rows."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh(x @ w["E"] + w["e"])
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        raw = (t * s) @ w["w"]
        sizes = np.diff(np.append(starts, len(x)))
        top = np.repeat(np.maximum.reduceat(raw, starts), sizes)
        lift = np.exp(raw - top)
        a = lift / np.repeat(np.add.reduceat(lift, starts), sizes)
        z = np.add.reduceat(h * a[:, None], starts)
        score = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"], -30, 30)))
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "score": score, "sizes": sizes}

    def gradient(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(x, starts)
        d = (f["score"] - y) / len(y)
        dz = np.repeat(d[:, None] * w["c"][None, :], f["sizes"], axis=0)
        da = (dz * f["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(da * f["a"], starts), f["sizes"])
        draw = f["a"] * (da - mean)
        gate = draw[:, None] * w["w"][None, :]
        dv, du = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        dh = (dz * f["a"][:, None] + dv @ w["V"].T + du @ w["U"].T) * (1 - f["h"] ** 2)
        return {"E": x.T @ dh, "e": dh.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du, "w": draw @ (f["t"] * f["s"]), "c": d @ f["z"], "b": d.sum()}

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0, *(len(b) for b in bags[:-1])])
        return self.forward((np.concatenate(bags) - self.mean) / self.scale, starts)["score"].astype(float)


def fit(bags: list[np.ndarray], labels: np.ndarray, *, hidden: int = 32, gates: int = 16, epochs: int = 40, rate: float = 0.01, seed: int = 5) -> Model | None:
    """Adam on the cross entropy of document labels; None without documents."""
    if not bags:
        return None
    rng = np.random.default_rng(seed)
    flat = np.concatenate(bags)
    shapes = {"E": (WIDTH, hidden), "e": (hidden,), "V": (hidden, gates), "U": (hidden, gates), "w": (gates,), "c": (hidden,), "b": ()}
    weights = {k: rng.normal(0, 1 / np.sqrt(max(1, v[0] if v else 1)), v) * (k not in "eb") for k, v in shapes.items()}
    share = np.clip(labels.mean(), 0.01, 0.99)
    weights["b"] = np.asarray(np.log(share / (1 - share)))
    model = Model(flat.mean(axis=0), flat.std(axis=0) + 1e-3, weights)
    data = [((b - model.mean) / model.scale).astype(np.float64) for b in bags]
    first, second, step = {k: 0.0 for k in shapes}, {k: 0.0 for k in shapes}, 0
    for epoch in range(epochs):
        order, speed = rng.permutation(len(data)), rate * (1 - epoch / epochs)
        for at in range(0, len(order), 128):
            some = order[at : at + 128]
            starts = np.cumsum([0, *(len(data[i]) for i in some[:-1])])
            found = model.gradient(np.concatenate([data[i] for i in some]), starts, labels[some])
            step += 1
            for k, g in found.items():
                g = g + 1e-4 * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] = weights[k] - speed * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            model.weights = weights
    return model


def held_out(id_col: str):
    """crc32 of the id as text leaves 1 when divided by 3; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labels: int = MAX_LABELS) -> Model | None:
    """A model from labelled documents that are not held out, at most ``max_labels`` of them.

    Of contradicting labels of one id the smaller counts, of several texts the least; null labels and ids are
    no labels.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("double").alias("_label"))
    known = known.filter(~held_out("_id")).groupBy("_id").agg(F.min("_label").alias("_label")).filter("_id is not null and _label is not null")
    # The bound makes this table small; joins choose it as the small side by its size.
    known = stage(known.orderBy(F.xxhash64("_id"), "_id").limit(max_labels), "labels")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).join(known, "_id")
    texts = texts.groupBy("_id").agg(F.min("_text").alias("_text"), F.min("_label").alias("_label"))
    schema = "_id long, _label double, bag binary"

    def run(batches: Batches) -> Batches:
        out = arrow_type(schema)
        for b in batches:
            yield batch(out, (b.column(0), b.column(2), [passages(t).tobytes() for t in text_bytes(b.column(1))]))

    rows = sorted(texts.mapInArrow(run, schema).collect(), key=lambda r: (r["_id"], bytes(r["bag"])))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in rows]
    return fit(bags, np.array([float(r["_label"] > 0) for r in rows]))


def score(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` (probability of label 1) from the whole text alone, in place of a column of that name.

    Null and empty texts are scored as a passage without words; without a model every score is 0.5.
    """
    kept = docs.drop(score_col)
    columns = kept.columns
    at = columns.index(text_col)
    out = kept.withColumn(score_col, F.lit(0.5)).schema

    def run(batches: Batches) -> Batches:
        for b in batches:
            values = []
            texts = text_bytes(b.column(at))
            for k in range(0, len(texts), 256):
                bags = [passages(t) for t in texts[k : k + 256]]
                values += model.scores(bags).tolist() if model else [0.5] * len(bags)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values, pa.float64())], names=[*columns, score_col])

    return kept.mapInArrow(run, out)


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without those scored below ``threshold``; its columns stay as they are."""
    name = fresh(docs, "score")
    model = train(docs, labels, id_col=id_col, text_col=text_col, **settings)
    scored = score(docs, model, id_col=id_col, text_col=text_col, score_col=name)
    return scored.filter(F.col(name) >= threshold).drop(name)
