"""Language identification by a small convolutional network over bytes, trained and applied in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import col, free_name, slices, text_bytes

WINDOW = 256  # bytes seen at a time
WIDTHS = (2, 3, 4)  # filter widths in bytes
FILTERS = 8  # filters of each width
DIM = 6  # byte embedding
UNKNOWN = "und"


def windows(text: bytes) -> np.ndarray:
    """The whole text as rows of WINDOW bytes; rows overlap by the widest filter less one, the last is zero-filled."""
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(text) - max(WIDTHS) + 1) // step))
    data = np.zeros((n - 1) * step + WINDOW, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, WINDOW)[::step]


@dataclass
class ByteCnn:
    """Embedding, filters of several widths side by side, max over positions, linear layer."""

    labels: list[str]
    embed: np.ndarray  # 256 x DIM
    filters: np.ndarray  # (widest x DIM) x (all filters); rows beyond a filter's width are zero
    bias: np.ndarray
    head: np.ndarray
    head_bias: np.ndarray

    @staticmethod
    def mask() -> np.ndarray:
        m = np.zeros((max(WIDTHS) * DIM, len(WIDTHS) * FILTERS), np.float32)
        for k, w in enumerate(WIDTHS):
            m[: w * DIM, k * FILTERS : (k + 1) * FILTERS] = 1
        return m

    @classmethod
    def fresh(cls, labels: list[str], seed: int) -> ByteCnn:
        rng = np.random.default_rng(seed)
        mask = cls.mask()
        draw = lambda *shape: rng.standard_normal(shape).astype(np.float32)
        return cls(
            labels, draw(256, DIM), mask * draw(*mask.shape) * 0.25, np.zeros(mask.shape[1], np.float32),
            draw(mask.shape[1], len(labels)) * 0.2, np.zeros(len(labels), np.float32),
        )

    def patches(self, rows: np.ndarray) -> np.ndarray:
        """Embedded neighbourhoods of every position: rows x positions x (widest x DIM)."""
        x = self.embed[rows]
        positions = rows.shape[1] - max(WIDTHS) + 1
        return np.concatenate([x[:, j : j + positions] for j in range(max(WIDTHS))], axis=2)

    def pooled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        conv = self.patches(rows) @ self.filters
        return conv, conv.max(axis=1) + self.bias

    def logits(self, rows: np.ndarray, batch: int = 64) -> np.ndarray:
        """Label scores of every window, a few windows at a time so that they stay in the processor's cache."""
        out = np.empty((len(rows), len(self.labels)), np.float32)
        for at in range(0, len(rows), batch):
            part = rows[at : at + batch]
            out[at : at + batch] = np.maximum(self.pooled(part)[1], 0) @ self.head + self.head_bias
        return out

    def fit(self, rows: np.ndarray, target: np.ndarray, epochs: int, seed: int, rate: float = 0.01) -> None:
        """Adam on the cross entropy; gradients reach the filters only at each one's best position."""
        rng = np.random.default_rng(seed)
        names = ("embed", "filters", "bias", "head", "head_bias")
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        mask, step = self.mask(), 0
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), 64):
                pick = order[at : at + 64]
                x, y = rows[pick], target[pick]
                conv, pre = self.pooled(x)
                best = conv.argmax(axis=1)
                hidden = np.maximum(pre, 0)
                p = softmax(hidden @ self.head + self.head_bias)
                p[np.arange(len(y)), y] -= 1
                p /= len(y)
                back = (p @ self.head.T) * (pre > 0)
                spans = x[np.arange(len(y))[:, None, None], best[:, :, None] + np.arange(max(WIDTHS))]
                seen = self.embed[spans].reshape(*best.shape, -1)
                to_embed = (back[:, :, None] * self.filters.T[None]).reshape(*spans.shape, DIM)
                embed = np.zeros_like(self.embed)
                np.add.at(embed, spans, to_embed)
                grads = {
                    "embed": embed,
                    "filters": np.einsum("nf,nfk->kf", back, seen) * mask,
                    "bias": back.sum(axis=0),
                    "head": hidden.T @ p,
                    "head_bias": p.sum(axis=0),
                }
                step += 1
                for n in names:
                    first[n] = 0.9 * first[n] + 0.1 * grads[n]
                    second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                    move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                    setattr(self, n, (getattr(self, n) - rate * move).astype(np.float32))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def sample_windows(
    docs: DataFrame, text: str, label: str, key: str, learn: Column, per_label: int, per_document: int
) -> list[tuple[str, list[bytes]]]:
    """A bounded sample of labelled documents, each as a few windows spread over its text.

    Documents are taken by the hash of their key, about ``per_label`` of each label
    (all of them when there are fewer), so the sample does not depend on partitioning.
    """
    labelled = docs.select(col(label).cast("string").alias("label"), col(text).alias("text"), col(key).cast("string").alias("key"))
    labelled = labelled.filter(learn & F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rank = F.pmod(F.xxhash64("key", F.length("text")), F.lit(1 << 30))
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.lit(0)
    for name, n in counts.items():
        share = F.when(F.col("label") == name, min(1 << 30, int((1 << 30) * 1.2 * per_label / n))).otherwise(share)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for b in text_bytes(batch.column("text")):
                w = windows(b)
                pick = np.unique(np.linspace(0, len(w) - 1, per_document).astype(int))
                rows.append([bytes(w[i]) for i in pick])
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("rank"), pa.array(rows, pa.list_(pa.binary()))],
                ["label", "rank", "windows"],
            )

    picked = labelled.withColumn("rank", rank).filter(F.col("rank") < share).select("label", "rank", "text")
    rows = picked.mapInArrow(cut, "label string, rank long, windows array<binary>").collect()
    out: list[tuple[str, list[bytes]]] = []
    taken: dict[str, int] = {}
    for r in sorted(rows, key=lambda r: (r["label"], r["rank"], r["windows"])):
        taken[r["label"]] = taken.get(r["label"], 0) + 1
        if taken[r["label"]] <= per_label:
            out.append((r["label"], [bytes(w) for w in r["windows"]]))
    return out


def train(sample: list[tuple[str, list[bytes]]], epochs: int = 6, seed: int = 7) -> ByteCnn | None:
    """Fit the network on sampled windows; None when there is nothing to learn from."""
    if not sample:
        return None
    labels = sorted({name for name, _ in sample})
    rows = np.stack([np.frombuffer(w, np.uint8) for _, ws in sample for w in ws])
    target = np.array([labels.index(name) for name, ws in sample for _ in ws])
    model = ByteCnn.fresh(labels, seed)
    model.fit(rows, target, epochs, seed)
    return model


def identify_language(
    docs: DataFrame,
    *,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    learn: Column | None = None,
    per_label: int = 300,
    per_document: int = 4,
    epochs: int = 6,
) -> DataFrame:
    """Add ``lang_pred`` (string) and ``lang_score`` (0 to 1) to every row of ``docs``.

    Trains on at most ``per_label`` documents of each label (rows for which ``learn`` is
    true and the label is not null), ``per_document`` windows of 256 bytes each; that is
    the only bounded sample. Prediction reads whole texts in windows and averages their
    scores. A null text, one without a letter, and every text when there is no labelled
    row get ``und`` and 0. Repeated rows stay and get equal results; columns that already
    have the result names are replaced. An empty table gives no rows.
    """
    learn = F.lit(True) if learn is None else learn
    model = train(sample_windows(docs, text, label, key, learn, per_label, per_document), epochs)
    docs = docs.drop("lang_pred", "lang_score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "lang_score": F.lit(0.0)})
    known = free_name(docs, "has_letter")
    flagged = docs.withColumn(known, F.coalesce(col(text).rlike(r"\p{L}"), F.lit(False)))
    schema = docs.withColumns({"lang_pred": F.lit(""), "lang_score": F.lit(0.0)}).schema
    columns = docs.columns

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = text_bytes(batch.column(text))
            found = np.flatnonzero(batch.column(known).to_numpy(zero_copy_only=False))
            rows = [windows(texts[i]) for i in found]
            names, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            if rows:
                starts = np.cumsum([0, *(len(r) for r in rows[:-1])])
                total = np.add.reduceat(model.logits(np.concatenate(rows)), starts, axis=0)
                p = softmax(total.astype(np.float64) / np.array([[len(r)] for r in rows]))
                for i, best, value in zip(found, p.argmax(axis=1), p.max(axis=1)):
                    names[i], scores[i] = model.labels[best], min(1.0, float(value))
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*columns, "lang_pred", "lang_score"],
            )

    return flagged.mapInArrow(predict, schema)
