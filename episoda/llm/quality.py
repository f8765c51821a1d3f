"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, filters of 8 bytes run over the text every 4 bytes, and their rectified responses are max-pooled over overlapping chunks
(256 bytes, half of them shared with the next chunk) that cover the whole document. A small dense layer describes each chunk; chunk
descriptions are max-pooled and averaged over the document and combined into one probability. Training reads whole texts too: of at most
`sample` labelled documents, in the order of a hash of their ids, those that together hold at most `sample_bytes` (a document that no longer
fits is passed over, shorter ones after it are not), so the driver's memory is bounded however long the texts are.
Scoring reads every byte of every text, long ones window by window with a running maximum and sum, so memory does not grow with a text.

Defined results: null or empty text is one chunk of zero bytes and gets a score like any other; without labelled rows of both kinds every
score is 0.5; ids labelled with both or other values are not trained on; equal texts get equal scores, repeated rows each; a score of exactly
the threshold is kept; a null id is kept (and counts as the empty text for the held-out rule); `score` replaces a column quality_score;
further columns of any name are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episoda.llm import common

CHUNK, HOP, STRIDE = 256, 128, 4
EMBED, FILTERS, HIDDEN = 8, 40, 24
FOLDS, THRESHOLD = 5, 0.3
SAMPLE, SAMPLE_BYTES, EPOCHS, BATCH = 8000, 16 << 20, 4, 16

_HALF = HOP // STRIDE  # filter positions in half a chunk
_WINDOW = 2048  # chunks of a long text that are looked at together
_TRAINED = 128  # chunks that training looks at together: their intermediate results stay in the processor's cache


def _blocks(raw: bytes) -> np.ndarray:
    """Bytes padded with zeros to whole half chunks, at least one whole chunk."""
    n = max(2, -(-len(raw) // HOP)) * HOP
    out = np.zeros(n, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out


class Network:
    """Parameters and both directions. A filter of 8 bytes at stride 4 is two dense maps of 4-byte cells, one of them shifted."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        cell = EMBED * STRIDE
        self.p = {
            "embed": draw(256, EMBED, scale=0.5),
            "left": draw(cell, FILTERS, scale=(2 / (2 * cell)) ** 0.5),
            "right": draw(cell, FILTERS, scale=(2 / (2 * cell)) ** 0.5),
            "shift": np.zeros(FILTERS, np.float32),
            "dense": draw(FILTERS + 1, HIDDEN, scale=(2 / FILTERS) ** 0.5),
            "bias": np.zeros(HIDDEN, np.float32),
            "out": draw(2 * HIDDEN, scale=0.3),
            "level": np.zeros(1, np.float32),
        }

    def _halves(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Max of each filter over each half chunk, (half chunks, filters): with and without the last place, whose filter reaches into the next half."""
        p = self.p
        cells = p["embed"][blocks].reshape(-1, EMBED * STRIDE)
        both = cells @ np.concatenate([p["left"], p["right"]], 1)
        a = both[:, :FILTERS]
        a[:-1] += both[1:, FILTERS:]
        by_half = a.reshape(-1, _HALF, FILTERS)
        inner = by_half[:, :-1].max(1)
        return np.maximum(inner, by_half[:, -1]), inner

    def _chunks(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The descriptions of all chunks of some texts, one text after the other, and where each text's begin."""
        p = self.p
        blocks = [_blocks(r) for r in raws]
        halves, inner = self._halves(np.concatenate(blocks))
        counts = np.array([len(b) // HOP for b in blocks])
        ends = np.cumsum(counts)
        first = np.ones(len(halves), bool)
        first[ends - 1] = False  # a chunk is a half and the next one of the same text
        at = np.flatnonzero(first)
        pooled = np.maximum(np.maximum(halves[at], inner[at + 1]) + p["shift"], 0)
        owner = np.repeat(np.arange(len(raws)), counts)[at]
        left = np.array([len(r) for r in raws])[owner] - (at - (ends - counts)[owner]) * HOP
        x = np.concatenate([pooled, np.clip(left / CHUNK, 0, 1)[:, None].astype(np.float32)], 1)
        return np.maximum(x @ p["dense"] + p["bias"], 0), np.searchsorted(owner, np.arange(len(raws)))

    def _long(self, raw: bytes) -> np.ndarray:
        """Maximum and mean of the chunk descriptions of one text, a window of chunks at a time."""
        n, most, total = -(-len(raw) // HOP) - 1, 0.0, 0.0
        for s in range(0, n, _WINDOW):
            h = self._chunks([raw[s * HOP : (s + _WINDOW + 1) * HOP]])[0]
            most, total = np.maximum(most, h.max(0)), total + h.sum(0, dtype=np.float64)
        return np.concatenate([most, total / n])

    def score(self, raws: list[bytes]) -> np.ndarray:
        """Probability of label 1 of whole texts."""
        p, doc = self.p, np.zeros((len(raws), 2 * HIDDEN))
        short = [k for k, r in enumerate(raws) if len(r) <= _WINDOW * HOP]
        if short:
            h, starts = self._chunks([raws[k] for k in short])
            sizes = np.diff(np.append(starts, len(h)))[:, None]
            doc[short] = np.concatenate([np.maximum.reduceat(h, starts), np.add.reduceat(h, starts, dtype=np.float64) / sizes], 1)
        for k, r in enumerate(raws):
            if len(r) > _WINDOW * HOP:
                doc[k] = self._long(r)
        return 1 / (1 + np.exp(-np.clip(doc @ p["out"].astype(np.float64) + p["level"].astype(np.float64), -30, 30)))

    def gradients(self, chunks: np.ndarray, fill: np.ndarray, starts: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss and gradients; chunks (all chunks, CHUNK) of bytes and their fill, text after text, each beginning at its start."""
        p, kind, m, n = self.p, self.p["embed"].dtype, len(chunks), len(starts)
        windows = [slice(s, s + _TRAINED) for s in range(0, m, _TRAINED)]
        where, peak = np.empty((m, FILTERS), np.int64), np.empty((m, FILTERS), kind)
        for w in windows:
            cells = p["embed"][chunks[w]].reshape(-1, CHUNK // STRIDE, EMBED * STRIDE)
            conv = cells[:, :-1] @ p["left"] + cells[:, 1:] @ p["right"] + p["shift"]
            where[w] = conv.argmax(1)
            peak[w] = np.take_along_axis(conv, where[w][:, None], 1)[:, 0]
        x = np.concatenate([np.maximum(peak, 0), fill[:, None]], 1).astype(kind)
        h = np.maximum(x @ p["dense"] + p["bias"], 0)
        sizes = np.diff(np.append(starts, m))
        owner = np.repeat(np.arange(n), sizes)
        most = np.maximum.reduceat(h, starts)
        top = np.minimum.reduceat(np.where(h == most[owner], np.arange(m)[:, None], m), starts)  # the first chunk of each text that has it
        doc = np.concatenate([most, np.add.reduceat(h, starts) / sizes[:, None]], 1).astype(kind)
        q = 1 / (1 + np.exp(-np.clip(doc @ p["out"] + p["level"], -30, 30)))
        loss = float(-(y * np.log(q + 1e-9) + (1 - y) * np.log(1 - q + 1e-9)).mean())
        d = ((q - y) / n).astype(kind)
        g = {"out": doc.T @ d, "level": d.sum(keepdims=True)}
        dh = ((d / sizes)[owner][:, None] * p["out"][HIDDEN:]).astype(kind)
        dh[top, np.arange(HIDDEN)] += d[:, None] * p["out"][:HIDDEN]
        dh *= h > 0
        g["dense"], g["bias"] = x.T @ dh, dh.sum(0)
        dp = (dh @ p["dense"][:FILTERS].T) * (peak > 0)
        g["shift"] = dp.sum(0)
        filters = np.concatenate([p["left"].T, p["right"].T], 1)
        by_filter, g["embed"] = np.zeros_like(filters), np.zeros_like(p["embed"])
        for w in windows:
            rows = np.arange(len(chunks[w]))[:, None, None]
            hit = chunks[w][rows, where[w][:, :, None] * STRIDE + np.arange(2 * STRIDE)]  # the bytes under each filter's best place
            by_filter += np.einsum("rfk,rf->fk", p["embed"][hit].reshape(len(hit), FILTERS, -1), dp[w], optimize=True)
            back = (dp[w][:, :, None] * filters).reshape(-1, EMBED)
            g["embed"] += np.stack([np.bincount(hit.ravel(), back[:, k], 256) for k in range(EMBED)], 1).astype(kind)
        g["left"], g["right"] = by_filter[:, : EMBED * STRIDE].T, by_filter[:, EMBED * STRIDE :].T
        return loss, g


def _batch(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All chunks of some texts, the share of each that the text fills, and where each text's begin."""
    halves = [_blocks(r).reshape(-1, HOP) for r in raws]
    counts = np.array([len(b) - 1 for b in halves])
    chunks = np.concatenate([np.concatenate([b[:-1], b[1:]], 1) for b in halves])
    starts = np.cumsum(counts) - counts
    left = np.repeat([len(r) for r in raws], counts) - (np.arange(len(chunks)) - np.repeat(starts, counts)) * HOP
    return chunks, np.clip(left / CHUNK, 0, 1).astype(np.float32), starts


def train(raws: list[bytes], y: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = 4e-3, decay: float = 1e-4, seed: int = 1) -> Network:
    """Adam over shuffled batches of whole texts with a falling rate; small samples run through more epochs."""
    net, rng = Network(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    n = len(y)
    epochs = max(epochs, min(60, 8000 // max(1, n)))
    steps, t = epochs * -(-n // batch), 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            own = order[at : at + batch]
            _, g = net.gradients(*_batch([raws[k] for k in own]), y[own])
            t += 1
            now = rate * (1 - t / (steps + 1))
            for k, x in net.p.items():
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.002 * (g[k] ** 2 - v[k])
                x -= (now * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.998**t)) + 1e-8) + now * decay * x).astype(np.float32)
    return net


def _fitting(sizes: list, most: int) -> list[tuple]:
    """The ids, in the order of their hashes, of the documents that together hold at most `most` bytes."""
    out, held = [], 0
    for r in sorted(sizes, key=lambda r: (r.place, r.doc_id)):
        if held + r.bytes <= most:
            out.append((r.doc_id,))
            held += r.bytes
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network | None:
    """Train on the whole texts of at most `sample` labelled documents, `sample_bytes` together, whose fold is not held out; None without both labels."""
    rows = common.materialise(common.labelled_sample(docs, labels, "quality", common.bucket_of("doc_id", FOLDS) == 0, sample), "quality-sample")
    sizes = rows.select("doc_id", F.xxhash64("doc_id").alias("place"), F.octet_length("text").alias("bytes")).collect()  # `sample` rows of three numbers
    ids = docs.sparkSession.createDataFrame(_fitting(sizes, sample_bytes), rows.select("doc_id").schema)  # `sample` ids at most
    got = rows.join(F.broadcast(ids), "doc_id", "left_semi").collect()  # `sample_bytes` of text at most
    if len({r.y for r in got}) < 2:
        return None
    got.sort(key=lambda r: r.doc_id)
    return train([r.text.encode() for r in got], np.array([r.y for r in got], np.float32))


def _score(batches: Iterator[pa.RecordBatch], model, column: str) -> Iterator[pa.RecordBatch]:
    common.forget_tables()
    net = model.value
    for batch in common.slices(batches, "text", 1 << 18, 256):
        scores = net.score(common.raw_texts(batch)) if net is not None else np.full(batch.num_rows, 0.5)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, column])


def score(docs: DataFrame, net: Network | None, column: str = "quality_score") -> DataFrame:
    """docs with a double column of scores; a column of that name is replaced."""
    docs = docs.drop(column)
    model = docs.sparkSession.sparkContext.broadcast(net)
    return docs.mapInArrow(partial(_score, model=model, column=column), T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier, trained on these documents' labels, does not reject, with all their columns."""
    own = common.free_name(docs, "score")
    return score(docs, fit(docs, labels), own).where(F.col(own) >= threshold).drop(own)
