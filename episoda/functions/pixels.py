"""Pixel measures of encoded images: the one place where Python sees frame data, in Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from episoda.functions import png

LUMA = np.array([0.299, 0.587, 0.114])
THUMB = 64
#: Images that are decoded together; bounds a task's memory.
TOGETHER = 64

METRICS = "width int, height int, channels int, mean_luma double, std_luma double, dark_fraction double, bright_fraction double, gradient_energy double, laplacian_var double, chroma_spread double, noise_residual double, ahash string, thumb binary"
_NAMES = [x.split()[0] for x in METRICS.split(", ")]


@lru_cache(64)
def _weights(n: int, size: int) -> np.ndarray:
    scale = n / size
    support = max(1.0, scale)
    centre = (np.arange(size) + 0.5) * scale
    w = np.maximum(0, 1 - np.abs((np.arange(n) + 0.5)[None, :] - centre[:, None]) / support)
    return w / w.sum(1, keepdims=True)


def resample(grey: np.ndarray, size: int) -> np.ndarray:
    """Antialiased bilinear (triangle filter whose support grows with the reduction), rounded to whole grey levels."""
    across = np.floor(grey @ _weights(grey.shape[1], size).T + 0.5)
    return np.clip(np.floor(_weights(grey.shape[0], size) @ across + 0.5), 0, 255)


def laplacian(grey: np.ndarray) -> np.ndarray:
    """Four-neighbour Laplacian of the inner pixels."""
    return grey[:-2, 1:-1] + grey[2:, 1:-1] + grey[1:-1, :-2] + grey[1:-1, 2:] - 4 * grey[1:-1, 1:-1]


def measure(payload: bytes) -> dict:
    """All measures of one image; raises PngError for anything that is not a whole image."""
    return measures(png.decode(payload))


def measures(pixels: np.ndarray) -> dict:
    """All measures of decoded pixels (height, width, channels)."""
    rgb = png.to_rgb(pixels).astype(np.float64)
    grey = rgb @ LUMA
    whole = np.floor(grey)  # hash and thumbnail are taken from luma cut to whole grey levels
    inner = laplacian(grey) if min(grey.shape) >= 3 else np.zeros(1)
    edges = [np.abs(np.diff(grey, axis=a)).mean() if grey.shape[a] > 1 else 0.0 for a in (1, 0)]
    means = rgb.reshape(-1, 3).mean(0)
    small = resample(whole, 8)
    return {
        "width": grey.shape[1], "height": grey.shape[0], "channels": pixels.shape[2],
        "mean_luma": grey.mean(), "std_luma": grey.std(), "dark_fraction": (grey <= 10).mean(), "bright_fraction": (grey >= 245).mean(),
        "gradient_energy": sum(edges) / 2, "laplacian_var": inner.var(),
        "chroma_spread": float((means.max() - means.min()) / means.mean()) if means.mean() > 1e-6 else None,
        "noise_residual": float(np.median(np.abs(inner - np.median(inner)))),
        "ahash": "".join("1" if b else "0" for b in (small >= small.mean()).ravel()),
        "thumb": resample(whole, THUMB).astype(np.uint8).tobytes(),
    }


def decode_rows(keys: list[str]):
    """A mapInArrow function over (keys..., payload): keys, payload_present, decode_ok, byte_size, sha1, error and the measures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, TOGETHER) for b in batches for at in range(0, b.num_rows, TOGETHER)):
            rows = []
            payloads = batch.column("payload").to_pylist()
            decoded = iter(png.decode_many([x for x in payloads if x]))
            for payload in payloads:
                row = dict.fromkeys(_NAMES)
                row |= {"payload_present": bool(payload), "decode_ok": False, "byte_size": len(payload or b""), "sha1": hashlib.sha1(payload).hexdigest() if payload else "", "error": "" if payload else "missing payload", "ahash": ""}
                if payload:
                    image = next(decoded)
                    row |= {"error": str(image)} if isinstance(image, png.PngError) else measures(image) | {"decode_ok": True}
                rows.append(row)
            schema = pa.schema([*(batch.schema.field(k) for k in keys), *_fields()])
            made = pa.Table.from_pylist(rows, pa.schema(_fields())).combine_chunks()
            columns = [batch.column(k) for k in keys] + [made.column(i).combine_chunks() for i in range(made.num_columns)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else c.chunk(0) for c in columns], schema=schema)

    return run


def _fields() -> list[pa.Field]:
    kinds = {"int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
    head = [("payload_present", pa.bool_()), ("decode_ok", pa.bool_()), ("byte_size", pa.int64()), ("sha1", pa.string()), ("error", pa.string())]
    return [pa.field(n, k) for n, k in head] + [pa.field(x.split()[0], kinds[x.split()[1]]) for x in METRICS.split(", ")]


DECODED = "payload_present boolean, decode_ok boolean, byte_size bigint, sha1 string, error string, " + METRICS


def motion_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean absolute difference of thumb and before, appended as motion; null where either is."""
    for batch in batches:
        out = []
        for now, before in zip(batch.column("thumb").to_pylist(), batch.column("before").to_pylist(), strict=True):
            out.append(float(np.abs(np.frombuffer(now, np.uint8).astype(np.int16) - np.frombuffer(before, np.uint8)).mean()) if now and before else None)
        keep = [n for n in batch.schema.names if n not in ("thumb", "before")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(out, pa.float64())], [*keep, "motion_mad_prev"])
