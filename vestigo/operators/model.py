"""A page detector over an ONNX session: where its weights are, one session per worker, pictures in, rows out."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import lru_cache
from typing import Any

import numpy as np

#: Weights smaller than this are a broken download.
MIN_MODEL_BYTES = 10 << 20
ENVIRONMENT = "VESTIGO_MODEL"
SIDE = 640


def resolve_model(path: str | None = None, shipped: str = "detector.onnx") -> str:
    """The weights' file: the one named, or that of the environment, or the one that ``SparkContext.addFile`` shipped.

    Nothing is downloaded; a file that is missing or too small raises.
    """
    from pyspark import SparkFiles

    candidates = [path] if path else [os.environ.get(ENVIRONMENT)]
    if not path:
        try:
            candidates.append(SparkFiles.get(shipped))
        except (RuntimeError, AssertionError, TypeError, AttributeError):  # no Spark here
            pass
    for found in filter(None, candidates):
        if os.path.isfile(found):
            if os.path.getsize(found) < MIN_MODEL_BYTES:
                raise ValueError(f"{found} is too small to be a model")
            return found
    raise FileNotFoundError(f"no model: name one, set {ENVIRONMENT} or ship {shipped}")


@lru_cache(maxsize=2)
def session(path: str) -> Any:
    """One session per worker and file; one thread and no arena, as tasks share the machine."""
    import onnxruntime as ort

    options = ort.SessionOptions()
    options.intra_op_num_threads = options.inter_op_num_threads = 1
    options.enable_cpu_mem_arena = False
    return ort.InferenceSession(path, options, providers=["CPUExecutionProvider"])


def _weights(size: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    """Source places and Lanczos-3 weights of every target place; a smaller target widens the kernel."""
    scale = size / to
    support = 3 * max(scale, 1.0)
    centre = (np.arange(to) + 0.5) * scale
    taps = int(np.ceil(support)) * 2 + 1
    at = np.floor(centre - support).astype(int)[:, None] + np.arange(taps)
    x = (at + 0.5 - centre[:, None]) / max(scale, 1.0)
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0) * ((at >= 0) & (at < size))
    return np.clip(at, 0, size - 1), w / w.sum(axis=1, keepdims=True)


def resize(image: np.ndarray, height: int = SIDE, width: int = SIDE) -> np.ndarray:
    """A picture (rows, columns, channels) of 8 bits in another size, by Lanczos, columns first."""
    out = image.astype(np.float64)
    for axis, to in ((1, width), (0, height)):
        if out.shape[axis] == to:
            continue
        at, w = _weights(out.shape[axis], to)
        moved = np.moveaxis(out, axis, 0)
        out = np.moveaxis(np.clip(np.rint(sum(moved[at[:, k]] * w[:, k].reshape(-1, 1, 1) for k in range(at.shape[1]))), 0, 255), 0, axis)
    return out.astype(np.uint8)


def preprocess(image: np.ndarray) -> np.ndarray:
    """An RGB picture as the network's input: float32 of shape (1, 3, 640, 640) between 0 and 1."""
    return np.ascontiguousarray(resize(image).transpose(2, 0, 1)[None].astype(np.float32) / 255)


def head_rows(output: np.ndarray) -> np.ndarray:
    """Rows (cx, cy, w, h, score...) of a head's output (1, 4 + classes, boxes); none from any other shape."""
    found = np.asarray(output)
    found = found[0] if found.ndim == 3 and found.shape[0] == 1 else found
    return found.T.astype(np.float64) if found.ndim == 2 and found.shape[0] >= 5 else np.zeros((0, 5))


def onnx_detector(picture: Callable[[bytes, tuple | None], np.ndarray], open_session: Callable[[], Any] | None = None, path: str | None = None):
    """A detector for ``detect_documents``: ``picture`` turns a page and a tile into RGB; the session is the worker's own."""

    def detect(page: bytes, tile: tuple | None) -> np.ndarray:
        own = open_session() if open_session else session(resolve_model(path))
        return head_rows(own.run(None, {own.get_inputs()[0].name: preprocess(picture(page, tile))})[0])

    return detect
