"""Numpy helpers that turn one decoded image into a normalised grey tensor."""

from __future__ import annotations

import numpy as np

# Output side, blur radius, Lanczos support, luma weights of R, G, B.
SIDE = 512
BLUR_RADIUS = 0.5
LANCZOS_LOBES = 3.0
LUMA = (0.299, 0.587, 0.114)

# Values converted to floating point at a time.
STRIP_VALUES = 1 << 20


def resample_matrix(source: int, target: int) -> np.ndarray:
    """(target x source) Lanczos weights; the kernel widens when shrinking."""
    scale = source / target
    stretch = max(scale, 1.0)
    centre = (np.arange(target) + 0.5) * scale
    distance = (np.arange(source) + 0.5 - centre[:, None]) / stretch
    weights = np.where(
        np.abs(distance) < LANCZOS_LOBES, np.sinc(distance) * np.sinc(distance / LANCZOS_LOBES), 0.0
    )
    return weights / weights.sum(axis=1, keepdims=True)


def _bytes(values: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(values), 0, 255)


def resize(
    pixels: np.ndarray, side: int = SIDE, matrices: dict[int, np.ndarray] | None = None
) -> np.ndarray:
    """(h, w, c) bytes -> (side, side, c), columns first, rounded to whole levels after each axis.

    Works in strips of rows, one channel at a time, so a large image costs little more than its bytes.
    Colours are weighted by alpha while they are mixed. ``matrices`` keeps the weights of the sizes a task has met.
    """
    height, width, channels = pixels.shape
    known = {} if matrices is None else matrices
    for source in {height, width} - known.keys():
        if len(known) >= 64:
            known.clear()
        known[source] = resample_matrix(source, side)
    across = known[width] if width in known else resample_matrix(width, side)
    down = known[height] if height in known else resample_matrix(height, side)
    rows = max(1, STRIP_VALUES // width)
    out = np.empty((side, side, channels))
    for c in range(channels):
        wide = np.empty((height, side))
        for start in range(0, height, rows):
            strip = pixels[start : start + rows, :, c].astype(np.float64)
            if channels == 4 and c < 3:
                strip = np.rint(strip * pixels[start : start + rows, :, 3] / 255)
            wide[start : start + rows] = _bytes(strip @ across.T)
        out[:, :, c] = _bytes(down @ wide)
    if channels == 4:
        alpha = out[:, :, 3:]
        weighted = np.minimum(255, 255 * out[:, :, :3] // np.maximum(alpha, 1))
        out[:, :, :3] = np.where((alpha > 0) & (alpha < 255), weighted, out[:, :, :3])
    return out


def to_grey(bgr: np.ndarray) -> np.ndarray:
    """Luma of an image whose channels come as B, G, R[, A]; one channel passes through."""
    if bgr.shape[2] == 1:
        return bgr[:, :, 0]
    return _bytes(bgr[:, :, :3] @ np.array(LUMA[::-1]))


def blur(grey: np.ndarray, radius: float = BLUR_RADIUS) -> np.ndarray:
    """Gaussian blur with ``radius`` as standard deviation, edges repeated."""
    reach = max(1, int(np.ceil(radius * 4)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / radius) ** 2)
    kernel /= kernel.sum()
    for axis in (0, 1):
        pad = [(reach, reach) if a == axis else (0, 0) for a in (0, 1)]
        padded = np.pad(grey, pad, mode="edge")
        n = grey.shape[axis]
        grey = sum(
            w * (padded[i : i + n, :] if axis == 0 else padded[:, i : i + n])
            for i, w in enumerate(kernel)
        )
    return _bytes(grey)


def normalise(
    data: bytes,
    height: int,
    width: int,
    channels: int,
    denoise: bool = True,
    side: int = SIDE,
    matrices: dict[int, np.ndarray] | None = None,
) -> np.ndarray:
    """float32 (side, side) in [0, 1]."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    grey = to_grey(resize(pixels, side, matrices))
    if denoise:
        grey = blur(grey)
    tensor = (grey / 255.0).astype(np.float32)
    if tensor.min() < 0.0 or tensor.max() > 1.0:
        raise ValueError("pixel values outside [0, 1] after normalisation")
    return tensor


def preview(tensor: np.ndarray) -> bytes:
    """8-bit levels, truncated."""
    return (tensor * np.float32(255)).astype(np.uint8).tobytes()


def pool_grid(tensor: np.ndarray, dim: int) -> np.ndarray:
    """``dim`` means over consecutive runs of the row-major tensor, scaled to length 1."""
    flat = tensor.astype(np.float64).ravel()
    edges = np.linspace(0, len(flat), dim + 1).astype(np.int64)
    means = np.add.reduceat(flat, edges[:-1]) / np.diff(edges)
    norm = np.linalg.norm(means)
    return means / norm if norm > 0 else means
