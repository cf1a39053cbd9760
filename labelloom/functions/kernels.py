"""NumPy on one image at a time: height x width x 3 arrays of uint8, channels blue, green, red."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Means and deviations of red, green and blue that models expect.
MEAN, STD = (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)
#: Weights of red, green and blue in grey, in thousandths.
LUMA = (299, 587, 114)


@lru_cache(maxsize=4096)
def area_weights(n: int, m: int) -> np.ndarray:
    """m x n: each of m equal cells' shares of the n pixels that it covers."""
    edges = np.arange(m + 1) * (n / m)
    low, high = np.maximum(edges[:-1, None], np.arange(n)), np.minimum(edges[1:, None], np.arange(1, n + 1))
    w = np.maximum(high - low, 0)
    return w / w.sum(1, keepdims=True)


@lru_cache(maxsize=4096)
def linear_weights(n: int, m: int) -> np.ndarray:
    """m x n: linear interpolation between pixel centres, held at the borders."""
    at = np.clip((np.arange(m) + 0.5) * (n / m) - 0.5, 0, n - 1)
    low = np.floor(at).astype(int)
    w = np.zeros((m, n))
    w[np.arange(m), low] = 1 - (at - low)
    w[np.arange(m), np.minimum(low + 1, n - 1)] += at - low
    return w


def resample(img: np.ndarray, h: int, w: int, area: bool) -> np.ndarray:
    weights = area_weights if area else linear_weights
    out = np.einsum("ab,bcd->acd", weights(img.shape[0], h), img.astype(np.float64))
    out = np.einsum("ab,cbd->cad", weights(img.shape[1], w), out)
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)


def letterbox(img: np.ndarray, size: int) -> np.ndarray | None:
    """Scaled so that the long edge fits, in the middle of a black square; None if the short edge comes to nothing."""
    h, w = img.shape[:2]
    scale = size / max(h, w)
    nh, nw = int(h * scale), int(w * scale)
    if not nh or not nw:
        return None
    out = np.zeros((size, size, 3), np.uint8)
    top, left = (size - nh) // 2, (size - nw) // 2
    out[top : top + nh, left : left + nw] = resample(img, nh, nw, scale < 1)
    return out


def stretch(img: np.ndarray, size: int) -> np.ndarray:
    return resample(img, size, size, False)


def grayscale(img: np.ndarray) -> np.ndarray:
    r, g, b = img[:, :, 2].astype(np.int64), img[:, :, 1].astype(np.int64), img[:, :, 0].astype(np.int64)
    luma = ((LUMA[0] * r + LUMA[1] * g + LUMA[2] * b) / 1000 + 0.5).astype(np.uint8)
    return np.repeat(luma[:, :, None], 3, axis=2)


def normalize(img: np.ndarray, mean: tuple[float, ...] = MEAN, std: tuple[float, ...] = STD) -> np.ndarray:
    """3 x height x width float32, channels red, green, blue."""
    rgb = img[:, :, ::-1].astype(np.float64) / 255
    return ((rgb - np.array(mean)) / np.array(std)).transpose(2, 0, 1).astype(np.float32)


def rotate(img: np.ndarray, degrees: float) -> np.ndarray:
    """Around the middle, nearest pixel, black where nothing comes from."""
    if not degrees:
        return img
    h, w = img.shape[:2]
    t = np.deg2rad(degrees)
    y, x = np.mgrid[:h, :w]
    y, x = y - (h - 1) / 2, x - (w - 1) / 2
    sy = np.floor(np.cos(t) * y - np.sin(t) * x + (h - 1) / 2 + 0.5).astype(int)
    sx = np.floor(np.sin(t) * y + np.cos(t) * x + (w - 1) / 2 + 0.5).astype(int)
    ok = (sy >= 0) & (sy < h) & (sx >= 0) & (sx < w)
    return np.where(ok[:, :, None], img[np.clip(sy, 0, h - 1), np.clip(sx, 0, w - 1)], 0).astype(np.uint8)


def jitter(img: np.ndarray, brightness: float, contrast: float, brightness_first: bool) -> np.ndarray:
    """Times the brightness; and away from, or towards, the mean grey by the contrast."""
    x = img.astype(np.float64)
    for bright in (brightness_first, not brightness_first):
        if bright:
            x = np.clip(x * brightness, 0, 255)
        else:
            grey = np.floor(grayscale(x.astype(np.uint8))[:, :, 0].mean() + 0.5)
            x = np.clip(grey + (x - grey) * contrast, 0, 255)
        x = np.floor(x)
    return x.astype(np.uint8)
