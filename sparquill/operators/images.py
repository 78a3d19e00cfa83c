"""Picture operators on Spark's image struct (origin, height, width, nChannels, mode, data as BGR bytes).

Each task turns the pictures of its partition with NumPy and hands them on in small
batches, so memory is bounded by a few pictures.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.operators import boxes as ob
from sparquill.operators.boxes import AUGMENTATIONS
from sparquill.session import cut
from sparquill.sources.readers import frame_sample

# Channel means and deviations (RGB), sizes, kernel and steps.
MEAN = (0.485, 0.456, 0.406)
STD = (0.229, 0.224, 0.225)
TENSOR_SIZE = 160
RESIZED = (224, 224)
KERNEL = 15
BRIGHTNESS = 30
CONTRAST = 1.5
# The five robustness variants, name -> (kind, factor).
ROBUSTNESS = {
    "low_brightness": ("brightness", 0.5),
    "high_brightness": ("brightness", 1.5),
    "low_contrast": ("contrast", 0.5),
    "high_contrast": ("contrast", 1.5),
    "blur": ("blur", 2.0),
}
BATCH_BYTES = 16 << 20
IMAGE_FIELDS = "origin string, height int, width int, nChannels int, mode int, data binary"


def pixels(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(height, width, channels)


def _clip(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x), 0, 255).astype(np.uint8)


@lru_cache(maxsize=64)
def _resize_weights(n_in: int, n_out: int, smooth: bool) -> np.ndarray:
    """Linear interpolation as a matrix; ``smooth`` widens the filter when shrinking."""
    step = n_in / n_out
    width = max(step, 1.0) if smooth else 1.0
    at = np.clip((np.arange(n_out) + 0.5) * step - 0.5, 0, n_in - 1) if not smooth else (np.arange(n_out) + 0.5) * step - 0.5
    w = np.maximum(0.0, 1 - np.abs(np.arange(n_in)[None, :] - at[:, None]) / width)
    return w / w.sum(axis=1, keepdims=True)


def _both_axes(img: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    return np.einsum("yi,ijc,xj->yxc", rows, img.astype(float), cols, optimize=True)


def blur(img: np.ndarray, sigma: float, radius: int) -> np.ndarray:
    """Gaussian blur, one axis after the other, as a sum of shifted slices; the border is mirrored without its edge."""
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma**2))
    kernel /= kernel.sum()
    out = img.astype(float)
    for axis in (0, 1):
        n = out.shape[axis]
        wide = np.pad(out, [(radius, radius) if k == axis else (0, 0) for k in range(3)], mode="reflect" if n > 1 else "edge")
        out = sum(w * wide.take(range(d, d + n), axis) for d, w in enumerate(kernel))
    return _clip(out)


def resize(img: np.ndarray, size: tuple[int, int], smooth: bool = False) -> np.ndarray:
    h, w = size
    return _clip(_both_axes(img, _resize_weights(img.shape[0], h, smooth), _resize_weights(img.shape[1], w, smooth)))


def brighten(img: np.ndarray, value: int = BRIGHTNESS) -> np.ndarray:
    """Raises the largest channel by a step, saturating; hue and saturation stay."""
    top = img.max(axis=2, keepdims=True).astype(float)
    new = np.minimum(top + value, 255.0)
    return _clip(np.where(top > 0, img * (new / np.maximum(top, 1.0)), new))


def augmented(img: np.ndarray, kind: str) -> np.ndarray:
    """One of the six training augmentations."""
    if kind == "flipped":
        return img[:, ::-1]
    if kind == "rotated":
        return np.rot90(img, -1)
    if kind == "resized":
        return resize(img, RESIZED)
    if kind == "blurred":
        return blur(img, 0.3 * ((KERNEL - 1) * 0.5 - 1) + 0.8, KERNEL // 2)
    if kind == "brightness":
        return brighten(img)
    if kind == "contrast":
        return _clip(img * CONTRAST)
    raise ValueError(f"unknown augmentation {kind!r}")


def distorted(img: np.ndarray, kind: str, factor: float) -> np.ndarray:
    """A robustness variant: brightness and contrast by a factor, or Gaussian blur."""
    if kind == "brightness":
        return _clip(img * factor)
    if kind == "contrast":
        gray = img @ np.array([0.114, 0.587, 0.299]) if img.shape[2] == 3 else img.mean(axis=2)
        mean = np.floor(gray.mean() + 0.5)
        return _clip(mean + factor * (img - mean))
    if kind == "blur":
        return blur(img, factor, int(np.ceil(3 * factor)))
    raise ValueError(f"no distortion is called {kind!r}; there are brightness, contrast and blur")


def _variants(images: DataFrame, names: Sequence[str], make: Callable[[np.ndarray, str], np.ndarray]) -> DataFrame:
    names = list(names)
    rows = images.select("image.*") if "image" in images.columns else images.select(*[f.split()[0] for f in IMAGE_FIELDS.split(", ")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                img = pixels(r.height, r.width, r.nChannels, r.data)
                for name in names:
                    new = np.ascontiguousarray(make(img, name))
                    out.append((r.origin, name, new.shape[0], new.shape[1], new.shape[2], r.mode, new.tobytes()))
                    size += new.nbytes
                if size > BATCH_BYTES:
                    yield pd.DataFrame(out, columns=columns)
                    out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=columns)

    columns = ["origin", "augmentation", "height", "width", "nChannels", "mode", "data"]
    return rows.mapInPandas(run, IMAGE_FIELDS.replace("origin string", "origin string, augmentation string"))


def augment(images: DataFrame, kinds: Sequence[str] = tuple(AUGMENTATIONS)) -> DataFrame:
    """One row per (image, augmentation). Boxes: see boxes.augment_boxes."""
    unknown = set(kinds) - set(AUGMENTATIONS)
    if unknown:
        raise ValueError(f"unknown augmentations {sorted(unknown)}")
    return _variants(images, kinds, augmented)


def robustness_variants(images: DataFrame) -> DataFrame:
    """The five distorted copies of every probe picture."""
    return _variants(images, list(ROBUSTNESS), lambda img, name: distorted(img, *ROBUSTNESS[name]))


def augmented_name(origin, augmentation):
    """``stem_augmentation`` column from path and augmentation columns."""
    stem = F.regexp_replace(F.element_at(F.split(origin, "/"), -1), r"\..*$", "")
    return F.concat_ws("_", stem, augmentation)


def _per_image(images: DataFrame, make: Callable[[np.ndarray], np.ndarray], out: str) -> DataFrame:
    rows = images.select("image.*") if "image" in images.columns else images

    def run(batches):
        for pdf in batches:
            step = max(1, BATCH_BYTES // max(1, int(4 * 3 * TENSOR_SIZE**2)))
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at : at + step]
                made = [make(pixels(r.height, r.width, r.nChannels, r.data)) for r in part.itertuples(index=False)]
                yield pd.DataFrame({"origin": part["origin"].to_numpy(), out: pd.Series(made, dtype=object)})

    return rows.mapInPandas(run, f"origin string, {out} array<float>")


def tensor(img: np.ndarray, size: int = TENSOR_SIZE) -> np.ndarray:
    """RGB planes scaled to 0..1 and normalized per channel, flat in (channel, row, column) order."""
    rgb = resize(img, (size, size), smooth=True)[:, :, ::-1] / 255.0
    return ((rgb - np.array(MEAN)) / np.array(STD)).transpose(2, 0, 1).ravel().astype(np.float32)


def to_tensor(images: DataFrame, size: int = TENSOR_SIZE) -> DataFrame:
    return _per_image(images, lambda img: tensor(img, size), "tensor")


def histogram(img: np.ndarray, bins: int = 8) -> np.ndarray:
    """Colour histogram of unit length."""
    h = np.concatenate([np.bincount(img[:, :, c].ravel() * bins // 256, minlength=bins) for c in range(img.shape[2])]).astype(float)
    return (h / max(np.linalg.norm(h), 1e-12)).astype(np.float32)


def embed_image(images: DataFrame, encoder: Callable[[np.ndarray], np.ndarray] = histogram) -> DataFrame:
    """Vector per picture: (origin, embedding). The default needs no weights; plug in a network instead."""
    def make(img: np.ndarray) -> np.ndarray:
        return encoder(img.astype(np.int64) if encoder is histogram else img)

    return _per_image(images, make, "embedding")


# ---- detection ------------------------------------------------------------------------------------

RAW_FIELDS = "det_no int, cx double, cy double, w double, h double, objectness double, class_scores array<double>"


def quadrant_detector():
    """Stand-in detector without weights: one box per quadrant, classes scored by mean colour."""
    def detect(img: np.ndarray) -> list[tuple]:
        h, w = img.shape[:2]
        out = []
        for i, (y, x) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
            part = img[y * h // 2 : (y + 1) * h // 2, x * w // 2 : (x + 1) * w // 2]
            means = part.reshape(-1, img.shape[2]).mean(axis=0) / 255.0 if part.size else np.zeros(img.shape[2])
            out.append((i, (x + 0.5) / 2, (y + 0.5) / 2, 0.5, 0.5, float(means.max()), [float(m) for m in means]))
        return out

    return detect


def detect(frames: DataFrame, factory: Callable[[], Callable] = quadrant_detector, key: str = "image_id") -> DataFrame:
    """Raw detections per frame from a plugged-in model; ``factory`` runs once per task."""
    kind = frames.schema[key].dataType.simpleString()

    def run(batches):
        model = factory()
        for pdf in batches:
            rows = [
                (getattr(r, key), *d)
                for r in pdf.itertuples(index=False)
                for d in model(pixels(r.height, r.width, r.nChannels, r.data))
            ]
            yield pd.DataFrame(rows, columns=[key, *[f.split()[0] for f in RAW_FIELDS.split(", ")]])

    return frames.select(key, "height", "width", "nChannels", "data").mapInPandas(run, f"{key} {kind}, {RAW_FIELDS}")


def detect_frames(
    frames: DataFrame, factory: Callable[[], Callable] = quadrant_detector, every: int = 20,
    score_threshold: float = 0.5, nms_threshold: float = 0.4,
) -> DataFrame:
    """Every N-th frame through detector, score filter and suppression to lists per frame."""
    picked = frame_sample(frames, every, "image_id")
    raw = cut(detect(picked, factory))  # stored: the detector sees each frame once, however often the boxes are read
    kept = ob.nms(ob.postprocess(raw, score_threshold).drop("class_scores"), nms_threshold)
    return ob.frame_results(kept, picked)
