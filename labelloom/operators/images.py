"""Image-table jobs: one image a row (key, height, width, data: BGR bytes in row order).

Geometry and array forms are columns; pixel work is NumPy over Arrow batches. Augmentation
takes its parameters from a hash of seed, epoch, copy and key, so a task that runs again
makes the same pixels. Tables keep their other columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.hashing import key_hash, unit


def letterbox_geometry(df: DataFrame, size: int, h: str = "h", w: str = "w") -> DataFrame:
    """df with new_h, new_w, interp (AREA or LINEAR), top, bottom, left, right and degenerate: doubles cut off in this order, so some long edges come to size - 1."""
    scale = F.lit(float(size)) / F.greatest(h, w)
    x = df.withColumns({"new_h": F.floor(F.col(h) * scale), "new_w": F.floor(F.col(w) * scale), "interp": F.when(scale < 1, "AREA").otherwise("LINEAR")})
    dh, dw = F.lit(size) - F.col("new_h"), F.lit(size) - F.col("new_w")
    x = x.withColumns({"top": F.floor(dh / 2), "left": F.floor(dw / 2)})
    return x.withColumns({"bottom": dh - F.col("top"), "right": dw - F.col("left"), "degenerate": (F.col("new_h") == 0) | (F.col("new_w") == 0)})


def from_pixels(df: DataFrame, side: int, pixels: str = "px") -> DataFrame:
    """df with height, width and data of a one-channel array of side * side values, the channel three times; all null for null pixels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [None if v is None else np.repeat(np.array(v, np.uint8), 3).tobytes() for v in b.column(1).to_pylist()]
            side_of = [None if d is None else side for d in data]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(side_of, pa.int32()), pa.array(side_of, pa.int32()), pa.array(data, pa.binary())], ["row", "height", "width", "data"])

    return _narrow(df, [F.col(pixels)], run, "height int, width int, data binary")


def _narrow(df: DataFrame, args: list[Column], run: Callable, new: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """run over (row, args...), where row holds df's other columns; new columns replace any of the same name."""
    names = [x.split()[0] for x in new.split(", ")]
    keep = [c for c in df.columns if c not in names and c not in drop]
    source = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), *[a.alias(f"a{i}") for i, a in enumerate(args)])
    return source.mapInArrow(run, f"row {source.schema['row'].dataType.simpleString()}, {new}").select("row.*", *names)


def _images(b: pa.RecordBatch) -> Iterator[np.ndarray | None]:
    for h, w, data in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
        yield np.frombuffer(data, np.uint8).reshape(h, w, 3) if data and h and w and h > 0 and w > 0 else None


def _each(df: DataFrame, fn: Callable[..., np.ndarray | None], *args: Column, drop: tuple[str, ...] = ()) -> DataFrame:
    """fn(image, *args) for each image; unreadable ones, and those for which fn has none, give nulls."""

    extra = len(args)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            more = [b.column(4 + i).to_pylist() for i in range(extra)]
            out = [None if img is None else fn(img, *a) for img, *a in zip(_images(b), *more)]
            size = lambda i: pa.array([None if o is None else o.shape[i] for o in out], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), size(0), size(1), pa.array([None if o is None else np.ascontiguousarray(o).tobytes() for o in out], pa.binary())], ["row", "height", "width", "data"])

    return _narrow(df, [F.col("height"), F.col("width"), F.col("data"), *args], run, "height int, width int, data binary", drop)


def data_stats(df: DataFrame) -> DataFrame:
    """df without its data, with px_min, px_max and px_std (population) over all pixels and channels; null for images without data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(None, None, None) if img is None else (int(img.min()), int(img.max()), float(img.std())) for img in _images(b)]
            of = lambda i, t: pa.array([x[i] for x in found], t)
            yield pa.RecordBatch.from_arrays([b.column(0), of(0, pa.int64()), of(1, pa.int64()), of(2, pa.float64())], ["row", "px_min", "px_max", "px_std"])

    return _narrow(df, [F.col("height"), F.col("width"), F.col("data")], run, "px_min bigint, px_max bigint, px_std double", ("data",))


def letterbox(df: DataFrame, size: int) -> DataFrame:
    """size x size images on black; unreadable and degenerate rows are left out."""
    return _each(df, lambda img: kernels.letterbox(img, size)).where("data is not null")


def letterbox_tally(before: DataFrame, after: DataFrame, *by: str) -> DataFrame:
    """(by, found, resized): rows before and after letterbox()."""
    found = before.groupBy(*by).agg(F.count("*").alias("found"))
    return found.join(after.groupBy(*by).agg(F.count("*").alias("resized")), list(by), "left").withColumn("resized", F.coalesce("resized", F.lit(0)).cast("bigint"))


def stretch_resize(df: DataFrame, size: int) -> DataFrame:
    """Straight to a square, whatever the shape, in colour: what serving does, unlike letterbox() and to_grayscale()."""
    return _each(df, lambda img: kernels.stretch(img, size))


def to_grayscale(df: DataFrame) -> DataFrame:
    return _each(df, kernels.grayscale)


def augment_params(df: DataFrame, degrees: float = 0, flip: float = 0, brightness: float = 0, contrast: float = 0, seed: int = 42, epoch: int = 0, key: str = "key", copy: str | None = None) -> DataFrame:
    """df with aug: angle, flip, brightness, contrast and whether brightness comes first, each off at 0."""
    u = lambda what: unit(key_hash(f"{seed}:{epoch}:{what}", F.col(copy) if copy else F.lit(0), key))
    factor = lambda what, x: F.lit(max(0.0, 1.0 - x)) + u(what) * F.lit(1.0 + x - max(0.0, 1.0 - x))
    return df.withColumn("aug", F.struct(((u("angle") * 2 - 1) * F.lit(float(degrees))).alias("angle"), (u("flip") < F.lit(float(flip))).alias("flip"), factor("brightness", brightness).alias("brightness"), factor("contrast", contrast).alias("contrast"), (u("order") < 0.5).alias("brightness_first")))


def _augmented(img: np.ndarray, aug: dict) -> np.ndarray:
    img = kernels.rotate(img, aug["angle"])
    img = img[:, ::-1] if aug["flip"] else img
    if aug["brightness"] != 1 or aug["contrast"] != 1:
        img = kernels.jitter(img, aug["brightness"], aug["contrast"], aug["brightness_first"])
    return img


def augment_rotate(df: DataFrame, degrees: float, seed: int = 42, epoch: int = 0, key: str = "key") -> DataFrame:
    return _each(augment_params(df, degrees=degrees, seed=seed, epoch=epoch, key=key), _augmented, F.col("aug"), drop=("aug",)) if degrees else df


def augment_jitter(df: DataFrame, brightness: float, contrast: float, seed: int = 42, epoch: int = 0, key: str = "key") -> DataFrame:
    return _each(augment_params(df, brightness=brightness, contrast=contrast, seed=seed, epoch=epoch, key=key), _augmented, F.col("aug"), drop=("aug",)) if brightness or contrast else df


def flip_decision(p: float, seed: int = 42, epoch: int = 0, key: str = "key") -> Column:
    return unit(key_hash(f"{seed}:{epoch}:flip", F.lit(0), key)) < F.lit(float(p))


def augment_hflip(df: DataFrame, p: float, width: int, pixels: str = "px", seed: int = 42, epoch: int = 0, key: str = "key") -> DataFrame:
    """Array form: rows of `width` pixels are turned round where the key's hash is below p."""
    rows = F.transform(F.sequence(F.lit(0), F.expr(f"size({pixels}) div {width} - 1").cast("int")), lambda r: F.reverse(F.slice(pixels, r * width + 1, width)))
    return df.withColumn(pixels, F.when(flip_decision(p, seed, epoch, key) & (F.size(pixels) >= width), F.flatten(rows)).otherwise(F.col(pixels))) if p else df


def augment_n(df: DataFrame, n: int) -> DataFrame:
    """df with copy 0, the original, and n more."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n))))


def augment_copies(df: DataFrame, n: int, degrees: float = 0, flip: float = 0, brightness: float = 0, contrast: float = 0, seed: int = 42, epoch: int = 0, key: str = "key") -> DataFrame:
    """augment_n() with each copy but the original augmented."""
    x = augment_params(augment_n(df, n), degrees, flip, brightness, contrast, seed, epoch, key, "copy")
    return _each(x, lambda img, aug, copy: _augmented(img, aug) if copy else img, F.col("aug"), F.col("copy"), drop=("aug",))


def normalize_pixels(pixels: str | Column, mean: float = kernels.MEAN[0], std: float = kernels.STD[0]) -> Column:
    """Array form, one channel: (x / 255 - mean) / std."""
    return F.transform(pixels, lambda x: (x.cast("double") / 255 - F.lit(mean)) / F.lit(std))


def _features(df: DataFrame, fn: Callable[..., np.ndarray], *args: Column, drop: tuple[str, ...] = ()) -> DataFrame:
    extra = len(args)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            more = [b.column(4 + i).to_pylist() for i in range(extra)]
            out = [None if img is None else fn(img, *a).ravel() for img, *a in zip(_images(b), *more)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.float32()))], ["row", "features"])

    return _narrow(df, [F.col("height"), F.col("width"), F.col("data"), *args], run, "features array<float>", ("height", "width", "data", *drop))


def normalize(df: DataFrame) -> DataFrame:
    """features: 3 x height x width floats."""
    return _features(df, kernels.normalize)


def prepare_train(df: DataFrame, degrees: float = 15, flip: float = 0.5, brightness: float = 0.1, contrast: float = 0.1, seed: int = 42, epoch: int = 0, key: str = "key") -> DataFrame:
    """Grey, rotated, flipped, jittered, normalised, in one pass."""
    x = augment_params(df, degrees, flip, brightness, contrast, seed, epoch, key)
    return _features(x, lambda img, aug: kernels.normalize(_augmented(kernels.grayscale(img), aug)), F.col("aug"), drop=("aug",))


def prepare_eval(df: DataFrame) -> DataFrame:
    """Grey and normalised only."""
    return _features(df, lambda img: kernels.normalize(kernels.grayscale(img)))


def tensor_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, total) of features, rounded sums for comparison across runs."""
    return df.select(*keys, F.size("features").cast("bigint").alias("n"), F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))
