"""The image transform as a parameter: a chain of steps.

A step is any callable ``step(images, draws) -> images`` over a batch: a list
of float RGB arrays ``[h, w, 3]`` in [0, 1] (any sizes) and ``Draws``, which gives
every image its own random numbers, keyed by guid, epoch, seed and the step's
name, so that they don't depend on partitions, order or batch. A step with
``train_only = True`` runs on training images only.

``Transform`` composes steps in their order inside one Arrow pass and stacks
the result to ``[n, 3, h, w]``. ``standard(size)`` is the built-in chain: resize,
flip, rotate, normalise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np

from twinlens.operators import image_prep as ip

Images = list[np.ndarray]


@dataclass(frozen=True)
class Draws:
    """Random numbers of a batch's images."""
    guids: Sequence[str]
    epoch: int = 1
    seed: int = 42

    def bits(self, step: str) -> np.ndarray:
        """One whole number below 2**32 for each image."""
        return np.array([ip.draw_py(g, self.epoch, self.seed, step) for g in self.guids], np.int64)

    def uniform(self, step: str, low: float = 0.0, high: float = 1.0) -> np.ndarray:
        return low + (high - low) * (self.bits(step) / float(1 << 32))


Step = Callable[[Images, Draws], Images]


@dataclass(frozen=True)
class Resize:
    """Bilinear, antialiased when shrinking, to ``height`` x ``width``; the aspect ratio is not kept."""
    height: int
    width: int
    train_only = False

    def __call__(self, images: Images, draws: Draws) -> Images:
        return [ip.resize_rgb(x, self.height, self.width) for x in images]


@dataclass(frozen=True)
class RandomFlip:
    """Left and right exchanged with probability ``p``."""
    p: float = 0.5
    train_only = True

    def __call__(self, images: Images, draws: Draws) -> Images:
        flip = draws.bits("flip") < ip.flip_threshold(self.p)
        return [x[:, ::-1] if f else x for x, f in zip(images, flip, strict=True)]


@dataclass(frozen=True)
class RandomRotation:
    """Turned about the centre by up to ``degrees`` either way, same size, ``fill`` outside."""
    degrees: float = 15.0
    fill: float = 0.0
    train_only = True

    def __call__(self, images: Images, draws: Draws) -> Images:
        return [ip.rotate_rgb(x, float(ip.angle_of(d, self.degrees)), self.fill)
                for x, d in zip(images, draws.bits("rot"), strict=True)]


@dataclass(frozen=True)
class Normalize:
    """``(x - mean) / std`` by channel."""
    mean: tuple[float, ...] = ip.MEAN
    std: tuple[float, ...] = ip.STD
    train_only = False

    def __call__(self, images: Images, draws: Draws) -> Images:
        return [(x - np.asarray(self.mean)) / np.asarray(self.std) for x in images]


@dataclass(frozen=True)
class Transform:
    """Steps in their order; the result is one ``[n, channels, h, w]`` array."""
    steps: tuple[Step, ...]

    def __call__(self, images: Images, guids: Sequence[str], train: bool = False, epoch: int = 1,
                 seed: int = 42) -> np.ndarray:
        draws = Draws(guids, epoch, seed)
        for step in self.steps:
            if train or not getattr(step, "train_only", False):
                images = step(images, draws)
                if len(images) != len(guids):
                    raise ValueError(f"{step} returned {len(images)} images for {len(guids)}")
        shapes = {x.shape for x in images}
        if len(shapes) > 1:
            raise ValueError(f"the transform leaves images of several shapes: {sorted(shapes)[:3]}")
        return np.ascontiguousarray(np.stack(images).transpose(0, 3, 1, 2))

    def black(self) -> np.ndarray:
        """The default black image after the evaluation steps, ``[1, channels, h, w]``."""
        return self([np.zeros((ip.SIZE, ip.SIZE, 3))], [""])


def standard(size: int = ip.SIZE) -> Transform:
    """Resize, flip and rotate (training only), normalise."""
    return Transform((Resize(size, size), RandomFlip(), RandomRotation(), Normalize()))


def flat_features(out: np.ndarray, rows: int, dim: int) -> np.ndarray:
    """An encoder's output as ``[rows, dim]``.

    Nested axes, as in ``[n, dim, 1, 1]``, are flattened; the number of values is checked.
    """
    flat = np.asarray(out, dtype=np.float64)
    if flat.ndim == 0 or flat.shape[0] != rows or flat.size != rows * dim:
        raise ValueError(f"the encoder returned shape {flat.shape} for {rows} rows of {dim} features")
    return flat.reshape(rows, dim)
