"""Frames of video segments. Decoding needs OpenCV on the executors; without it, the positions and times of frames still work."""

from __future__ import annotations

import importlib.util
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from rovermill.functions.kinematics import crop_box

FRAMES = "path string, frame_no long, width int, height int, jpeg binary"


def available() -> bool:
    return importlib.util.find_spec("cv2") is not None


def decode(segments: DataFrame) -> DataFrame:
    """Frames of binary segments (path, content), cropped to 4:3 and halved, as JPEG. Undecodable frames keep their number."""
    if not available():
        raise RuntimeError("decoding video needs OpenCV (cv2) on every executor")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tempfile

        import cv2

        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                with tempfile.NamedTemporaryFile(suffix=".ts") as f:
                    f.write(content)
                    f.flush()
                    video = cv2.VideoCapture(f.name)
                    rows = []
                    n = 0
                    while video.grab():
                        ok, image = video.retrieve()
                        if ok:
                            small = crop_and_scale(image)
                            rows.append((path, n, small.shape[1], small.shape[0], cv2.imencode(".jpg", small)[1].tobytes()))
                        n += 1
                    yield pd.DataFrame(rows, columns=["path", "frame_no", "width", "height", "jpeg"])

    return segments.select("path", "content").mapInPandas(run, FRAMES)


def crop_and_scale(image: np.ndarray) -> np.ndarray:
    """Centre crop to 4:3 and half size of an H x W x C array, by the mean of pixel blocks."""
    left, top, right, bottom, w, h = crop_box(image.shape[1], image.shape[0])
    crop = image[top:bottom, left:right]
    crop = crop[: 2 * h, : 2 * w] if crop.shape[0] >= 2 * h and crop.shape[1] >= 2 * w else np.repeat(np.repeat(crop, 2, 0), 2, 1)[: 2 * h, : 2 * w]
    return crop.reshape(h, 2, w, 2, -1).mean(axis=(1, 3)).astype(image.dtype)
