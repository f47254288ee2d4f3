"""Array containers (zip files of .npy members), read in blocks of rows, and written one an episode.

A container is opened where a task runs, by Arrow's file systems (local and shared folders, HDFS, S3, GCS), and its members
are read side by side, `ROWS` frames at once, whether they are compressed or not: no member is whole in memory. Only
arrays in Fortran order are, as their rows do not stand together. Spark lists the files and deals them out by size.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names that containers use for an array, in order.
ALIASES = {"poses": ["poses", "body", "keypoints"], "confidence": ["confidences", "confidence", "conf"]}
ROWS = 4096
FRAME = "path string, t int, ts double, pose array<double>, width int, confidence double, hands array<double>, error string"


class Member:
    """One array of a container; rows(n) gives its next n rows."""

    def __init__(self, zipped: zipfile.ZipFile, name: str):
        self.stream = zipped.open(f"{name}.npy")
        version = np.lib.format.read_magic(self.stream)
        read = {(1, 0): np.lib.format.read_array_header_1_0, (2, 0): np.lib.format.read_array_header_2_0}[version]
        self.shape, self.fortran, self.dtype = read(self.stream)
        if self.dtype.hasobject:
            raise ValueError(f"{name} holds Python objects")
        self.whole = np.frombuffer(self.stream.read(), self.dtype).reshape(self.shape, order="F") if self.fortran else None
        self.at = 0

    def rows(self, n: int) -> np.ndarray:
        if self.whole is not None:
            out, self.at = self.whole[self.at : self.at + n], self.at + n
            return out
        width = int(np.prod(self.shape[1:], dtype=np.int64)) * self.dtype.itemsize
        data = self.stream.read(n * width)
        return np.frombuffer(data, self.dtype).reshape(-1, *self.shape[1:]) if width else np.empty((min(n, self.shape[0]), *self.shape[1:]), self.dtype)

    def all(self) -> np.ndarray:
        return self.whole if self.whole is not None else np.frombuffer(self.stream.read(), self.dtype).reshape(self.shape)


def _rate(zipped: zipfile.ZipFile, names: set[str], fps: float) -> float:
    """fps; else the first number of metadata, if it is above 0; else the default."""
    if "fps" in names:
        return float(Member(zipped, "fps").all().reshape(-1)[0])
    if "metadata" in names:
        try:
            first = float(Member(zipped, "metadata").all().reshape(-1)[0])
        except (ValueError, IndexError):  # text, objects or nothing
            return fps
        return first if first > 0 else fps
    return fps


def frames_of(file, fps: float = 30.0, rows: int = ROWS) -> Iterator[dict[str, object]]:
    """Blocks of frames of one container: t, ts, pose, width, confidence, hands."""
    with zipfile.ZipFile(file) as zipped:
        names = {n.removesuffix(".npy") for n in zipped.namelist() if n.endswith(".npy")}
        pick = lambda k: next((Member(zipped, a) for a in ALIASES[k] if a in names), None)
        poses, conf = pick("poses"), pick("confidence")
        if poses is None:
            raise ValueError(f"no pose array among {sorted(names)}")
        if len(poses.shape) not in (2, 3):
            raise ValueError(f"poses have {len(poses.shape)} dimensions")
        n = poses.shape[0]
        width = poses.shape[2] if len(poses.shape) == 3 else 4 if poses.shape[1] % 4 == 0 else 3
        hands = [Member(zipped, h) for h in ("left_hand", "right_hand")] if {"left_hand", "right_hand"} <= names else []
        if any(len(h.shape) != 3 for h in hands):
            hands = []
        times = Member(zipped, "timestamps") if "timestamps" in names else None
        rate = _rate(zipped, names, fps)
        for at in range(0, n, rows):
            m = min(rows, n - at)
            block = {"t": np.arange(at, at + m), "width": width, "pose": poses.rows(m).reshape(m, -1).astype(float)}
            block["ts"] = times.rows(m).astype(float) if times else np.arange(at, at + m) / rate
            block["confidence"] = conf.rows(m).astype(float) if conf else np.full(m, np.nan)
            block["hands"] = np.stack([h.rows(m) for h in hands], axis=1).reshape(m, -1).astype(float) if hands else None
            yield block


def _opened(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _scanned(spark: SparkSession, path: str, fps: float) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")  # contents are not read

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for name in pdf["path"]:
                try:
                    with _opened(name) as file:
                        for b in frames_of(file, fps):
                            hands = [None] * len(b["t"]) if b["hands"] is None else list(b["hands"])
                            yield pd.DataFrame({"path": name, "t": b["t"], "ts": b["ts"], "pose": list(b["pose"]), "width": b["width"], "confidence": b["confidence"], "hands": hands, "error": None})
                except (ValueError, KeyError, zipfile.BadZipFile) as e:
                    yield pd.DataFrame({"path": [name], "t": [-1], "ts": [0.0], "pose": [None], "width": [0], "confidence": [0.0], "hands": [None], "error": [str(e)]})

    return files.mapInPandas(run, FRAME)


def read_arrays(spark: SparkSession, path: str, fps: float = 30.0, strict: bool = True) -> DataFrame:
    """One row a frame: path, t, ts, pose (flat), width of a joint, confidence (null without), hands (left, then right; or null).

    A container that holds no poses or can't be read is an error; without strict it is left out, and `array_errors` has it.
    """
    rows = _scanned(spark, path, fps)
    if strict:
        said = F.raise_error(F.concat_ws(": ", "path", "error"))
        rows = rows.withColumn("t", F.when(F.col("error").isNull(), F.col("t")).otherwise(said.cast("int")))
    return rows.where("error is null").drop("error") if not strict else rows.drop("error")


def array_errors(spark: SparkSession, path: str) -> DataFrame:
    """(path, error) of the containers that hold no poses or can't be read; of these no frame, or not all, are read."""
    return _scanned(spark, path, 30.0).where("error is not null").select("path", "error")


def _lists(v):
    return [_lists(x) for x in v] if isinstance(v, (list, np.ndarray)) else v


def write_arrays(frames: DataFrame, folder: str, episode: str = "episode_id", order: str = "t", compressed: bool = True) -> DataFrame:
    """One container an episode, with a member for each other column, in order; gives episode, path and n_frames.

    A task that runs again writes the same file. An episode's frames are in one task's memory. The files are there once
    the result has been read.
    """
    columns = [c for c in frames.columns if c not in (episode, order)]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        pdf = pdf.sort_values(order)
        arrays = {c: np.array(_lists(pdf[c].tolist())) for c in columns}
        packed = io.BytesIO()
        (np.savez_compressed if compressed else np.savez)(packed, **arrays)
        path = f"{folder}/{key[0]}.npz"
        system, inner = fs.FileSystem.from_uri(path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        with system.open_output_stream(inner) as out:
            out.write(packed.getvalue())
        return pd.DataFrame({"e": [key[0]], "path": [path], "n_frames": [len(pdf)]})

    kind = dict(frames.dtypes)[episode]
    return frames.groupBy(episode).applyInPandas(run, f"e {kind}, path string, n_frames bigint").withColumnRenamed("e", episode)
