"""What outside models have to offer. None comes with the library; energy voice activity is the one that needs no weights."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from strophe.functions.signal import read_wave, voice_end, voiced_frames


class Transcriber(Protocol):
    """Words of a sound, with times: (start, end, word)."""

    def __call__(self, samples: np.ndarray, rate: int) -> list[tuple[float, float, str]]: ...


class VoiceDetector(Protocol):
    """Voiced stretches (start, end) of a sound."""

    def __call__(self, samples: np.ndarray, rate: int) -> list[tuple[float, float]]: ...


class Embedder(Protocol):
    """One vector for each sound."""

    def __call__(self, sounds: list[np.ndarray], rate: int) -> np.ndarray: ...


class StructureModel(Protocol):
    """Boundaries (time, label) of a sound, the last one its end."""

    def __call__(self, samples: np.ndarray, rate: int) -> list[tuple[float, str]]: ...


class Separator(Protocol):
    """Voice and the rest of a sound."""

    def __call__(self, samples: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray]: ...


def energy_detector(samples: np.ndarray, rate: int) -> list[tuple[float, float]]:
    """The voice that begins with the sound, by energy."""
    end = voice_end(voiced_frames(samples, rate), len(samples), rate)
    return [(0.0, end)] if end > 0 else []


def map_sounds(files: DataFrame, function: Callable[[np.ndarray, int], list[tuple[float, float]]]) -> DataFrame:
    """path, start, end for the stretches that a detector finds in files read as binary (path, content). A file that can't be read gives an error row instead of failing the job."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    samples, rate = read_wave(bytes(content))
                    out += [(path, a, b, None) for a, b in function(samples, rate)]
                except Exception as e:  # noqa: BLE001 - kept as the file's error
                    out.append((path, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "start", "end", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, start double, end double, error string")


def map_or_null(df: DataFrame, function: Callable[[dict], dict], schema: str) -> DataFrame:
    """What a function makes of each row, as schema says, and error: a row on which it fails has nulls and the error instead of failing the job. A result's other fields are left out, missing ones are null."""
    names = [f.split()[0].strip("`") for f in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                try:
                    found = function(row)
                    out.append({n: found.get(n) for n in names} | {"error": None})
                except Exception as e:  # noqa: BLE001 - kept as the row's error
                    out.append(dict.fromkeys(names) | {"error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(out, columns=[*names, "error"])

    return df.mapInPandas(run, f"{schema}, error string")


#: Voice detectors by name; energy needs no weights, others are registered by who brings them.
DETECTORS: dict[str, Callable[[], VoiceDetector]] = {"energy": lambda: energy_detector}


def voice_detector(name: str) -> VoiceDetector:
    """A voice detector by its name."""
    if name not in DETECTORS:
        raise KeyError(f"no voice detector {name}: {', '.join(sorted(DETECTORS))}")
    return DETECTORS[name]()
