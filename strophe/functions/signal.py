"""Sound as arrays: reading, loudness, energy voice activity, signal to noise."""

from __future__ import annotations

import base64
import io
import wave

import numpy as np


def read_wave(content: bytes, mono: bool = True, start: float = 0.0, end: float | None = None) -> tuple[np.ndarray, int]:
    """Samples in -1 .. 1 (channels first; the first one only for mono) between two times, and the rate, of PCM sound of 8, 16, 24 or 32 bits."""
    with wave.open(io.BytesIO(content)) as sound:
        rate, width = sound.getframerate(), sound.getsampwidth()
        first = min(max(0, int(start * rate)), sound.getnframes())
        sound.setpos(first)
        raw = np.frombuffer(sound.readframes((sound.getnframes() if end is None else min(int(end * rate), sound.getnframes())) - first), dtype=np.uint8)
        if width == 1:
            data = (raw.astype(np.float32) - 128) / 128
        else:
            # Little-endian samples of any width in the upper bytes of 32 bits.
            wide = np.zeros((len(raw) // width, 4), dtype=np.uint8)
            wide[:, 4 - width :] = raw.reshape(-1, width)
            data = (wide.view("<i4")[:, 0] / 2**31).astype(np.float32)
        data = data.reshape(-1, sound.getnchannels()).T
        return (data[0] if mono else data), rate


def resampled(samples: np.ndarray, rate: int, wanted: int) -> np.ndarray:
    """Samples at another rate: through the spectrum, so that nothing above half the lower rate is left."""
    n = len(samples)
    m = round(n * wanted / rate)
    if n == 0 or m == n:
        return samples
    spectrum = np.fft.rfft(samples)
    kept = np.zeros(m // 2 + 1, dtype=complex)
    both = min(len(kept), len(spectrum))
    kept[:both] = spectrum[:both]
    return (np.fft.irfft(kept, m) * (m / n)).astype(np.float32)


def clip_base64(content: bytes, start: float, end: float) -> str:
    """A stretch of a sound as the text of a WAV file."""
    samples, rate = read_wave(content, mono=False, start=start, end=end)
    return base64.b64encode(write_wave(samples, rate)).decode()


def write_wave(samples: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    data = np.atleast_2d(samples)
    with wave.open(out, "wb") as sound:
        sound.setnchannels(len(data))
        sound.setsampwidth(2)
        sound.setframerate(rate)
        sound.writeframes((np.clip(data.T, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def wave_seconds(content: bytes) -> float | None:
    """Length by the header; None if there is none that can be read."""
    try:
        with wave.open(io.BytesIO(content)) as sound:
            return sound.getnframes() / sound.getframerate()
    except (wave.Error, EOFError, ZeroDivisionError):
        return None


def voiced_frames(audio: np.ndarray, rate: int, frame: int = 1024, hop: int = 256, threshold: float = 0.01, low: float = 200, high: float = 4000) -> np.ndarray:
    """Whether each frame (centred, Hann window) has energy between two frequencies."""
    padded = np.pad(np.asarray(audio, dtype=np.float64), frame // 2)
    count = max(0, 1 + (len(padded) - frame) // hop)
    if not count:
        return np.zeros(0, dtype=bool)
    frames = np.lib.stride_tricks.sliding_window_view(padded, frame)[::hop][:count]
    power = np.abs(np.fft.rfft(frames * (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(frame) / frame)), axis=1)) ** 2
    band = np.fft.rfftfreq(frame, 1 / rate)
    return np.sqrt(power[:, (band >= low) & (band <= high)].mean(axis=1) + 1e-8) > threshold


def voice_end(voiced: np.ndarray, samples: int, rate: int, hop: int = 256, silence: float = 1.0) -> float:
    """Where the voice that begins with the sound ends: after the last voiced frame before the first silence of that many seconds."""
    need = max(1, int(silence * rate / hop))
    at = np.flatnonzero(voiced)
    if not len(at) or at[0] >= need:
        return 0.0
    breaks = np.flatnonzero(np.diff(at) - 1 >= need)
    last = at[breaks[0]] if len(breaks) else at[-1]
    return float(min(samples / rate, (last + 1) * hop / rate))


def to_loudness(samples: np.ndarray, decibels: float = -25.0, tiny: float = 1e-6) -> tuple[np.ndarray, float]:
    """Samples at a root mean square level and the factor that made them so."""
    factor = 10 ** (decibels / 20) / (float(np.sqrt(np.mean(np.square(samples)))) + tiny)
    return samples * factor, factor


def without_clipping(samples: np.ndarray, tiny: float = 1e-5) -> tuple[np.ndarray, float]:
    """Samples divided so that none exceeds 1, and the divisor (at least 1 + tiny)."""
    divisor = max(1.0, float(np.abs(samples).max(initial=0.0))) + tiny
    return samples / divisor, divisor


def restored(samples: np.ndarray, factor: float, divisor: float) -> np.ndarray:
    return samples * divisor / factor


def si_snr(estimate: np.ndarray, target: np.ndarray, tiny: float = 1e-8) -> float:
    """Scale-invariant signal to noise ratio in decibels."""
    x, s = estimate - estimate.mean(), target - target.mean()
    part = (x @ s) * s / (s @ s + tiny)
    return float(20 * np.log10(tiny + np.linalg.norm(part) / (np.linalg.norm(x - part) + tiny)))


def stretched(samples: np.ndarray, least: int) -> np.ndarray:
    """Samples repeated one by one until there are at least so many."""
    if not len(samples):
        return samples
    return np.repeat(samples, max(1, -(-least // len(samples))))
