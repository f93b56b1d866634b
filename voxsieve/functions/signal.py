"""Numeric kernels for audio: decoding, hashing, quality, denoising and CTC alignment. NumPy only; Arrow carries the batches."""

from __future__ import annotations

import hashlib
import io
import wave
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE = 16_000
_SCALE = {2: (np.int16, 32768.0), 4: (np.int32, 2147483648.0)}


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """Mono float32 samples and rate of a 16- or 32-bit WAV file; channels are averaged."""
    with wave.open(io.BytesIO(data)) as w:
        rate, channels, width = w.getframerate(), w.getnchannels(), w.getsampwidth()
        raw = w.readframes(w.getnframes())
    if width not in _SCALE:
        raise ValueError(f"{8 * width}-bit samples aren't supported")
    kind, scale = _SCALE[width]
    x = np.frombuffer(raw, kind).astype(np.float32) / np.float32(scale)
    return (x.reshape(-1, channels).mean(axis=1) if channels > 1 else x), rate


def encode_wav(x: np.ndarray, rate: int = RATE) -> bytes:
    """A 16-bit mono WAV file of samples clipped to -1..1."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(np.asarray(x, np.float32).ravel(), -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def resampled(x: np.ndarray, rate: int, target: int = RATE) -> np.ndarray:
    """Linear interpolation to another rate."""
    x = np.asarray(x, np.float32).ravel()
    if rate == target or not x.size:
        return x
    n = max(1, round(len(x) * target / rate))
    return np.interp(np.linspace(0, len(x) - 1, n), np.arange(len(x)), x).astype(np.float32)


def pcm_digest(x: np.ndarray, rate: int) -> str:
    """SHA-256 of the samples at 16 kHz as little-endian float32."""
    return hashlib.sha256(resampled(x, rate).astype("<f4").tobytes()).hexdigest()


QUALITY = "duration_sec rms_dbfs peak clip_rate dc_offset zero_ratio speech_ratio silence_ratio longest_speech_sec snr_vad_db spectral_flatness spectral_flux band_energy_low band_energy_mid band_energy_high".split()


def quality(x: np.ndarray, rate: int, spectral_sec: float | None = None) -> dict[str, float | bool | None]:
    """Level, frame-energy and spectral features of one recording; an empty or non-finite one is ``fatal_invalid`` with nulls.

    Flatness and bands are those of the whole recording, or of its first ``spectral_sec`` seconds (10 give the values of older runs).
    """
    y = np.asarray(x, np.float32).ravel()
    if not y.size or not np.isfinite(y).all():
        return dict.fromkeys(QUALITY) | {"duration_sec": 0.0, "snr_valid": False, "fatal_invalid": True}
    tiny = 1e-8
    out: dict = {"duration_sec": len(y) / rate, "rms_dbfs": 20 * np.log10(np.sqrt(np.mean(y * y)) + tiny), "peak": np.abs(y).max(), "fatal_invalid": False}
    out |= {"clip_rate": np.mean(np.abs(y) >= 0.999), "dc_offset": abs(y.mean()), "zero_ratio": np.mean(np.abs(y) < 1e-6)}
    frame = max(1, round(rate * 0.02))
    frames = y[: len(y) // frame * frame].reshape(-1, frame)
    share, run, snr, flux = 0.0, 0, None, 0.0
    if len(frames):
        power = np.mean(frames**2, axis=1)
        active = power > max(2.0 * np.percentile(power, 20), 1e-7)
        share = active.mean()
        edges = np.flatnonzero(np.diff(np.concatenate(([0], active.astype(np.int8), [0]))))
        run = int((edges[1::2] - edges[::2]).max(initial=0))
        if active.any() and not active.all() and (noise := float(power[~active].mean())) > tiny:
            snr = 10 * np.log10(max(float(power[active].mean()) - noise, tiny) / (noise + tiny))
        spectra = np.abs(np.fft.rfft(frames * np.hanning(frame).astype(np.float32), axis=1))
        flux = np.abs(np.diff(spectra, axis=0)).mean(axis=1).mean() if len(frames) > 1 else 0.0
    out |= {"speech_ratio": share, "silence_ratio": 1 - share, "longest_speech_sec": run * frame / rate, "snr_vad_db": snr, "snr_valid": snr is not None, "spectral_flux": flux}
    n = len(y) if spectral_sec is None else min(len(y), round(spectral_sec * max(rate, 1)))
    p = np.square(np.abs(np.fft.rfft(y[:n] * np.hanning(n)))) + tiny if n > 1 else np.array([tiny])
    hz = np.fft.rfftfreq(n, 1 / max(rate, 1)) if n > 1 else np.zeros(1)
    out["spectral_flatness"] = np.exp(np.mean(np.log(p))) / p.mean()
    for name, inside in (("low", hz < 300), ("mid", (hz >= 300) & (hz < 3400)), ("high", hz >= 3400)):
        out[f"band_energy_{name}"] = p[inside].sum() / p.sum()
    return {k: v if v is None or isinstance(v, bool) else float(v) for k, v in out.items()}


def denoised(x: np.ndarray, rate: int, size: int = 512, hop: int = 128, floor: float = 0.05, over: float = 1.2) -> np.ndarray:
    """Spectral subtraction of powers: the noise spectrum is the mean of the first quarter second, ``floor`` the least share of a bin's power that stays.

    The recording is padded by half a window at both ends and the result clipped to -1..1; one shorter than a twentieth of a second (or 16 samples) is left as it is.
    """
    x = np.asarray(x, np.float32).ravel()
    if len(x) < max(16, rate // 20):
        return x.copy()
    window, tiny = np.hanning(size).astype(np.float32), 1e-10
    padded = np.pad(x, size // 2)
    starts = np.arange(0, max(1, len(padded) - size + 1), hop)
    padded = np.pad(padded, (0, max(0, int(starts[-1]) + size - len(padded))))
    spectra = np.fft.rfft(padded[starts[:, None] + np.arange(size)] * window, axis=1)
    power = np.abs(spectra) ** 2
    noise = power[: max(1, min(len(starts), round(0.25 * rate / hop)))].mean(axis=0)
    gain = np.sqrt(np.maximum(power - over * noise, floor * power + tiny) / (power + tiny))
    frames = np.fft.irfft(spectra * gain, n=size, axis=1) * window
    out, weight = np.zeros(len(padded)), np.zeros(len(padded))
    for s, f in zip(starts, frames, strict=True):
        out[s : s + size] += f
        weight[s : s + size] += window**2
    inner = slice(size // 2, size // 2 + len(x))
    return np.clip(out[inner] / np.maximum(weight[inner], 1e-6), -1, 1).astype(np.float32)


def faded(x: np.ndarray, rate: int, milliseconds: float) -> np.ndarray:
    """A linear fade at both ends, each at most half of the samples."""
    y = np.array(x, np.float32)
    n = min(round(rate * milliseconds / 1000), len(y) // 2)
    if n > 0:
        ramp = np.linspace(0, 1, n, dtype=np.float32)
        y[:n] *= ramp
        y[-n:] *= ramp[::-1]
    return y


def cut_audio(cuts: DataFrame, fade_ms: float = 0.0) -> DataFrame:
    """``path, view, pcm_sha256, content`` of cuts (``path, content, view, start_sample, end_sample``) as WAV files; cuts of unreadable files fall out."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content, view, a, b in zip(*(pdf[c] for c in ("path", "content", "view", "start_sample", "end_sample")), strict=True):
                try:
                    x, rate = decode_wav(bytes(content))
                except (ValueError, EOFError, wave.Error):
                    continue
                data = encode_wav(faded(x[a:b], rate, fade_ms), rate)
                rows.append((path, view, pcm_digest(*decode_wav(data)), data))
            yield pd.DataFrame(rows, columns=["path", "view", "pcm_sha256", "content"])

    return cuts.select("path", "content", "view", "start_sample", "end_sample").mapInPandas(work, "path string, view string, pcm_sha256 string, content binary")


@dataclass(frozen=True)
class Alignment:
    align_logp_sum: float
    align_logp_mean: float
    token_score_min: float
    start_frame: int
    end_frame: int
    blank_ratio: float
    token_scores: list[float]


def align(log_probs: np.ndarray, tokens: list[int], blank: int = 0) -> Alignment:
    """The best CTC path of ``tokens`` in a [frames, labels] matrix of log-probabilities.

    Frames before the path are free; frames after the last token are paid for as blanks, then trimmed. Equal labels need a
    blank between them. On ties a state is kept before it is entered, and entered before the path begins anew. Raises ValueError for an empty or unreachable target and for non-finite input.
    """
    lp = np.asarray(log_probs, np.float64)
    if lp.ndim != 2 or not lp.size or not np.isfinite(lp).all():
        raise ValueError("log-probabilities must be a finite, non-empty matrix")
    if not tokens or min(tokens) < 0 or max(tokens) >= lp.shape[1] or not 0 <= blank < lp.shape[1]:
        raise ValueError("tokens must be known labels, at least one")
    labels = np.full(2 * len(tokens) + 1, blank)
    labels[1::2] = tokens
    n = len(labels)
    skip = np.zeros(n, bool)
    skip[3::2] = labels[3::2] != labels[1:-2:2]
    emit = lp[:, labels]
    score, came = np.full(n, -np.inf), np.empty((len(lp), n), np.int8)
    fresh = np.where(np.arange(n) < 2, 0.0, -np.inf)
    for t in range(len(lp)):
        one = np.concatenate(([-np.inf], score[:-1]))
        two = np.where(skip, np.concatenate(([-np.inf, -np.inf], score[:-2])), -np.inf)
        ways = np.stack([score, one, two, fresh])
        came[t] = ways.argmax(axis=0)
        score = ways.max(axis=0) + emit[t]
    state = n - 1 if score[n - 1] >= score[n - 2] else n - 2
    if not np.isfinite(score[state]):
        raise ValueError("the target can't be aligned")
    path, t = [state], len(lp) - 1
    while came[t, state] != 3:
        state -= int(came[t, state])
        t -= 1
        path.append(state)
    path = np.array(path[::-1])
    odd = np.flatnonzero(path % 2)
    start, path = t + int(odd[0]), path[odd[0] : odd[-1] + 1]
    values = emit[start + np.arange(len(path)), path]
    per_token = [float(values[path == 2 * k + 1].mean()) if (path == 2 * k + 1).any() else np.nan for k in range(len(tokens))]
    if np.isnan(per_token).any():
        raise ValueError("a token has no frame")
    return Alignment(float(values.sum()), float(np.mean(per_token)), min(per_token), start, start + len(path) - 1, float(np.mean(path % 2 == 0)), per_token)


def audio_features(files: DataFrame) -> DataFrame:
    """``path, sample_rate, pcm_sha256`` and the quality features of WAV files read as binary (``path, content``).

    Files that can't be decoded give ``fatal_invalid`` and nulls.
    """
    schema = "path string, sample_rate int, pcm_sha256 string, " + ", ".join(f"{k} double" for k in QUALITY) + ", snr_valid boolean, fatal_invalid boolean"

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    x, rate = decode_wav(bytes(content))
                    rows.append({"path": path, "sample_rate": rate, "pcm_sha256": pcm_digest(x, rate)} | quality(x, rate))
                except (ValueError, EOFError, wave.Error, TypeError):
                    rows.append({"path": path, "sample_rate": None, "pcm_sha256": None} | quality(np.zeros(0), RATE))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).astype({"sample_rate": "Int32"})

    return files.select("path", "content").mapInPandas(work, schema)


def alignments(rows: DataFrame, frames_per_second: float = 50.0) -> DataFrame:
    """``rows`` (``log_probs array<array<double>>, tokens array<int>``) with the struct ``alignment``; null where alignment fails."""
    schema = "align_logp_sum double, align_logp_mean double, token_score_min double, start_frame long, end_frame long, blank_ratio double, start_sec double, end_sec double, error string"

    @F.pandas_udf(schema)
    def run(lp: pd.Series, tokens: pd.Series) -> pd.DataFrame:
        out = []
        for a, t in zip(lp, tokens, strict=True):
            try:
                r = align(np.stack(a), [int(x) for x in t])
                out.append((r.align_logp_sum, r.align_logp_mean, r.token_score_min, r.start_frame, r.end_frame, r.blank_ratio, r.start_frame / frames_per_second, (r.end_frame + 1) / frames_per_second, None))
            except (ValueError, TypeError) as e:
                out.append((*[None] * 8, str(e)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")]).astype({"start_frame": "Int64", "end_frame": "Int64"})

    return rows.withColumn("alignment", run("log_probs", "tokens"))
