"""Thresholds and margins of the selection, frozen per run."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from dataclasses import dataclass

# Slots of the named streams.
STREAM_SLOTS = {"original": 0, "spk1": 1, "spk2": 2, "spk3": 3, "spk4": 4}


@dataclass(frozen=True)
class Policy:
    """``cer_close_delta`` opens a window of near-equal error; ``prefer_se_on_close_cer`` lets enhanced views win ties inside it."""

    # Names and defaults of the thresholds.

    qkw_low_thr: float | None = None
    qkw_switch_margin: float = 0.01
    nll_switch_margin: float = 0.01
    speaker_switch_margin: float = 0.01
    quality_regression_tolerance: float = 0.10
    cer_accept_thr: float | None = None
    clip_rate_thr: float = 0.01
    min_speech_ratio: float = 0.05
    cer_close_delta: float = 0.0
    noise_switch_margin: float = 0.05
    snr_switch_margin_db: float = 1.0
    dnsmos_switch_margin: float = 0.20
    prefer_se_on_close_cer: bool = False

    @classmethod
    def of(cls, *layers: dict) -> Policy:
        """Defaults, overridden by the non-null known fields of each layer in turn."""
        names = {f.name for f in dataclasses.fields(cls)}
        merged: dict = {}
        for layer in layers:
            merged |= {k: v for k, v in layer.items() if k in names and v is not None}
        return cls(**merged)

    def digest(self) -> str:
        """SHA-256 of the policy as compact JSON with sorted keys."""
        return hashlib.sha256(json.dumps(dataclasses.asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()


#: A policy with a window of 0.02 that prefers enhanced views.
CLOSE = Policy(cer_close_delta=0.02, prefer_se_on_close_cer=True)
