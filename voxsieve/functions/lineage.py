"""Digests that tell whether two runs had the same inputs."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path


class OtherRun(RuntimeError):
    """The folder belongs to a run with other inputs."""


def json_digest(value: object) -> str:
    """SHA-256 of compact JSON with sorted keys."""
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def file_digest(path: str | Path | None) -> str | None:
    """SHA-256 of a file's bytes; None without a file."""
    if path is None or not Path(path).is_file():
        return None
    with Path(path).open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


# Suffixes of weights and of configuration files that make up a model.
MODEL_SUFFIXES = (".safetensors", ".bin", ".pt", ".pth", ".onnx", ".ckpt", ".params", ".index", ".json", ".txt", ".model", ".tokenizer")


def folder_digest(folder: str | Path | None, suffixes: tuple[str, ...] = MODEL_SUFFIXES) -> str | None:
    """SHA-256 over names, sizes and bytes of a folder's files with ``suffixes`` (case doesn't count), in order; None without a folder.

    Hidden files don't count. Where no file has such a suffix, all files of the folder itself count.
    """
    if folder is None or not Path(folder).is_dir():
        return None
    base = Path(folder)
    seen = [p for p in sorted(base.rglob("*")) if p.is_file() and not p.name.startswith(".")]
    h = hashlib.sha256()
    for p in [p for p in seen if p.suffix.lower() in suffixes] or [p for p in seen if p.parent == base]:
        h.update(f"{p.relative_to(base).as_posix()}\0{p.stat().st_size}\0".encode())
        with p.open("rb") as f:
            while chunk := f.read(1 << 20):
                h.update(chunk)
        h.update(b"\n")
    return h.hexdigest()


# What a run's signature tells. Of the files the digests count.
SIGNED_FILES = ["asr_sidecar", "nll_sidecar", "qkw_sidecar", "embedding_sidecar", "noise_sidecar", "policy_json"]
SIGNED_VALUES = [
    "extract_sep_run_id", "s1_arm", "s7_arm", "asr_model_hash", "asr_context_mode", "asr_command", "nll_command", "qkw_command", "embedding_command", "english_alias_table_hash", "qkw_calibrator_hash",
    "mossformer_model_hash", "inference_signature", "speaker_encoder_hash", "noise_model_hashes", "se_backend", "se_command", "se_batch_command",
]


def run_signature(route_policy: dict | None = None, qkw_calibrated: bool = False, **given: object) -> dict:
    """All that a run's results depend on, with the digest of it as ``signature_hash``.

    ``given`` are names of SIGNED_FILES (paths) and SIGNED_VALUES; what isn't given is null. Without an inference signature the enhancement's name stands for it.
    """
    unknown = sorted(set(given) - set(SIGNED_FILES) - set(SIGNED_VALUES))
    if unknown:
        raise ValueError(f"not part of a signature: {unknown}")
    out: dict = {n: given.get(n) for n in SIGNED_VALUES} | {f"{n}_hash": file_digest(given.get(n)) for n in SIGNED_FILES}
    out["inference_signature"] = out["inference_signature"] or out["se_backend"]
    out["policy_json"] = str(Path(given["policy_json"]).resolve()) if given.get("policy_json") else None
    out |= {"qkw_calibrated": bool(qkw_calibrated), "route_policy": route_policy or {}, "route_policy_hash": json_digest(route_policy or {})}
    return out | {"signature_hash": json_digest(out)}


def enhancement_binding(backend: str, audio_fingerprint: str, **transform: object) -> dict:
    """What enhanced recordings depend on: the transform and the set of raw recordings (see ``reporting.set_fingerprint``), and the digests of both."""
    signed = {"backend": backend, "output_contract": "full_waveform_wav/v1", "inference_signature": transform.pop("inference_signature", None) or backend, **transform}
    body = {"transform": signed, "transform_hash": json_digest(signed), "raw_pcm": audio_fingerprint}
    return body | {"signature_hash": json_digest(body)}


def claim(folder: str | Path, signature: dict) -> str:
    """Mark ``folder`` as that of the run with ``signature``; raises OtherRun if it belongs to another. Returns the digest."""
    path, digest = Path(folder) / "signature.json", json_digest(signature)
    if path.is_file():
        if json.loads(path.read_text())["digest"] != digest:
            raise OtherRun(f"{folder} was begun with other inputs")
        return digest
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"digest": digest, "signature": signature}, ensure_ascii=False, indent=2, sort_keys=True))
    return digest
