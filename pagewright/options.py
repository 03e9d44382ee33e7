"""Thresholds and limits of all operators, and configuration from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Options:
    """Defaults of every command; `check` holds the combinations that are refused."""

    low_text: int = 30
    low_image_coverage: float = 0.03
    mixed_text: int = 150
    image_coverage: float = 0.5
    vlm_image_coverage: float = 0.5
    direct_vlm_drawings: int = 200
    candidate_drawings: int = 20
    min_visual_text: int = 80
    scanned_text: int = 30
    max_vlm_pages: int = 10
    vlm_dpi: int = 160
    vlm_max_tokens: int = 2600
    retry_max_tokens: int = 5000
    vlm_retries: int = 1
    request_timeout: int = 120
    progress_mode: str = "auto"
    page_progress_limit: int = 30
    provider: str = "none"
    openai_model: str = "gpt-5-mini"
    local_model: str = "qwen3"
    local_base_url: str = ""
    forced_pages: tuple[int, ...] = field(default=())
    vlm_only: bool = False
    plan_only: bool = False
    ocr: bool = False
    force_full_page_ocr: bool = False
    table_structure: bool = True
    chunk_size: int = 1000
    overlap_size: int = 150

    def model(self) -> str | None:
        return {"openai": self.openai_model, "local": self.local_model}.get(self.provider)

    def check(self, start_page: int = 1, end_page: int | None = None) -> Options:
        """Raises ValueError for values that no run accepts; returns itself."""
        wrong = [
            (self.max_vlm_pages < 0, "max_vlm_pages must not be negative"),
            (self.vlm_retries < 0, "vlm_retries must not be negative"),
            (self.vlm_dpi < 72, "vlm_dpi must be at least 72"),
            (self.vlm_only and self.plan_only, "vlm_only and plan_only exclude each other"),
            (self.vlm_only and self.provider == "none", "vlm_only needs a provider"),
            (start_page < 1 or (end_page is not None and end_page < start_page), "pages count from 1 and end after they start"),
            (any(p < start_page or (end_page is not None and p > end_page) for p in self.forced_pages), "a forced page is not among the requested pages"),
        ]
        for bad, message in wrong:
            if bad:
                raise ValueError(message)
        return self


def first_of(*names: str, env: dict[str, str] | None = None) -> str | None:
    """The first of some environment variables that is not empty."""
    env = os.environ if env is None else env
    return next((env[n] for n in names if env.get(n)), None)


def read_env(text: str, env: dict[str, str]) -> dict[str, str]:
    """KEY=value lines added to a copy of env; what is there already stays."""
    found = {}
    for line in text.splitlines():
        name, sign, value = line.strip().partition("=")
        if sign and not name.lstrip().startswith("#"):
            found[name.removeprefix("export ").strip()] = value.strip().strip("\"'")
    return found | env


def options_from(env: dict[str, str], **given) -> Options:
    """Options with the local gateway's address, model and time-out (120 s at least) from the environment."""
    base = {
        "local_base_url": first_of("VLM_LOCAL_BASE_URL", "OPENAI_BASE_URL", env=env) or "",
        "local_model": first_of("VLM_LOCAL_MODEL", "OPENAI_MODEL", env=env) or Options.local_model,
        "request_timeout": max(120, int(first_of("VLM_REQUEST_TIMEOUT", env=env) or 120)),
    }
    return Options(**(base | given))


def artifact_stem(stem: str, start: int | None = None, end: int | None = None, kind: str = "") -> str:
    """Name of an artifact: stem, kind, and its page range with four digits at least."""
    pages = f".p{start:04d}-p{end:04d}" if start is not None and end is not None else ""
    return f"{stem}{'.' + kind if kind else ''}{pages}"
