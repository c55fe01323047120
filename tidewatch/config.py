"""Settings of the pipeline and of the table loader, read from the environment and held to their lower bounds."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

STREAM_START = "0-0"


def int_setting(env: Mapping[str, str], name: str, default: int, least: int | None = None) -> int:
    """An integer from ``env``; what is missing or isn't an integer is the default, what is too small the bound."""
    try:
        value = int(env.get(name, "").strip() or default)
    except ValueError:
        value = default
    return value if least is None else max(least, value)


def bool_setting(env: Mapping[str, str], name: str, default: bool) -> bool:
    value = env.get(name, "").strip().lower()
    return value in {"1", "true", "yes", "on"} if value else default


@dataclass(frozen=True)
class PipelineConfig:
    host_id: str = "unknown-host"
    retry_max: int = 3
    dedupe_ttl_seconds: int = 3600
    block_ms: int = 5000
    batch_count: int = 25

    @classmethod
    def load(cls, env: Mapping[str, str] | None = None) -> PipelineConfig:
        e = os.environ if env is None else env
        return cls(
            e.get("HOST_ID", "").strip() or "unknown-host",
            int_setting(e, "RETRY_MAX", 3, 1),
            int_setting(e, "DEDUPE_TTL_SECONDS", 3600, 60),
            int_setting(e, "BLOCK_MS", 5000, 100),
            int_setting(e, "BATCH_COUNT", 25, 1),
        )


@dataclass(frozen=True)
class TransformConfig:
    batch_size: int = 200
    interval_seconds: int = 60
    once: bool = False

    @classmethod
    def load(cls, env: Mapping[str, str] | None = None) -> TransformConfig:
        e = os.environ if env is None else env
        return cls(int_setting(e, "BATCH_SIZE", 200, 1), int_setting(e, "INTERVAL_SECONDS", 60, 5), bool_setting(e, "RUN_ONCE", False))


def backoff_seconds(attempt: int) -> int:
    """Pause before a retry: doubling, five seconds at most."""
    return min(2**attempt, 5)
