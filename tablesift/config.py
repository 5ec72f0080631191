"""Settings of a run, from the environment; arguments override them."""

from __future__ import annotations

import os
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class RunConfig:
    dpi: int = 300
    threshold: float = 0.95
    timeout_seconds: float = 90.0
    attempts: int = 4
    base_delay_seconds: float = 1.0
    max_tokens: int = 2048
    parallel_requests: int = 2
    api_key: str = ""

    @property
    def can_request(self) -> bool:
        """Whether the key looks like one."""
        return len(self.api_key) > 5

    def override(self, **given) -> "RunConfig":
        return replace(self, **{k: v for k, v in given.items() if v is not None})


def from_environment(prefix: str = "TABLESIFT_") -> RunConfig:
    """Fields that the environment names, in their own types."""
    base = RunConfig()
    given = {name: type(getattr(base, name))(os.environ[prefix + name.upper()]) for name in base.__dataclass_fields__ if prefix + name.upper() in os.environ}
    return base.override(**given)
