"""Job bookkeeping: structured log lines, summaries, and checks of configuration."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

GOOD_QUALITY, FAIR_QUALITY = 0.95, 0.80


class JobFailed(RuntimeError):
    """A job that ended in failure."""


@dataclass
class JobLog:
    """Log lines of a run as JSON, under one correlation id."""

    job: str
    correlation_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    began: float = field(default_factory=time.time)
    logger: logging.Logger = field(default_factory=lambda: logging.getLogger("barline"))

    def line(self, level: int, message: str, **details) -> dict:
        entry = {"job": self.job, "correlation_id": self.correlation_id, "level": logging.getLevelName(level), "message": message, **details}
        self.logger.log(level, json.dumps(entry, default=str))
        return entry

    def info(self, message: str, **details) -> dict:
        return self.line(logging.INFO, message, **details)

    def error(self, message: str, error: BaseException | None = None, remedy: str | None = None) -> dict:
        return self.line(logging.ERROR, message, error=None if error is None else f"{type(error).__name__}: {error}", remedy=remedy)

    def summary(self, rows: int, **details) -> dict:
        seconds = max(time.time() - self.began, 1e-9)
        return self.info("summary", rows=rows, seconds=round(seconds, 3), rows_per_second=round(rows / seconds, 1), **details)

    def quality(self, valid: int, total: int) -> dict:
        share = valid / total if total else 1.0
        level = "good" if share >= GOOD_QUALITY else "fair" if share >= FAIR_QUALITY else "poor"
        return self.line(logging.INFO if level == "good" else logging.WARNING, "quality", valid=valid, total=total, share=round(share, 4), quality=level)

    def exit(self, status: str, message: str = "") -> dict:
        entry = self.info(message or status, status=status)
        if status != "success":
            raise JobFailed(message or status)
        return entry


def missing_settings(settings: Mapping[str, object], needed: Sequence[str]) -> list[str]:
    return [k for k in needed if settings.get(k) in (None, "")]


def require_settings(settings: Mapping[str, object], job: str, needed: Mapping[str, Sequence[str]]) -> None:
    """Raises with the names of all settings that a job needs and does not have."""
    if job not in needed:
        raise ValueError(f"no such job: {job}")
    absent = missing_settings(settings, needed[job])
    if absent:
        raise ValueError(f"{job} needs {', '.join(absent)}")
