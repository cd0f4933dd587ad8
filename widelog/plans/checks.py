"""Checks before and during a job, each told in one report."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from .ring import Ring


@dataclass
class Report:
    """What each check said; None where it passed."""

    results: dict[str, str | None] = field(default_factory=dict)

    @property
    def failed(self) -> dict[str, str]:
        return {k: v for k, v in self.results.items() if v is not None}

    def __str__(self) -> str:
        return "\n".join(f"{'FAILED' if v is not None else 'PASSED'} {k}{': ' + v if v is not None else ''}" for k, v in self.results.items())

    def raise_if_failed(self) -> None:
        if self.failed:
            raise RuntimeError(f"{len(self.failed)} of {len(self.results)} checks failed\n{self}")


def run_checks(checks: dict[str, Callable[[], object]]) -> Report:
    """Runs all checks, whatever the others say; a check fails by raising."""
    report = Report()
    for name, check in checks.items():
        try:
            check()
            report.results[name] = None
        except Exception as e:  # noqa: BLE001 - the report tells it
            report.results[name] = str(e) or type(e).__name__
    return report


def check_time_skew(remote_seconds: float, allowed_seconds: float, now: float | None = None) -> None:
    """Fails if another machine's clock is too far from ours to stamp writes."""
    apart = abs((time.time() if now is None else now) - remote_seconds)
    if apart > allowed_seconds:
        raise RuntimeError(f"clocks are {apart:.1f} s apart; {allowed_seconds} s are allowed")


class TopologyMonitor:
    """Asks for the ring again and again; a change, or too many failures to ask in a row, ends the job by ``cancel``."""

    def __init__(self, ask: Callable[[], Ring], cancel: Callable[[str], None], most_failures: int = 10):
        self.ask, self.cancel, self.most_failures = ask, cancel, most_failures
        self.first, self.failures, self.over = ask().ranges, 0, False

    def check(self) -> bool:
        """One look; whether the job may go on."""
        if self.over:
            return False
        try:
            now = self.ask().ranges
            self.failures = 0
        except Exception:  # noqa: BLE001 - counted
            self.failures += 1
            if self.failures > self.most_failures:
                self._end(f"the ring could not be read {self.failures} times")
            return not self.over
        if now != self.first:
            self._end("the ring changed")
        return not self.over

    def _end(self, why: str) -> None:
        self.over = True
        self.cancel(why)
