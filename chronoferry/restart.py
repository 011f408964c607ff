"""Running again what goes on where it stopped."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from typing import TypeVar

from chronoferry.config import RESTART_ATTEMPTS, RESTART_DELAY_S

log = logging.getLogger(__name__)

Result = TypeVar("Result")


def restarted(
    action: Callable[[], Result], attempts: int = RESTART_ATTEMPTS, delay_s: float = RESTART_DELAY_S
) -> Result:
    """The result of an action that keeps its own progress, started again up to `attempts` times if it fails."""
    for restart in range(attempts + 1):
        try:
            return action()
        except Exception as failure:
            if restart == attempts:
                raise
            log.warning("failed, restart %d of %d: %s", restart + 1, attempts, failure)
            time.sleep(delay_s)
    raise AssertionError("unreachable")
