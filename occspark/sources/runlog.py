"""A run's log: lines with the time, on standard output and in a file of its own."""

from __future__ import annotations

import logging
import sys
from datetime import datetime
from pathlib import Path


def run_log(folder: str, name: str, now: datetime | None = None) -> logging.Logger:
    """A logger that writes to ``folder/name_YYYYMMDD_HHMM.log`` and to standard output, on the driver."""
    path = Path(folder) / f"{name}_{now or datetime.now():%Y%m%d_%H%M}.log"
    path.parent.mkdir(parents=True, exist_ok=True)
    log = logging.getLogger(f"occspark.{name}.{path.stem}")
    log.setLevel(logging.INFO)
    log.propagate = False
    if not log.handlers:
        for handler in (logging.StreamHandler(sys.stdout), logging.FileHandler(path, encoding="utf-8")):
            handler.setFormatter(logging.Formatter("%(asctime)s - %(message)s"))
            log.addHandler(handler)
    return log
