"""python -m hirelens TASK, or JOB_TASK in the environment: 0 done, 1 failed, 2 no such task."""

from __future__ import annotations

import importlib
import logging
import os
import sys
from collections.abc import Callable, Mapping

TASKS = {"enrich_skills": "hirelens.plans.tasks:enrich_skills", "build_models": "hirelens.plans.tasks:build_models"}


def task_name(argv: list[str], env: Mapping[str, str]) -> str | None:
    """The first argument before the environment."""
    given = argv[1].strip() if len(argv) > 1 else ""
    return given or env.get("JOB_TASK", "").strip() or None


def load(place: str) -> Callable[[], int | None]:
    module, _, name = place.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str], env: Mapping[str, str] = os.environ, tasks: Mapping[str, str] = TASKS) -> int:
    name = task_name(argv, env)
    if name not in tasks:
        sys.stderr.write("Tasks: " + ", ".join(sorted(tasks)) + "\n")
        return 2
    try:
        return int(load(tasks[name])() or 0)
    except Exception:
        logging.exception("task %s failed", name)
        return 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
