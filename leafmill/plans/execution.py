"""Running a run: leases, steps in order, release whatever happens, and the log of it."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from leafmill.plans.leases import DONE, Leases


@dataclass
class Log:
    """One line a start and an end, with the seconds between."""

    write: Callable[[str], None] = print
    seconds: dict[str, float] = field(default_factory=dict)

    def run(self, name: str, step: Callable[[], None]) -> bool:
        """Whether the step came through. An interruption counts as a failure and is passed on."""
        began = time.monotonic()
        self.write(f"START {name}")
        ok = False
        try:
            step()
            ok = True
        except Exception as e:  # noqa: BLE001  a failed step is an answer
            self.write(f"{name}: {type(e).__name__}: {str(e)[:500]}")
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.monotonic() - began
            self.write(f"END {name} {'ok' if ok else 'failed'} after {self.seconds[name]:.1f} s")
        return ok


def execute(
    batches: list[int], leases: Leases, run: int, batch_steps: dict[str, Callable[[int], None]], run_steps: dict[str, Callable[[int], None]] | None = None,
    node: str = "", only: int | None = None, batch_only: bool = False, ignore_locks: bool = False, log: Log | None = None,
) -> bool:
    """Work through a run's free batches in order; whether all came through.

    Of each batch a lease is claimed, which only one process gets, its steps run in order up to the first that fails, and
    the lease is released in any case, as crashed after a failure. The first crashed batch ends the run, as does a lease
    that was lost meanwhile. The steps of the run as a whole are skipped then, with batch_only, and while a batch of it is
    still open elsewhere. Without steps there is no work to mark as done, which is an error.
    """
    if not batch_steps:
        raise ValueError("a run without steps would mark its batches as done: name the steps")
    log = log or Log()
    for batch in sorted(batches):
        if only is not None and batch != only:
            continue
        held = leases.claim(batch, node, ignore_locks)
        if held is None:
            log.write(f"batch {batch} is held or done")
            continue
        ok = False
        try:
            ok = all(log.run(f"batch {batch} {name}", lambda step=step: step(batch)) for name, step in batch_steps.items())
        finally:
            kept = leases.release(held, crashed=not ok)
        if not kept:
            log.write(f"batch {batch}: the lease was over and another has it")
        if not ok or not kept:
            return False
    if batch_only or not run_steps:
        return True
    if any((e := leases.last(b)) is None or e.action != DONE for b in batches):
        log.write("steps of the run wait: a batch is open or has crashed")
        return True
    return all(log.run(f"run {run} {name}", lambda step=step: step(run)) for name, step in run_steps.items())


def run_all(steps: dict[str, Callable[[], None]], log: Log | None = None) -> bool:
    """Steps one after the other up to the first that fails."""
    log = log or Log()
    return all(log.run(name, step) for name, step in steps.items())
