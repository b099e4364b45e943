"""Leases: a file that a running job keeps fresh, so that others leave its data alone."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from ..session import Files

#: Seconds between renewals, and how old a lease is that its holder has lost.
RENEWAL = 60
LAPSE = timedelta(minutes=30)


@contextmanager
def held(files: Files, path: str, renewal: float = RENEWAL) -> Iterator[None]:
    """Hold the lease at ``path``: its modification time stays young until the block ends.

    A holder that dies leaves the file, which ages; who cleans up goes by its age.
    """
    done = threading.Event()

    def renew() -> None:
        while not done.wait(renewal):
            files.write_text(path, "held")

    files.write_text(path, "held")
    keeper = threading.Thread(target=renew, daemon=True)
    keeper.start()
    try:
        yield
    finally:
        done.set()
        keeper.join()
        files.delete(path)
