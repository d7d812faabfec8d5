"""Adapters outside Spark: retries, downloads and locks."""

from __future__ import annotations

import hashlib
import os
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import TypeVar

T = TypeVar("T")


def retried(call: Callable[[], T], attempts: int = 5, first: float = 1.0, longest: float | None = None, on: tuple[type[BaseException], ...] = (OSError,), sleep: Callable[[float], None] = time.sleep) -> T:
    """The call's result, tried again after waits that double; the last error is raised."""
    for k in range(attempts):
        try:
            return call()
        except on:
            if k == attempts - 1:
                raise
            sleep(min(first * 2**k, longest or float("inf")))
    raise ValueError("attempts must be positive")


def cache_path(folder: str, url: str) -> Path:
    """Where a URL's download is kept: md5 of the URL and its suffix."""
    name = url.split("?")[0].split("#")[0]
    return Path(folder) / (hashlib.md5(url.encode()).hexdigest() + os.path.splitext(name)[1])


def looks_like_html(head: bytes) -> bool:
    """A page where a file was due, such as a login form."""
    start = head.lstrip()[:64].lower()
    return start.startswith((b"<!doctype html", b"<html"))


def download(url: str, folder: str, open_url: Callable[[str, str | None], tuple[bytes | None, str | None]], attempts: int = 5, wait: float = 1.0) -> Path:
    """A URL's file in the cache. open_url(url, etag) gives (content, etag), or (None, etag) where nothing changed; a page is an error and is not kept."""
    path = cache_path(folder, url)
    mark = path.with_name(path.name + ".etag")
    held = mark.read_text() if path.exists() and mark.exists() else None
    if path.exists() and held is None:
        return path
    content, etag = retried(lambda: open_url(url, held), attempts, wait)
    if content is not None:
        if looks_like_html(content[:512]):
            raise ValueError(f"{url} gave a page, not a file")
        path.parent.mkdir(parents=True, exist_ok=True)
        part = path.with_name(f"{path.name}.{os.getpid()}.part")
        part.write_bytes(content)
        part.replace(path)
    if etag:
        mark.write_text(etag)
    return path


@contextmanager
def year_lock(folder: str, year: int, stale_after: float = 6 * 3600) -> Iterator[None]:
    """An exclusive lock for a year's update; one whose process is gone or that is old is taken over."""
    path = Path(folder) / f"{year}.lock"
    path.parent.mkdir(parents=True, exist_ok=True)
    for _ in range(2):
        try:
            held = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            break
        except FileExistsError:
            if not _stale(path, stale_after):
                raise RuntimeError(f"year {year} is being updated: {path}") from None
            path.unlink(missing_ok=True)
    else:
        raise RuntimeError(f"year {year} is being updated: {path}")
    os.write(held, str(os.getpid()).encode())
    os.close(held)
    try:
        yield
    finally:
        path.unlink(missing_ok=True)


def _stale(path: Path, after: float) -> bool:
    try:
        pid, age = int(path.read_text() or 0), time.time() - path.stat().st_mtime
    except (OSError, ValueError):
        return True
    if age > after or not pid:
        return True
    try:
        os.kill(pid, 0)
    except ProcessLookupError:
        return True
    except PermissionError:
        return False
    return False
