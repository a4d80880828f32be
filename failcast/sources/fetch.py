"""Fetch trace archives: resumed downloads with retries, a size check, safe extraction."""

from __future__ import annotations

import tarfile
import time
from dataclasses import dataclass
from pathlib import Path
from urllib.error import HTTPError, URLError
from urllib.request import Request, urlopen


class ArchiveError(RuntimeError):
    """An archive could not be fetched whole."""


@dataclass(frozen=True)
class Archive:
    name: str
    low_mib: float
    high_mib: float

    def in_band(self, path: Path) -> bool:
        return path.exists() and self.low_mib <= path.stat().st_size / 2**20 <= self.high_mib


# The trace's tables with the sizes, in MiB, that a whole archive has.
ARCHIVES = (
    Archive("machine_meta", 0.07, 0.12),
    Archive("container_meta", 2.0, 3.0),
    Archive("machine_usage", 1500.0, 1850.0),
    Archive("container_usage", 27_000.0, 28_500.0),
    Archive("batch_task", 110.0, 140.0),
)


def download(url: str, path: Path, *, tries: int = 5, pause: float = 1.0, block: int = 1 << 20) -> Path:
    """Download to ``path``, going on where an earlier try stopped."""
    part = path.with_suffix(path.suffix + ".part")
    path.parent.mkdir(parents=True, exist_ok=True)
    for attempt in range(tries):
        have = part.stat().st_size if part.exists() else 0
        try:
            with urlopen(Request(url, headers={"Range": f"bytes={have}-"} if have else {}), timeout=60) as answer:
                with part.open("ab" if have and answer.status == 206 else "wb") as out:
                    while data := answer.read(block):
                        out.write(data)
            return part.rename(path)
        except (HTTPError, URLError, OSError) as error:
            if isinstance(error, HTTPError) and error.code == 416 and have:
                return part.rename(path)
            if attempt + 1 == tries:
                raise ArchiveError(f"{url}: {error}") from error
            time.sleep(pause * 2**attempt)
    raise ArchiveError(url)


def fetch(base_url: str, target: str | Path, archives=ARCHIVES, **options) -> list[Path]:
    """Each archive under ``target``, extracted; what is whole already is left alone."""
    target, out = Path(target), []
    for a in archives:
        packed, csv = target / f"{a.name}.tar.gz", target / f"{a.name}.csv"
        if not a.in_band(packed):
            packed.unlink(missing_ok=True)
            download(f"{base_url.rstrip('/')}/{a.name}.tar.gz", packed, **options)
            if not a.in_band(packed):
                raise ArchiveError(f"{a.name}: {packed.stat().st_size / 2**20:.2f} MiB is not the size of a whole archive")
        if not csv.exists():
            with tarfile.open(packed) as tar:
                tar.extractall(target, filter="data")
        out.append(csv)
    return out
