"""Downloads behind an interface: a local mirror, HTTP with retry, and both; none of them raises."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "url string, status string, content binary, error string, attempts int"


@dataclass
class Result:
    url: str
    status: str
    content: bytes | None = None
    error: str | None = None
    attempts: int = 1


def http(url: str, timeout: float = 30, retries: int = 3, backoff: float = 0.5, max_bytes: int = 20_000_000) -> Result:
    """404 and 410 are final; other failures are tried again after a linearly growing pause."""
    error = ""
    for attempt in range(1, retries + 1):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as r:
                data = r.read(max_bytes + 1)
            return Result(url, "failed", error="too_large", attempts=attempt) if len(data) > max_bytes else Result(url, "ok", data, attempts=attempt)
        except urllib.error.HTTPError as e:
            error = f"http {e.code}"
            if e.code in (404, 410):
                return Result(url, "failed", error=error, attempts=attempt)
        except (OSError, ValueError) as e:
            error = str(e)
        time.sleep(backoff * attempt)
    return Result(url, "failed", error=error, attempts=retries)


def mirror(folder: str) -> Callable[[str], Result]:
    """Files of a folder by the last part of the URL."""

    def get(url: str) -> Result:
        p = Path(folder) / url.split("?")[0].split("#")[0].rstrip("/").rpartition("/")[2]
        return Result(url, "ok", p.read_bytes()) if p.is_file() else Result(url, "failed", error="not in mirror")

    return get


def first_of(*sources: Callable[[str], Result]) -> Callable[[str], Result]:
    def get(url: str) -> Result:
        out = Result(url, "failed", error="no source")
        for s in sources:
            out = s(url)
            if out.status == "ok":
                break
        return out

    return get


def download(urls: DataFrame, get: Callable[[str], Result], parallel: int = 8, column: str = "url") -> DataFrame:
    """One result for each distinct URL; `parallel` partitions bound the open requests."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame([(r.url, r.status, r.content, r.error, r.attempts) for r in map(get, part["url"])], columns=["url", "status", "content", "error", "attempts"])

    return urls.select(F.col(column).alias("url")).distinct().repartition(parallel).mapInPandas(work, RESULT)
