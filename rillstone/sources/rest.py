"""Works from a REST service with pacing, retries and an injected fetch function."""

from __future__ import annotations

import os
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Pacing:
    """Seconds between requests, random extra seconds, attempts, growth of waits, seconds until a request is given up."""

    rate: float = 3.0
    jitter: float = 0.5
    attempts: int = 4
    factor: float = 2.0
    timeout: float = 10.0

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Pacing:
        """Pacing by the variables that are set; the names are fixed values."""
        names = {"rate": "OPENALEX_RATE_LIMIT_SECONDS", "jitter": "OPENALEX_JITTER_SECONDS", "attempts": "OPENALEX_MAX_RETRIES", "factor": "OPENALEX_BACKOFF_FACTOR"}
        given = {f: float(env[n]) for f, n in names.items() if env.get(n)}
        return replace(cls(), **given | ({"attempts": int(given["attempts"])} if "attempts" in given else {}))


def http_get(url: str, timeout: float) -> str:
    """The body of an answer."""
    with urllib.request.urlopen(url, timeout=timeout) as answer:  # noqa: S310
        return answer.read().decode("utf-8")


def fetch_one(url: str, get: Callable[[str, float], str] = http_get, pacing: Pacing = Pacing(), sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str]:
    """(payload, error). Too many requests wait as told, or ever longer; network errors wait; others fail at once."""
    error = ""
    for attempt in range(pacing.attempts):
        wait = pacing.rate * pacing.factor**attempt
        try:
            payload = get(url, pacing.timeout)
            sleep(pacing.rate + random.uniform(0, pacing.jitter))
            return payload, ""
        except urllib.error.HTTPError as e:
            error = f"HTTP Error {e.code}: {e.reason}"
            if e.code != 429:
                return None, error
            told = e.headers.get("Retry-After") if e.headers else None
            wait = float(told) if told and told.isdigit() else wait
        except (urllib.error.URLError, TimeoutError, OSError) as e:
            error = f"{e}"
        if attempt + 1 < pacing.attempts:
            sleep(wait + random.uniform(0, pacing.jitter))
    return None, f"{error} after retries"


def fetch(requests: DataFrame, url_col: str = "url", key_col: str = "key", get: Callable[[str, float], str] = http_get, pacing: Pacing = Pacing(), workers: int = 1) -> DataFrame:
    """``key, payload, error`` per request. ``workers`` tasks share the service's rate; keys should be distinct."""
    share = Pacing(pacing.rate * workers, pacing.jitter, pacing.attempts, pacing.factor, pacing.timeout)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = [fetch_one(u, get, share) if u else (None, "no query") for u in frame[url_col]]
            yield pd.DataFrame({"key": frame[key_col], "payload": [a for a, _ in answers], "error": [e for _, e in answers]})

    return requests.select(key_col, url_col).repartition(workers).mapInPandas(run, "key string, payload string, error string")
