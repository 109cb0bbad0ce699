"""An OCR service behind an interface: ask for upload addresses, put files, poll, download.

A transport is a callable (method, url, headers, body) -> (status, headers, bytes) that raises OSError where no answer comes. Tests
give one of their own; `urllib_transport` is the real one. Paths of the service are parameters, since services differ.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from pathlib import Path

Transport = Callable[[str, str, dict, bytes | None], tuple[int, dict, bytes]]
LONGEST_PAUSE = 60.0


class ServiceError(RuntimeError):
    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


class AuthError(ServiceError):
    """The token was refused; trying again does not help."""


def urllib_transport(method: str, url: str, headers: dict, body: bytes | None, timeout: float = 60) -> tuple[int, dict, bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data=body, headers=headers, method=method), timeout=timeout) as r:
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read()


class Service:
    def __init__(self, token: str, base_url: str, transport: Transport = urllib_transport, upload_path: str = "/file-urls/batch", result_path: str = "/extract-results/batch/", retries: int = 4, backoff: float = 1.0, sleep: Callable[[float], None] = time.sleep):
        if not token:
            raise AuthError("the token is empty")
        self._token, self._base, self._transport = token, base_url.rstrip("/"), transport
        self._upload, self._result = upload_path, result_path
        self._retries, self._backoff, self._sleep = max(0, retries), max(0.0, backoff), sleep

    def request_upload(self, files: list[dict]) -> dict:
        """batch_id and file_urls, one a file (name, data_id, size)."""
        if not files:
            raise ServiceError("no files to upload")
        data = self._json("POST", self._upload, {"files": files})
        if len(data.get("file_urls", [])) != len(files):
            raise ServiceError(f"{len(data.get('file_urls', []))} upload addresses for {len(files)} files")
        return data

    def upload(self, url: str, path: str) -> None:
        """Put a file to an address that needs no token, and must not be shown one."""
        body = Path(path).read_bytes()
        status, _, _ = self._transport("PUT", url, {"Content-Type": "application/pdf", "Content-Length": str(len(body))}, body)
        if status not in (200, 201, 204):
            raise ServiceError(f"upload failed: HTTP {status}", status)

    def batch(self, batch_id: str) -> dict:
        return self._json("GET", self._result + batch_id)

    def wait(self, batch_id: str, done: Callable[[dict], bool], every: float = 5.0, limit: float = 3600.0) -> dict:
        """Poll until done(state); the pauses add up to `limit` at most."""
        waited = 0.0
        while not done(state := self.batch(batch_id)):
            if waited >= limit:
                raise ServiceError(f"batch {batch_id} is not done after {limit:g} s")
            self._sleep(every)
            waited += every
        return state

    def download(self, url: str, target: str) -> Path:
        status, _, body = self._transport("GET", url, {}, None)
        if status != 200:
            raise ServiceError(f"download failed: HTTP {status}", status)
        path = Path(target)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
        return path

    def _json(self, method: str, path: str, body: dict | None = None) -> dict:
        """An answer's data. 401 and 403 are final, as are other refusals; 429, 5xx and lost answers are tried again."""
        last = ServiceError("no attempt was made")
        for attempt in range(self._retries + 1):
            pause = self._backoff * 2**attempt
            try:
                status, headers, raw = self._transport(method, self._base + path, {"Authorization": f"Bearer {self._token}", "Content-Type": "application/json"}, None if body is None else json.dumps(body).encode())
            except OSError as e:
                last = ServiceError(str(e))
            else:
                if status in (401, 403):
                    raise AuthError(f"the token was refused: HTTP {status}", status)
                if status < 400:
                    try:
                        return json.loads(raw)["data"]
                    except (ValueError, KeyError, TypeError) as e:
                        raise ServiceError(f"not the expected JSON: {e}", status) from e
                last = ServiceError(f"HTTP {status}", status)
                if status != 429 and status < 500:
                    raise last
                told = {k.lower(): v for k, v in headers.items()}.get("retry-after")
                if told is not None and told.replace(".", "", 1).isdigit():
                    pause = float(told)
            if attempt < self._retries:
                self._sleep(min(pause, LONGEST_PAUSE))
        raise ServiceError(f"failed after {self._retries + 1} attempts: {last}", last.status)
