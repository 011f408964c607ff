"""Sending line-protocol bodies: the transport, and the retry rule around it."""

from __future__ import annotations

import gzip
import http.client
import importlib
import logging
import time
import urllib.parse
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Protocol

log = logging.getLogger(__name__)

# Fixed values of the retry rule: attempts in total, and the waits between them.
MAX_ATTEMPTS = 5
RETRY_DELAY_S = 5.0
MAX_DELAY_S = 30.0
BACKOFF_BASE = 2.0

# Answers worth another attempt; other 4xx answers mean the body is not acceptable.
_RETRYABLE_STATUS = {408, 425, 429}


class Rejected(Exception):
    """The target refused the body for good; sending it again cannot help."""


class Unavailable(Exception):
    """The target can't take the body now."""


class Transport(Protocol):
    def ping(self) -> None: ...

    def send(self, body: bytes) -> None: ...

    def close(self) -> None: ...


@dataclass(frozen=True)
class RetryPolicy:
    attempts: int = MAX_ATTEMPTS
    delay_s: float = RETRY_DELAY_S
    max_delay_s: float = MAX_DELAY_S
    base: float = BACKOFF_BASE

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> RetryPolicy:
        return cls(
            int(options.get("max_retries", MAX_ATTEMPTS)),
            float(options.get("retry_delay_s", RETRY_DELAY_S)),
            float(options.get("max_delay_s", MAX_DELAY_S)),
            float(options.get("backoff_base", BACKOFF_BASE)),
        )

    def wait_before(self, attempt: int) -> float:
        """Seconds before the given attempt, which is 2 or later."""
        return min(self.delay_s * self.base ** (attempt - 2), self.max_delay_s)

    def run(self, action: Callable[[], None], recover: Callable[[], None] = lambda: None) -> None:
        """Do the action, at most `attempts` times; the last failure is raised."""
        for attempt in range(1, self.attempts + 1):
            try:
                return action()
            except Rejected:
                raise
            except Exception as failure:
                log.warning("attempt %d of %d failed: %s", attempt, self.attempts, failure)
                if attempt == self.attempts:
                    raise
                time.sleep(self.wait_before(attempt + 1))
                recover()


class Connection:
    """An open transport that is checked, and opened anew when the check fails."""

    def __init__(self, open_transport: Callable[[], Transport], policy: RetryPolicy):
        self._open, self._policy = open_transport, policy
        self._transport: Transport | None = None

    def connect(self) -> None:
        self._policy.run(self._connect_once)

    def send(self, body: bytes) -> None:
        self._policy.run(lambda: self._transport.send(body), self._check)

    def close(self) -> None:
        if self._transport is not None:
            self._transport.close()
            self._transport = None

    def _connect_once(self) -> None:
        self.close()
        self._transport = self._open()
        self._transport.ping()

    def _check(self) -> None:
        try:
            self._transport.ping()
        except Exception as failure:
            log.info("connection check failed, connecting again: %s", failure)
            self.connect()


class HttpTransport:
    """Synchronous writes to a `/api/v2/write` endpoint with millisecond precision, over one kept connection."""

    def __init__(self, options: Mapping[str, str]):
        url = urllib.parse.urlsplit(options["url"])
        if url.scheme not in ("http", "https") or not url.hostname:
            raise ValueError("the address of the target must begin with http:// or https://")
        query = {"org": options["org"], "bucket": options["bucket"], "precision": "ms"}
        self._base = url.path.rstrip("/")
        self._target = f"{self._base}/api/v2/write?{urllib.parse.urlencode(query)}"
        self._headers = {"Authorization": f"Token {options['token']}", "Content-Type": "text/plain; charset=utf-8"}
        self._zip = options.get("gzip", "false").lower() == "true"
        kind = http.client.HTTPSConnection if url.scheme == "https" else http.client.HTTPConnection
        self._connection = kind(url.hostname, url.port, timeout=float(options.get("timeout_s", "30")))

    def ping(self) -> None:
        self._call("GET", f"{self._base}/ping", None, {})

    def send(self, body: bytes) -> None:
        headers = dict(self._headers)
        if self._zip:
            body, headers["Content-Encoding"] = gzip.compress(body), "gzip"
        self._call("POST", self._target, body, headers)

    def close(self) -> None:
        self._connection.close()

    def _call(self, method: str, path: str, body: bytes | None, headers: dict[str, str]) -> None:
        try:
            self._connection.request(method, path, body, headers)
            answer = self._connection.getresponse()
            said = answer.read()  # to the end, so that the connection can be used again
        except (http.client.HTTPException, OSError):
            self._connection.close()  # the next call opens it again
            raise
        if answer.status < 400:
            return
        detail = f"status {answer.status}: {said[:500].decode('utf-8', 'replace')}"
        refused = answer.status < 500 and answer.status not in _RETRYABLE_STATUS
        raise Rejected(detail) if refused else Unavailable(detail)


class BodyFiles:
    """Keeps every body as a file below `url/org/bucket`, for targets that are fed later or elsewhere."""

    def __init__(self, options: Mapping[str, str]):
        from chronoferry.sources.pieces import open_folder

        self._system, root = open_folder(options["url"])
        self._folder = "/".join([root.rstrip("/"), *(urllib.parse.quote(options[k], safe="") for k in ("org", "bucket"))])

    def ping(self) -> None:
        self._system.create_dir(self._folder, recursive=True)

    def send(self, body: bytes) -> None:
        # A name that no reader takes until the file is whole.
        name = uuid.uuid4().hex
        with self._system.open_output_stream(f"{self._folder}/_{name}") as out:
            out.write(body + b"\n")
        self._system.move(f"{self._folder}/_{name}", f"{self._folder}/{name}.lines")

    def close(self) -> None:
        pass


def transport_factory(options: Mapping[str, str]) -> Callable[[], Transport]:
    """HTTP, files (`files`), or what the option `transport` names as `module:factory`."""
    name = options.get("transport", "http")
    if name in _KNOWN:
        return lambda: _KNOWN[name](options)
    module, _, attribute = name.partition(":")
    factory = getattr(importlib.import_module(module), attribute)
    return lambda: factory(options)


_KNOWN = {"http": HttpTransport, "files": BodyFiles}
