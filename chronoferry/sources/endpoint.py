"""Normalising the address of a JDBC source."""

from __future__ import annotations

import logging

log = logging.getLogger(__name__)

# The two address forms and their default ports.
NATIVE_SCHEME = "jdbc:TAOS://"
REST_SCHEME = "jdbc:TAOS-RS://"
REST_PORT = ":6041/"
NATIVE_PORT = ":6030/"


def native_url(url: str) -> str:
    """The native form of a REST address; native and other addresses are returned as they are."""
    scheme, rest = url[: len(REST_SCHEME)], url[len(REST_SCHEME) :]
    if scheme == REST_SCHEME:
        return NATIVE_SCHEME + rest.replace(REST_PORT, NATIVE_PORT)
    if not url.startswith(NATIVE_SCHEME):
        log.warning("address is passed to its driver unchanged: %s", url.split("?")[0])
    return url
