"""Transports for tests, loaded by name in the tasks that send."""

import os
import uuid


class Folder:
    """Keeps every accepted body as a file; fails as its options say.

    `fail_sends`, `fail_pings` and `fail_opens` give how many calls fail first,
    counted per connection (sends, pings) or per folder (opens).
    """

    def __init__(self, options):
        self.path = options["url"]
        os.makedirs(self.path, exist_ok=True)
        self.left = {k: int(options.get(k, 0)) for k in ("fail_sends", "fail_pings")}
        if self._count("opened") <= int(options.get("fail_opens", 0)):
            raise ConnectionError("cannot open")

    def ping(self):
        self._maybe_fail("fail_pings")

    def send(self, body):
        self._maybe_fail("fail_sends")
        with open(os.path.join(self.path, f"{uuid.uuid4().hex}.body"), "wb") as out:
            out.write(body)

    def close(self):
        self._count("closed")

    def _maybe_fail(self, what):
        if self.left[what] > 0:
            self.left[what] -= 1
            raise ConnectionError(what)

    def _count(self, event):
        path = os.path.join(self.path, event)
        with open(path, "a") as out:
            out.write("x")
        return os.path.getsize(path)


def bodies(path):
    for name in os.listdir(path):
        if name.endswith(".body"):
            with open(os.path.join(path, name), "rb") as body:
                yield body.read().decode().split("\n")
