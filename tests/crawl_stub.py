"""A transport and a feed for tests; what was asked is kept in the folder CRAWL_STUB."""

import os
import time

FOLDER = os.environ.get("CRAWL_STUB", "/tmp/crawl-stub")


def _times(url: str) -> int:
    """How often url has been asked, this time included, over all processes."""
    path = f"{FOLDER}/{url.replace('/', '_')}"
    with open(path, "a") as f:
        f.write("x")
    return os.path.getsize(path)


def client():
    def get(url, timeout):
        n = _times(url)
        kind = url.rsplit("/", 1)[1]
        if kind.startswith("busy") and n <= 2:
            return 429, {"Retry-After": "7"}, ""
        if kind.startswith("down") or kind.startswith("flaky") and n == 1:
            return 503, {}, ""
        if kind.startswith("slow"):
            raise TimeoutError
        if kind.startswith("gone"):
            return 404, {}, ""
        if kind.startswith("odd"):
            raise KeyError("odd")
        if kind.startswith("cut") and n == 1:
            raise ConnectionResetError("cut off")
        return 200, {}, f"<title>{kind}</title>"

    return get


def sleep(seconds):
    with open(f"{FOLDER}/slept", "a") as f:
        f.write(f"{seconds}\n")
    time.sleep(0)


class Feed:
    def size(self):
        with open(f"{FOLDER}/size") as f:
            return int(f.read())

    def urls(self, start, stop):
        return [f"http://h{i % 3}.example/p{i}" for i in range(start, stop)]


def feed():
    return Feed()
