"""Responses as files, as a fetcher leaves them."""

import os


def land_files(responses, root):
    out = []
    for r in responses.select("source", "archive_uri", "content").toLocalIterator():
        rel = r.archive_uri.split("://", 1)[-1].split("/", 1)[-1]
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as fh:
            fh.write(bytes(r.content))
        out.append(p)
    return out
