"""Commit records and JSON files for tests."""

import datetime as dt
import json
import os


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def write_json(path, payload, raw: bool = False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(payload if raw else json.dumps(payload, indent=2))


def commit(sha="a", committer=None, name="n", email="e@x", date="2024-01-01T18:00:00Z", drop=()):
    person = {"name": name, "email": email, "date": date}
    for k in drop:
        person.pop(k)
    rec = {"sha": sha, "committer": committer, "commit": {"committer": person, "message": "m"}}
    if sha is None:
        rec.pop("sha")
    return rec
