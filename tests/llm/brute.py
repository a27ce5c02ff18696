"""Plain versions of the operators' fixed parts, one text at a time."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rule_counts(text):
    found = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    at = defaultdict(list)
    for i in range(len(found) - 2):
        at[tuple(found[i : i + 3])].append(i)
    repeated = {i + k for starts in at.values() if len(starts) > 1 for i in starts for k in range(3)}
    n = len(found)
    return (
        n,
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(repeated),
        n < 50 or 100 * len(repeated) > 50 * n,
    )


def shingles(text, size):
    found = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def fold(doc_id, parts):
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts
