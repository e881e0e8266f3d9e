"""Plain Python versions of the operators that SQL does not express."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def near_rows(rows, size=4, percent=85):
    """``id, n_shingles, component`` of every row; the texts of one id are one document, a null id none,
    and a text without words links with nothing."""
    texts = [(k, text) for k, (_, text) in enumerate(rows)]
    found = near_duplicates(texts, size, percent)
    same = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None and found[k][0]:
            same.setdefault(doc, []).append(found[k][1])
            same.setdefault(("of", found[k][1]), []).append(doc)
    out = []
    for k, (doc, _) in enumerate(rows):
        reach, new = set(), {doc}
        while new and doc is not None and found[k][0]:
            reach |= new
            new = {d for x in new for c in same[x] for d in same["of", c]} - reach
        out.append((doc, found[k][0], min(reach) if reach else doc))
    return out


def near_duplicates(rows, size=4, percent=85):
    sets = {}
    for doc, text in rows:
        words = [w.lower() for w in WORD.findall((text or "").encode())]
        sets[doc] = ({tuple(words[k:k + size]) for k in range(len(words) - size + 1)}
                     or ({tuple(words)} if words else set()))
    holders = defaultdict(list)
    for doc, found in sets.items():
        for x in found:
            holders[x].append(doc)
    root = {doc: doc for doc in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for doc, found in sets.items():
        common = Counter(other for x in found for other in holders[x] if other > doc)
        for other, n in common.items():
            if 100 * n >= percent * (len(found) + len(sets[other]) - n):
                a, b = top(doc), top(other)
                root[max(a, b)] = min(a, b)
    return {doc: (len(found), top(doc)) for doc, found in sets.items()}


def remove_repeats(rows, length=200):
    texts = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(t[k:k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for doc, text in texts:
        gone = [False] * len(text)
        for k in range(len(text) - length + 1):
            if seen[text[k:k + length]] > 1:
                gone[k:k + length] = [True] * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(text, gone) if not g)
        out.append((doc, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def pieces(rows, tokenizer, size=2048):
    out = {}
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), size):
            part = ids[at:at + size]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            out[doc, at] = (len(part), crc, len(ids))
    return out
