"""Plain single-machine versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import base64
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def order(row):
    return tuple((x is None, str(type(x)), x) for x in row)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=order)


def exact(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc)
    out = []
    for norm, docs in groups.items():
        known = [d for d in docs if d is not None]
        keep, kept = min(known) if known else None, False
        for doc in docs:
            stays = doc == keep and not kept
            kept = kept or stays
            out.append((doc, keep, len(docs), stays, hashlib.sha256(norm.encode()).hexdigest()))
    return out


def measures(text):
    words = WORD.findall(text or "")
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def targets(sizes):
    """source -> target by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, closed, left = dict.fromkeys(names, 0.0), set(), float(sum(sizes.values()))
    while left > 1e-9 and len(closed) < len(names):
        open_weight = sum(weight[s] for s in names if s not in closed)
        for s in names:
            if s not in closed:
                target[s] += left * weight[s] / open_weight
        left = 0.0
        for s in names:
            if s not in closed and target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                closed.add(s)
    return target


def repeats(rows, window=13):
    first, out = {}, []
    split = [(d, LAST if d is None else d, WORD.findall(t or "")) for d, t in rows]
    for _, doc, words in split:
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, doc), doc)
    for d, doc, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def union_find(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near(rows):
    sets, holders, links = [shingles(t) for _, t in rows], {}, []
    for i, s in enumerate(sets):
        shared = {}
        for g in s:
            for j in holders.setdefault(g, []):
                shared[j] = shared.get(j, 0) + 1
            holders[g].append(i)
        links += [(i, j) for j, n in shared.items() if 100 * n >= 80 * (len(s) + len(sets[j]) - n)]
    root = union_find(len(rows), links)
    least = {}
    for (doc, _), r in zip(rows, root):
        least[r] = min(least.get(r, LAST), LAST if doc is None else doc)
    return [(d, len(s), None if least[r] == LAST else least[r]) for (d, _), s, r in zip(rows, sets, root)]


def warc(rows, min_bytes=0):
    first = {}
    for page, html in rows:
        body = (html or "").encode()
        if len(body) >= min_bytes:
            first[body] = min(first.get(body, LAST), LAST if page is None else page)
    out = []
    for page, html in rows:
        body = (html or "").encode()
        least = first.get(body, LAST)
        revisit = body in first and (LAST if page is None else page) != least
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "revisit" if revisit else "response", least if revisit else None))
    return out


def union_find_roots(rows):
    """The component of every row that has words."""
    numbered = near([(i, t) for i, (_, t) in enumerate(rows)])
    return [c for i, n, c in numbered if n]
