"""Plain versions of the operators on conversations and vectors."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict
from fractions import Fraction


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def ordered(rows) -> dict:
    """Conversations as lists of (role, text); null turns first, equal ones by a digest."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        tie = sha(f"{len(role.encode())}:{role}{text}")[:32]
        convs[conv].append((turn is not None, turn or 0, tie, role, text))
    return {c: [x[3:] for x in sorted(turns)] for c, turns in convs.items()}


def trie(rows):
    convs = ordered(r for r in rows if r[0] is not None)
    whole = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - int(math.fmod(c, 5))
        whole[c] = convs.get(head, [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, inside in members.items():
        own = (len(inside) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += own
            leaves[path[:d]] += path not in children
    return [
        (min(inside), len(p), min(members[p[:-1]]) if p else None, len(inside), children.get(p, 0), leaves[p], saved[p],
         sha(",".join(map(str, sorted(ends.get(p, []))))))
        for p, inside in members.items()
    ]


def escaped(text: str) -> str:
    out, i = [], 0
    while i < len(text):
        if text[i] == "<":
            j = i + 1
            while j < len(text) and text[j] == "\\":
                j += 1
            if j < len(text) and text[j] == "|":
                out.append("<\\" + text[i + 1 : j + 1])
                i = j + 1
                continue
        out.append(text[i])
        i += 1
    return "".join(out)


def chats(rows):
    out = []
    for c, turns in ordered(rows).items():
        trained = "".join(t for r, t in turns if r == "assistant")
        chars = sum(len("<|im_start|>\n<|im_end|>\n") + len(escaped(r.replace("\\", "\\\\").replace("\n", "\\n"))) + len(escaped(t)) for r, t in turns)
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(trained), sha(trained), chars))
    return out


def clusters(rows, k=40, rounds=5, dims=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, list(v), [math.floor(Fraction(x) * 256) for x in v]))
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    start = sorted(kept, key=lambda r: (r[0] is None, sha(f"2:{r[0]}"), r[1]))[:k]
    centroids = [r[2] for r in start]
    nearest = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if groups[j] else c for j, c in enumerate(centroids)]
    found = [(i, *nearest(v)[::-1]) for i, _, v in kept]
    total = [sum(d for _, j, d in found if j == c) for c in range(len(centroids))]
    fits = lambda x: x if x < 1 << 63 else None
    return [(i, j, fits(d), fits(total[j]), fits(sum(total)), sha(",".join(map(str, centroids[j])))) for i, j, d in found]
