"""Plain versions of the operators: each takes (doc_id, text) rows and gives the rows of the operator's query."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from gleanery.llm.quality_rules import RULES, STOP_WORDS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def pii(rows):
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) < 256 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    out = []
    for i, text in rows:
        found = {k: [m.span() for m in re.finditer(p, text or "") if good(m.group())] for k, (p, good) in kinds.items()}
        spans = [f"{k}:{a}:{b}" for k, xs in found.items() for a, b in xs]
        out.append((i, *(len(xs) for xs in found.values()), sha(",".join(spans))))
    return out


def lines(rows, threshold=10):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)

    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        left = [x for x in all_lines if seen[key(x)] < threshold or not key(x)]
        out.append((i, len(all_lines), len(all_lines) - len(left), "\n".join(left)))
    return out


def _last(i):
    return math.inf if i is None else i


def windows(rows, width=20):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first: dict = {}
    for i, w in words:
        for p in range(len(w) - width + 1):
            k = tuple(w[p : p + width])
            first[k] = min(first.get(k, (math.inf, math.inf)), (_last(i), p))
    out = []
    for i, w in words:
        gone = {q for p in range(len(w) - width + 1) if first[tuple(w[p : p + width])] < (_last(i), p) for q in range(p, p + width)}
        out.append((i, len(w), len(gone), sha(" ".join(x for q, x in enumerate(w) if q not in gone))))
    return out


def strings(rows, length=200):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(x[p : p + length] for _, x in data for p in range(len(x) - length + 1))
    out = []
    for i, x in data:
        gone = bytearray(len(x))
        for p in range(len(x) - length + 1):
            if seen[x[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for p in range(len(x)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(x), sum(gone), spans, sha(bytes(b for b, g in zip(x, gone, strict=True) if not g))))
    return out


def ngrams(rows, order=3, discount=0.75, weight=8.0):
    docs = [(i, ["\t", *WORD.findall((t or "").translate(FOLD)), "\n"]) for i, t in rows]
    held = {i: i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    c = Counter()
    for i, x in docs:
        if not held[i]:
            c.update(tuple(x[a:b]) for b in range(1, len(x) + 1) for a in range(max(0, b - order), b))
    words = [w for w in c if len(w) == 1 and w != ("\t",)]
    n, v = sum(c[w] for w in words), len(words)

    def p(history, w):
        if not history:
            return max(c[w,] - discount, 0) / n + discount * v / n / (v + 1) if n else 1.0
        return (c[*history, w] + weight * p(history[1:], w)) / (c[history] + weight)

    def failures(history, w):
        known = [k for k in range(len(history) + 1) if not k or c[history[-k:]]]
        with_arc = [k for k in known if not k or c[*history[-k:], w]]
        return max(known) - max(with_arc)

    out = []
    for i, x in docs:
        steps = [(tuple(x[max(0, b - order + 1) : b]), x[b]) for b in range(1, len(x))]
        base = sum(math.log10((c[w,] + 1) / (n + v + 1)) for _, w in steps)
        score = sum(math.log10(p(h, w)) for h, w in steps)
        known = sum(c[w,] > 0 for _, w in steps)
        out.append((i, held[i], len(steps), known, n, round(base, 4), round(score, 4), sum(failures(h, w) for h, w in steps)))
    return out


def bpe(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    out = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((i, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(t.decode(ids, skip_special_tokens=False))))
    return out


def tiled(doc: list, item: list, least: int) -> int:
    """Tokens of the item under the tiles, by the plain rule: again and again the longest common run of free tokens."""
    free_d, free_i, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and free_i[i + n] and free_d[d + n] and item[i + n] == doc[d + n]:
                    n += 1
                best = max(best, (n, -i, -d))
        n, i, d = best[0], -best[1], -best[2]
        if not n or n < min(least, len(item)):
            return covered
        free_d[d : d + n] = free_i[i : i + n] = [False] * n
        covered += n


def tokens(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(FOLD))


def leaks(rows, items, least=5, share=0.8):
    out = []
    for i, t in rows:
        doc = tokens(t)
        grams = {tuple(doc[p : p + n]) for n in range(1, least + 1) for p in range(len(doc) - n + 1)}
        for k, text in items:
            item = tokens(text)
            n = min(least, len(item))
            if item and any(tuple(item[p : p + n]) in grams for p in range(len(item) - n + 1)):
                if tiled(doc, item, least) >= share * len(item):
                    out.append((i, k))
    return out


def quality(rows):
    out = []
    for i, text in rows:
        t = text or ""
        w = WORD.findall(t)
        grams = [tuple(w[p : p + 3]) for p in range(len(w) - 2)]
        seen = Counter(grams)
        again = {q for p, g in enumerate(grams) if seen[g] > 1 for q in range(p, p + 3)}
        ls = [x for x in t.split("\n") if WORD.search(x)]
        n = {
            "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(x in "#*$%&|<>" for x in t),
            "n_dup_lines": len(ls) - len(set(ls)), "n_repeat_words": len(again), "n_lines": len(ls), "n_chars": len(t),
            "n_stop_words": sum(x.lower() in STOP_WORDS for x in w), "n_letters": sum(x.isalpha() if ord(x) < 128 else True for x in t),
        }
        base = n["n_words"] < 50 or 100 * n["n_repeat_words"] > 50 * n["n_words"]

        def broken(r, n=n):
            x = 100 * n[r.numerator] / n[r.denominator] if n[r.denominator] else 0
            return (r.low is not None and x < r.low) or (r.high is not None and x > r.high)

        failed = ",".join(r.name for r in RULES if broken(r))
        out.append((i, *(n[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), base, not base and not failed, failed))
    return out


def near(rows, width=4, percent=80):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(FOLD))
        sets.append({tuple(w[p : p + width]) for p in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    common: dict = defaultdict(Counter)
    where = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            for j in where[x]:
                common[k][j] += 1
            where[x].append(k)
    for k, js in common.items():
        for j, n in js.items():
            if 100 * n >= percent * (len(sets[k]) + len(sets[j]) - n):
                up[root(k)] = root(j)
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), math.inf), _last(i))
    out = []
    for k, (i, _) in enumerate(rows):
        c = least[root(k)]
        c = None if c == math.inf else c
        out.append((i, len(sets[k]), c, i == c))
    return out
