"""The contracts of some operators, word for word, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict


def kept_words(rows, size=20):
    """(n_words, n_removed, sha256 of the kept words) of (order, text) rows, in their order."""
    seen, result = set(), []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone[i : i + size] = [True] * size
            seen.add(window)
        left = b" ".join(w for w, g in zip(words, gone) if not g)
        result.append((len(words), sum(gone), hashlib.sha256(left).hexdigest()))
    return result


def _terms(text):
    found = re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode())
    return [t.lower() for t in found]


def ranked(docs, items, top=10):
    """(item, rank, key, score) of (key, text) rows for (item, text) rows."""
    counts = [(key, Counter(_terms(text))) for key, text in docs]
    counts = [(key, c) for key, c in counts if c]
    n, occurrences = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    rows = []
    for item, text in items:
        scored = []
        for key, c in counts:
            m = 100 - 75 + (75 * sum(c.values()) * n) // occurrences
            score = 0
            for t in _terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, key is not None, key))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        rows += [(item, i + 1, s[2], -s[0]) for i, s in enumerate(scored[:top])]
    return rows


def phrases(rows, least=100, longest=5, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").encode().lower().decode()
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    result = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        covered = set()
        for longer, a in candidates.items():
            for size in range(2, len(longer)):
                for i in range(len(longer) - size + 1):
                    part = longer[i : i + size]
                    if 100 * a >= 100 * counts[part]:
                        covered.add(part)
        kept = []
        for p, a in candidates.items():
            if p in covered:
                continue
            cuts = []
            for k in range(1, len(p)):
                left, right = counts[p[:k]], counts[p[k:]]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, p, left, right) in enumerate(sorted(kept)[:top]):
            result.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -score))
    return result
