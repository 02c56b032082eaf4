"""Plain Python versions of the operators' definitions."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(docs, length=50):
    """(n_bytes, n_removed, n_spans, sha256) for each (key, text), in the given order."""
    least = {}
    for key, text in docs:
        b = (text or "").encode()
        if key is not None:
            for i in range(len(b) - length + 1):
                w = b[i : i + length]
                least[w] = min(key, least.get(w, key))
    found = []
    for key, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if key is not None and least[b[i : i + length]] < key:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        found.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return found


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, len(covered)


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    """For n nodes the smallest node reachable from each."""
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


BASE = (
    ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def secrets(text):
    """Base spans as (start, order, end, kind), sorted."""
    return sorted(
        (m.start(), k, m.end(), kind) for k, (kind, pattern, fits) in enumerate(BASE) for m in pattern.finditer(text or "") if fits(m)
    )


def targets(sizes, weights=(1, 2, 3), most=3):
    """Targets of sources from their sizes, None last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * left / rest > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else weight[s] * left / rest for s in names}
        full |= over


def paragraphs(text, least=8):
    """(start, end, words) of the paragraphs of at least ``least`` words, in UTF-8 bytes."""
    content, found = (text or "").encode(), []
    at = 0
    for line in content.split(b"\n"):
        words = [(m.start() + at, m.end() + at) for m in re.finditer(rb"[^ \t\n\v\f\r]+", line)]
        begin = 0
        for i, (start, end) in enumerate(words):
            if i + 1 == len(words) or content[end - 1 : end] in b".!?" and i + 1 - begin >= least:
                if i + 1 - begin >= least:
                    part = words[begin : i + 1]
                    found.append((part[0][0], end, tuple(content[a:b].lower() for a, b in part)))
                begin = i + 1
        at += len(line) + 1
    return found


def jaccard(a, b, n=5):
    x, y = ({w[i : i + n] for i in range(len(w) - n + 1)} for w in (a, b))
    return len(x & y) / len(x | y)
