"""Plain-Python versions of the operators, for small tables of (id, text)."""

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x: bytes | str) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def ordered(docs):
    """(id, text) in the order that row ids follow."""
    return sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or ""))


def suffix_dedup(docs, width=400):
    count = Counter()
    texts = [(i, (t or "").encode()) for i, t in docs]
    for _, b in texts:
        count.update(b[a:a + width] for a in range(len(b) - width + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), int)
        for a in range(len(b) - width + 1):
            if count[b[a:a + width]] > 1:
                gone[a:a + width] = 1
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.append([0], gone)) == 1).sum()), sha(kept)))
    return out


def substring_dedup(docs, width=20):
    seen, out = set(), []
    for i, t in ordered(docs):
        words = [w.encode() for w in WORD.findall(t or "")]
        gone = set()
        for a in range(len(words) - width + 1):
            window = tuple(words[a:a + width])
            if window in seen:
                gone.update(range(a, a + width))
            seen.add(window)
        out.append((i, len(words), len(gone), sha(b" ".join(w for k, w in enumerate(words) if k not in gone))))
    return out


def quality(docs):
    out = []
    for i, t in docs:
        t = t or ""
        words = WORD.findall(t)
        grams = [tuple(words[a:a + 3]) for a in range(len(words) - 2)]
        count, covered, seen, dup = Counter(grams), set(), set(), 0
        for a, g in enumerate(grams):
            if count[g] > 1:
                covered |= {a, a + 1, a + 2}
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        n = len(words)
        out.append((i, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered),
                    n < 50 or 100 * len(covered) > 50 * n))
    return out


def shingles(text, k):
    words = (text or "").translate(LOWER).encode().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[a:a + k]) for a in range(len(words) - k + 1)}


def components(docs, k=3, percent=90):
    rows = ordered(docs)
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    lists = defaultdict(list)
    for y, s in enumerate(sets):
        shared = Counter(x for g in s for x in lists[g])
        for x, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[x]) - n):
                a, b = root(x), root(y)
                parent[max(a, b)] = min(a, b)
        for g in s:
            lists[g].append(y)
    return [(i, len(sets[y]), rows[root(y)][0]) for y, (i, _) in enumerate(rows)]


def matching_lines(docs, percent=80, min_words=1):
    """Removed line numbers per document, in row order."""
    sets, lists, out = [], defaultdict(list), []
    for i, t in ordered(docs):
        gone = []
        for ln, line in enumerate((t or "").split("\n")):
            words = WORD.findall(line)
            if len(words) < min_words:
                continue
            s = set(words)
            shared = Counter(x for g in s for x in lists[g])
            if any(100 * n >= percent * (len(sets[x]) + len(s) - n) for x, n in shared.items()):
                gone.append(ln)
            for g in s:
                lists[g].append(len(sets))
            sets.append(s)
        out.append((i, 0 if t is None else len(t.split("\n")), len(gone), ",".join(map(str, gone))))
    return out


ASSIGN = re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(docs):
    out = []
    for i, t in docs:
        t = t or ""
        a = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 8]
        k = [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        h = [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
        kinds = ("assign", "access", "hex")
        joined = ",".join(f"{kinds[z]}:{x}:{e}" for x, z, e in sorted(a + k + h))
        out.append((i, len(a), len(k), len(h), sha(joined)))
    return out


def contamination(docs, items, window=10):
    words_of = lambda t: ALNUM.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, t in items:
        w = words_of(t)
        size = min(window, len(w))
        for a in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[a:a + size])].add("" if item is None else str(item))
    out = []
    for i, t in docs:
        w, hit, found = words_of(t), set(), set()
        for size in {len(x) for x in windows}:
            for a in range(len(w) - size + 1):
                g = tuple(w[a:a + size])
                if g in windows:
                    hit.update(range(a, a + size))
                    found |= windows[g]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def archive(pages):
    """Rows of (page_id, html), page_ids unique."""
    first = {}
    for i, h in sorted(pages):
        first.setdefault(h or "", i)
    out = []
    for i, h in pages:
        b = (h or "").encode()
        response = first[h or ""] == i
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "response" if response else "revisit", None if response else first[h or ""]))
    return out
