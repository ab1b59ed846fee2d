"""Plain versions of the text operators, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def contamination(text, items, width=10):
    """(n_words, n_hit, ids) of one text; items: (id, text)."""
    own = words(text)
    hit, found = set(), set()
    for item, passage in items:
        told = words(passage)
        n = min(width, len(told))
        windows = {tuple(told[i : i + n]) for i in range(len(told) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYS = re.compile(r"[A-Za-z0-9/+]+")
ENDPOINT = re.compile(r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/?=&%-]*)?")


def secrets(text, reach=200):
    """Spans (start, kind, end) of one text, base and linked ones."""
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    mixed = lambda w: re.search("[A-Z]", w) and re.search("[a-z]", w) and re.search("[0-9]", w)
    weak = [(m.start(), 3, m.end()) for m in KEYS.finditer(text) if len(m[0]) == 40 and mixed(m[0])]
    weak += [(m.start(), 4, m.end()) for m in ENDPOINT.finditer(text)]

    def linked(x):
        near = any(p[1] < 2 and (p[1] == 1 or x[1] == 4) and max(p[0] - x[2], x[0] - p[2]) <= reach for p in base)
        return near and not any(p[0] < x[2] and x[0] < p[2] for p in base)

    return sorted(base + [x for x in weak if linked(x)])


def hidden(text, mark="[secret]", reach=200):
    out, at = "", 0
    for start, _, end in secrets(text, reach):
        if not (at and start <= at):
            out += text[at:start] + mark
        at = max(at, end)
    return out + text[at:]


def shingles(text, size=5):
    own = words(text)
    n = min(size, len(own))
    return Counter(tuple(own[i : i + n]) for i in range(len(own) - n + 1)) if n else Counter()


def probability_jaccard(x, y):
    total = 0.0
    for i in x.keys() & y.keys():
        total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
    return total


def near_classes(rows, similarity=0.8):
    """{id: class} of (id, text) by comparing all pairs that share a shingle."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: shingles(t) for i, t in rows}
    by = defaultdict(list)
    for i, s in sets.items():
        for k in s:
            by[k].append(i)
    pairs = Counter()
    for ids in by.values():
        for a in range(len(ids)):
            for b in range(a + 1, len(ids)):
                pairs[ids[a], ids[b]] += 1
    for (a, b), common in pairs.items():
        if common / max(len(sets[a]), len(sets[b])) >= similarity / 2 and probability_jaccard(sets[a], sets[b]) >= similarity - 1e-9:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: find(i) for i in root}


def language_bits(training, text, order=3):
    """Code length of ``text`` in bits in each language of (language, text) rows, one byte after another."""
    counts = defaultdict(lambda: defaultdict(Counter))
    for lang, t in training:
        data = bytes(order) + t.encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[lang][data[i - k : i]][data[i]] += 1
    out = {}
    data = bytes(order) + text.encode()
    for lang, tree in counts.items():
        bits = 0.0
        for i in range(order, len(data)):
            for k in range(order, -1, -1):
                seen = tree.get(data[i - k : i])
                if not seen:
                    continue
                n, d = sum(seen.values()), len(seen)
                if data[i] in seen:
                    bits -= math.log2(seen[data[i]] / (n + d))
                    break
                bits -= math.log2(d / (n + d))
            else:
                bits += 8
        out[lang] = bits
    return out
