"""Brute-force versions of the corpus operators, row by row in plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def exact_dedup(rows):
    """rows: (doc_id, text) -> {index: (keep_id, size, kept, sha)}"""
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append(i)
    out = {}
    for norm, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        for i in members:
            out[i] = (rows[best][0], len(members), i == best, hashlib.sha256(norm.encode()).hexdigest())
    return out


def fingerprint(text):
    lowered = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    count = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(shingles))


def simhash_components(prints, max_bits=2):
    """prints: {fp} -> {fp: smallest fp reachable}, by comparing everything with everything."""
    fps = sorted(prints)
    parent = {f: f for f in fps}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {f: find(f) for f in fps}


def targets(sizes, weights=(5, 2, 1), cap=3):
    """sizes: {source: words} -> {source: target}"""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(sizes.values())
    fixed = {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        share = (total - sum(fixed.values())) / sum(w[s] for s in free)
        over = [s for s in free if share * w[s] > cap * sizes[s]]
        if not over:
            return fixed | {s: share * w[s] for s in free}
        fixed |= {s: cap * sizes[s] for s in over}


def quality_stats(text):
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def span_text(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def url_parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]


def url_rule(host, path):
    rules = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block"))
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def line_chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    r = [((h[i - 1] if i else 0) * 1_000_003 + h[i]) % 2_147_483_647 for i in range(len(h))]
    starts = [i for i in range(len(r)) if i == 0 or (r[i] < r[i - 1] and (i + 1 == len(r) or r[i] <= r[i + 1]))]
    return [lines[a:b] for a, b in zip(starts, [*starts[1:], len(lines)])]


def line_dedup(rows):
    """rows: distinct (doc_id, text), doc_ids distinct -> {doc_id: (text, removed lines)}"""
    first = {}
    for d, t in sorted(rows):
        for pos, c in enumerate(line_chunks(t)):
            if len(c) >= 2 and words("\n".join(c)):
                first.setdefault("\n".join(c), (d, pos))
    out = {}
    for d, t in rows:
        kept, gone = [], 0
        for pos, c in enumerate(line_chunks(t)):
            if first.get("\n".join(c), (d, pos)) == (d, pos):
                kept += c
            else:
                gone += len(c)
        out[d] = ("\n".join(kept), gone)
    return out
