"""Plain versions of the operators, for small inputs."""

import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def near_duplicates(rows):
    """rows: (doc_id, text); id -> (n, component)."""
    sets = {}
    for d, text in rows:
        w = WORD.findall(lower(text or ""))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    has = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            has[g].append(d)
    common = Counter()
    for ds in has.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def token_files(rows, path, end_id=2):
    """rows: (doc_id, text); (doc_id, start, n, crc) in order."""
    import numpy as np
    from tokenizers import Tokenizer

    coder, start, out = Tokenizer.from_file(path), 0, []
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def removed(rows, n=200):
    """rows: (doc_id, text); doc_id -> (bytes, removed, spans, kept bytes)."""
    seen, texts = Counter(), {}
    for d, text in rows:
        b = texts[d] = (text or "").encode()
        for i in range(len(b) - n + 1):
            seen[b[i : i + n]] += 1
    out = {}
    for d, b in texts.items():
        cut = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                cut[i : i + n] = b"\x01" * n
        spans = sum(1 for i in range(len(b)) if cut[i] and (i == 0 or not cut[i - 1]))
        out[d] = (len(b), sum(cut), spans, bytes(x for x, c in zip(b, cut, strict=True) if not c))
    return out


def base_scores(rows):
    """rows: (doc_id, text); id -> (held out, tokens, known, training tokens, score)."""
    import math

    words = {d: [*WORD.findall(lower(t or "")), None] for d, t in rows}
    out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in words}
    counts = Counter(w for d, ws in words.items() if not out[d] for w in ws)
    n = sum(counts.values())
    return {
        d: (out[d], len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in ws))
        for d, ws in words.items()
    }


def benchmark_hits(rows, items, window=10):
    """rows: (doc_id, text), items: texts; the ids of documents that hold a window of an item."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wanted = set()
    for text in items:
        w = word.findall(lower(text or ""))
        n = min(window, len(w))
        if n:
            wanted |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    sizes = {len(w) for w in wanted}
    found = set()
    for d, text in rows:
        w = word.findall(lower(text or ""))
        if any(tuple(w[i : i + n]) in wanted for n in sizes for i in range(len(w) - n + 1)):
            found.add(d)
    return found


def mixed_copies(rows):
    """rows: (doc_id, text, source); doc_id -> copies the mix takes."""
    import hashlib
    import math

    sizes = {d: len(WORD.findall(t or "")) for d, t, _ in rows}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    words = {s: sum(sizes[d] for d, _, x in rows if x == s) for s in sources}
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sources)}
    target, left, budget = {}, set(sources), 1.5 * sum(words.values())
    while left:  # share by weight, stop those above twice their size, share the rest again
        share = {s: budget * weight[s] / sum(weight[x] for x in left) for s in left}
        above = {s for s in left if share[s] > 2.0 * words[s]}
        if not above:
            target |= share
            break
        for s in above:
            target[s] = 2.0 * words[s]
            budget -= target[s]
        left -= above
    out = {}
    for s in sources:
        u = int(hashlib.md5(f"mix-1:{s or ''}".encode()).hexdigest()[:8], 16) / 2**32
        rate = target[s] / words[s] if words[s] else 0.0
        own = sorted((sizes[d], d) for d, _, x in rows if x == s)
        for k, (_, d) in enumerate(own):
            out[d] = math.floor(rate * (k + 1) + u) - math.floor(rate * k + u)
    return out
