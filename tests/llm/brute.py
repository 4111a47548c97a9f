"""Plain Python versions of the contracts, for small inputs only."""

import hashlib
import re

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum(text):
    return ALNUM.findall((text or "").translate(AZ))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def decontaminate(docs, items, window=10):
    """docs, items: lists of (id, text) -> list of (doc_id, n_words, n_hit, n_items, sha, contaminated)."""
    windows = {}
    for item, text in items:
        ws = alnum(text)
        if not ws:
            continue
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1):
            # an item without id hits, but is not named
            windows.setdefault(n, {}).setdefault(tuple(ws[i : i + n]), set()).update([] if item is None else [item])
    out = []
    for doc, text in docs:
        ws = alnum(text)
        hit, found = set(), set()
        for n, table in windows.items():
            for i in range(len(ws) - n + 1):
                if (who := table.get(tuple(ws[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= who
        out.append((doc, len(ws), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(docs):
    out = []
    for doc, text in docs:
        ws = alnum(text)
        places, labels = [], set()
        for phrase, label in PHRASES.items():
            p = phrase.split()
            for i in range(len(ws) - len(p) + 1):
                if ws[i : i + len(p)] == p:
                    places.append(i)
                    labels.add(label)
        out.append((doc, len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    return out


def substring_words(docs, window=20):
    """(doc_id, n_words, n_removed, kept_sha256); a null id comes after every other."""
    docs = [(d, SPACED.findall(t or "")) for d, t in docs]
    order = lambda d: (d is None, d or 0)
    first = {}
    for d, ws in docs:
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i : i + window])
            at = (*order(d), i)
            first[key] = min(first.get(key, at), at)
    out = []
    for d, ws in docs:
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < (*order(d), i):
                gone.update(range(i, i + window))
        out.append((d, len(ws), len(gone), sha(" ".join(w for i, w in enumerate(ws) if i not in gone))))
    return out


def substring_bytes(docs, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256); a null id comes after every other."""
    docs = [(d, (t or "").encode()) for d, t in docs]
    order = lambda d: (d is None, d or 0)
    first = {}
    for d, b in docs:
        for i in range(len(b) - length + 1):
            at = (*order(d), i)
            key = b[i : i + length]
            first[key] = min(first.get(key, at), at)
    out = []
    for d, b in docs:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (*order(d), i):
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for i, x in enumerate(b) if not gone[i]))))
    return out


def simhash(docs, bits=2):
    """(doc_id, fingerprint, component_id)."""
    import xxhash

    out = []
    for d, text in docs:
        ws = SPACED.findall((text or "").translate(AZ))
        grams = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or ([" ".join(ws)] if ws else [])
        hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
        out.append((d, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))))
    prints = sorted({f for _, f in out})
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    least = {}
    for d, f in out:
        if d is not None:
            least[root(f)] = min(least.get(root(f), d), d)
    return [(d, f"{f:016x}", least.get(root(f))) for d, f in out]


def best_fit(sizes, capacities, overhead):
    """Best-fit decreasing with the opening rule, by scanning all bins."""
    from finlake.llm.packing import opening_length

    bins, left = [], list(sizes)
    for s in sizes:
        left = left[1:]
        fits = [b for b in bins if b[0] - sum(b[1]) >= s]
        if fits:
            b = min(fits, key=lambda b: b[0] - sum(b[1]))
        else:
            volume = [sum(x for x in left if x <= c) for c in capacities]
            bins.append(b := [opening_length(s, capacities, overhead, volume), []])
        b[1].append(s)
    return [min(c for c in capacities if c >= sum(b[1])) for b in bins], [sum(b[1]) for b in bins]


def exact_copies(docs, keep="smallest"):
    """(doc_id, keep_id, group_size, kept, text_sha256); ids are distinct."""
    groups = {}
    for d, text in docs:
        groups.setdefault((text or "").translate(AZ), []).append(d)
    best = {t: (min if keep == "smallest" else max)(ids) for t, ids in groups.items()}
    out = []
    for d, text in docs:
        t = (text or "").translate(AZ)
        out.append((d, best[t], len(groups[t]), d == best[t], sha(t)))
    return out


def resample(docs, target, percent=25, min_words=20, seed=7, buckets=10000, max_gram=2):
    """(doc_id, n_features, weight, score, rank) by the formulas, a feature at a time; ids are distinct or null."""
    import math
    import zlib

    def features(text):
        ws = alnum(text)
        grams = [" ".join(ws[i : i + g]) for g in range(1, max_gram + 1) for i in range(len(ws) - g + 1)]
        return len(ws), [zlib.crc32(g.encode()) % buckets for g in grams]

    def count(texts):
        out = [0] * buckets
        for text in texts:
            for b in features(text)[1]:
                out[b] += 1
        return out

    s, t = count(x for _, x in docs), count(target)
    gain = [
        math.floor(1000 * math.log(float((t[b] + 1) * (sum(s) + buckets)) / float((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)
    ]
    rows = []
    for d, text in docs:
        n_words, fs = features(text)
        weight = sum(gain[b] for b in fs) // len(fs) if fs else 0
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((d, len(fs), weight, score, n_words))
    order = sorted((r for r in rows if r[0] is not None and r[4] >= min_words), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(order[: percent * len(order) // 100])}
    return [(d, n, w, sc, rank.get(d)) for d, n, w, sc, _ in rows]


def hard_negatives(rows, anchors, positives=5, negatives=5, low=80, high=100):
    """rows: distinct (id, label, whole-number vector); anchors: ids -> the six columns, from all scores."""
    out = []
    for a in anchors:
        mine = min((label, v) for i, label, v in rows if i == a)
        scored = [(-sum(x * y for x, y in zip(mine[1], v)), i, label) for i, label, v in rows if i != a]
        scored.sort()
        for ps, p, _ in [s for s in scored if s[2] == mine[0]][:positives]:
            fit = [(n, ns) for ns, n, label in scored if label != mine[0] and low * -ps <= 100 * -ns <= high * -ps]
            out += [(a, p, r, n, -ps, -ns) for r, (n, ns) in enumerate(fit[:negatives], 1)]
    return sorted(out)
