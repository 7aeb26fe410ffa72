"""Plain Python versions of the contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def secrets(rows):
    kinds = [
        ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 12),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
    ]
    out = []
    for doc, text in rows:
        found = [(m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(kinds) for m in p.finditer(text or "") if len(m[g]) >= n]
        spans = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in sorted(found))
        out.append((doc, *(sum(f[1] == k for f in found) for k in range(3)), sha(spans), spans))
    return out


def substring(rows, width=50):
    least = {}
    own = [(doc, WORD.findall(text or "")) for doc, text in rows]
    for doc, w in own:
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            least[key] = min(least.get(key, doc), doc)
    out = []
    for doc, w in own:
        gone = set()
        for i in range(len(w) - width + 1):
            if least[tuple(w[i : i + width])] < doc:
                gone.update(range(i, i + width))
        out.append((doc, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def fingerprint(text):
    w = WORD.findall(lower(text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(rows, radius=4):
    marks = [(doc, fingerprint(text)) for doc, text in rows]
    root = {m: m for _, m in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = list(root)
    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for doc, m in marks:
        least[find(m)] = min(least.get(find(m), doc), doc)
    return [(doc, f"{m:016x}", least[find(m)]) for doc, m in marks]


def base_quality(rows):
    out = []
    for doc, text in rows:
        text = text or ""
        w = WORD.findall(text)
        n = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if n[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        out.append((doc, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed))
    return out


def contamination(rows, items, width=13):
    out = []
    queries = []
    for item, text in items:
        w = ALNUM.findall(lower(text or ""))
        size = min(width, len(w))
        if size:
            queries.append((item, size, {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}))
    for doc, text in rows:
        w = ALNUM.findall(lower(text or ""))
        hit, found = set(), set()
        for item, size, windows in queries:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(item)
        names = ",".join(sorted(map(str, found)))
        out.append((doc, len(w), len(hit), len(found), sha(names), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def near(rows, items, width=13):
    """Items whose first words, up to ``width``, all stand within some run of 2 * width words."""
    out = []
    for doc, text in rows:
        w = ALNUM.findall(lower(text or ""))
        n = 0
        for _, item in items:
            need = set(ALNUM.findall(lower(item or ""))[:width])
            n += bool(need) and any(need <= set(w[i : i + 2 * width]) for i in range(len(w)))
        out.append((doc, n))
    return out


def base_language_model(rows):
    import math

    tokens = [(doc, [*WORD.findall(lower(text or "")), None]) for doc, text in rows]
    train = Counter(t for doc, ts in tokens if zlib.crc32(str(doc).encode()) % 10 for t in ts)
    n, v = sum(train.values()), len(train)
    return [(doc, zlib.crc32(str(doc).encode()) % 10 == 0, len(ts), sum(t in train for t in ts), n, sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)) for doc, ts in tokens]


def suffix(rows, width=400, shared=288):
    raw = [(doc, (text or "").encode()) for doc, text in rows]
    n = Counter(t[i : i + width] for _, t in raw for i in range(len(t) - width + 1))
    owners = defaultdict(set)
    for doc, t in raw:
        for i in range(len(t) - shared + 1):
            owners[t[i : i + shared]].add((doc, t))
    out = []
    for doc, t in raw:
        gone, common = bytearray(len(t)), bytearray(len(t))
        for i in range(len(t) - width + 1):
            if n[t[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        for i in range(len(t) - shared + 1):
            if len(owners[t[i : i + shared]]) > 1:
                common[i : i + shared] = b"\1" * shared
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc, len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone, strict=True) if not g)), sum(common)))
    return out


def quality(rows, min_docs=20, share=0.01, keep=0.25):
    """rows of (doc_id, host, text): base figures, kept and n_boilerplate; documents of one host with equal sets of lines count once."""
    own = []
    for _, _, text in rows:
        held = Counter()
        for line in (text or "").split("\n"):
            if w := tuple(WORD.findall(lower(line))):
                held[w] += len(w)
        own.append(held)
    docs = defaultdict(set)
    for (_, host, _), held in zip(rows, own, strict=True):
        for line in held:
            docs[host, line].add(frozenset(held))
    hosts = Counter(host for host, _ in {(host, frozenset(held)) for (_, host, _), held in zip(rows, own, strict=True) if held})
    out = []
    for (_, host, _), base, held in zip(rows, base_quality([(d, t) for d, _, t in rows]), own, strict=True):
        gone = sum(n for line, n in held.items() if len(docs[host, line]) > min_docs and len(docs[host, line]) > share * hosts[host])
        out.append((*base, not base[6] and base[1] - gone >= keep * base[1], gone))
    return out
