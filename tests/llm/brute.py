"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LAST = (1 << 63) - 1


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def repeats(rows, width=20):
    words = [(LAST if d is None else d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for p in range(len(w) - width + 1):
            key = tuple(w[p:p + width])
            first[key] = min(first.get(key, LAST), d)
    out = []
    for (d, w), (doc_id, _) in zip(words, rows):
        gone, seen = set(), set()
        for p in range(len(w) - width + 1):
            key = tuple(w[p:p + width])
            if first[key] < d or key in seen:
                gone.update(range(p, p + width))
            seen.add(key)
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def contamination(rows, items, width=10):
    def words(text):
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[i:i + width])].add(item or "")
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        listed = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def classes(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                links[i] += 1
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    return [(rows[i][0], min((x for x in ids[find(i)] if x is not None), default=None), links[i]) for i in range(len(rows))]


def ppm(rows, depth, lower, mod=5):
    """doc_id to (tokens, known, train tokens, base, score)."""
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % mod == 1
    train = [(t or "").encode().translate(lower) for d, t in rows if not held(d)]
    count = Counter()
    seen = defaultdict(Counter)
    for t in train:
        count.update(t.split() + [b" "])
        s = b"\xff" * depth + t + b"\xff"
        for p in range(depth, len(s)):
            for k in range(depth + 1):
                seen[s[p - k:p]][s[p]] += 1
    total, distinct = sum(count.values()), len(count)

    def log_p(history, symbol):
        gone, out = set(), 0.0
        for k in range(depth, -1, -1):
            here = seen.get(history[len(history) - k:], {})
            rest = {s: n for s, n in here.items() if s not in gone}
            if not rest:
                continue
            whole = sum(rest.values()) + len(rest)
            if symbol in rest:
                return out + math.log10(rest[symbol] / whole)
            out += math.log10(len(rest) / whole)
            gone = set(here)
        return out - math.log10(256 - len(gone))

    out = {}
    for d, t in rows:
        b = (t or "").encode().translate(lower)
        w, s = b.split() + [b" "], b"\xff" * depth + b + b"\xff"
        out[d] = (len(w), sum(count[x] > 0 for x in w), total,
                  sum(math.log10((count[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w),
                  sum(log_p(s[p - depth:p], s[p]) for p in range(depth, len(s))))
    return out


def search(rows, items, best=10):
    """(item_id, rank, doc_id, score); rows with a term are documents, items with one id are one item."""
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))

    docs = [(d, Counter(t)) for d, t in ((d, terms(t)) for d, t in rows) if t]
    n_docs, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(Counter)
    for item, text in set(items):
        asked[item].update(terms(text))
    out = []
    for item, want in asked.items():
        scores = []
        for d, c in docs:
            m = 25 + (75 * c.total() * n_docs) // total
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, k in want.items() if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(sorted(scores, key=lambda r: r[:3])[:best], 1)]
    return out


def linked_vectors(rows, threshold=0.98):
    """(vec_id, n_links, component_id, kept) of (vec_id, vector, label) rows, by all pairs."""
    def unit(v, label):
        if v is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        top = max(map(abs, v))
        norm = math.sqrt(sum((x / top) ** 2 for x in v))
        return [x / top / norm for x in v]

    units = [unit(v, label) for _, v, label in rows]
    near = [[j for j, w in enumerate(units) if j != i and u is not None and w is not None and rows[i][2] == rows[j][2]
             and len(u) == len(w) and sum(map(float.__mul__, u, w)) >= threshold - 1e-13] for i, u in enumerate(units)]
    out, known = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in known:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        known |= group
        least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        for j in group:
            out[j] = (rows[j][0], len(near[j]), least, rows[j][0] == least)
    return out


def variants(rows, deleted=None):
    """(word, form, root, n, n_near, form_n) by all candidates of one edit."""
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if deleted and h % deleted == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    letters = sorted({c for w in words for c in w})
    near = {}
    for w in words:
        made = {w[:p] + w[p + 1:] for p in range(len(w))}
        made |= {w[:p] + c + w[p + k:] for p in range(len(w) + 1) for c in letters for k in (0, 1)}
        near[w] = {m for m in made if m in words and m != w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out
