"""Slow and plain versions of the operators' definitions."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return (text or "").translate(LOWER)


lower_ = lower


def contamination(docs, items, n=10):
    """[(doc_id, text)], [(item_id, text)] -> {doc_id: (n_words, n_hit, items)}"""
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text))
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[i : i + k])].add(item)
    sizes = {len(x) for x in windows}
    out = {}
    for doc, text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        out[doc] = (len(w), len(hit), sorted(str(x) for x in found if x is not None))
    return out


def shingles(text, k):
    w = SPACED.findall(lower(text))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_groups(docs, k, percent=80):
    """[(doc_id, text)] -> {doc_id: (n_shingles, component)}; every pair is looked at."""
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {d: (len(s), top(d)) for d, s in sets.items()}


def passages(docs, n=50):
    """{doc_id: positions inside n-word windows that stand at two places}, and those inside windows
    that stand elsewhere too and stay there: at the first place by text class, doc_id and position."""
    words = {d: SPACED.findall(lower(t)) for d, t in docs}
    places = defaultdict(list)
    for d, w in words.items():
        c = int(hashlib.md5(" ".join(w).encode()).hexdigest()[:15], 16)
        for i in range(len(w) - n + 1):
            places[tuple(w[i : i + n])].append((c, d, i))
    every, later = defaultdict(set), defaultdict(set)
    for found in places.values():
        if len(found) > 1:
            first = min(found)
            for place in found:
                every[place[1]] |= set(range(place[2], place[2] + n))
                if place != first:
                    later[place[1]] |= set(range(place[2], place[2] + n))
    return dict(every), dict(later)


def quality(text):
    text = text or ""
    w = SPACED.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            again += line in seen
            seen.add(line)
    count = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = set()
    for i in range(len(w) - 2):
        if count[tuple(w[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit)


def later_lines(docs, words=20):
    """{doc_id: numbers of its lines with a word} that lie in a run of any number of lines seen earlier."""
    lines = {d: [x for x in (t or "").split("\n") if SPACED.search(x)] for d, t in docs}
    count = {d: [len(SPACED.findall(x)) for x in ls] for d, ls in lines.items()}
    gone = defaultdict(set)
    for size in range(1, max(map(len, lines.values()), default=0) + 1):
        seen, again = set(), False
        for d in sorted(lines):
            for i in range(len(lines[d]) - size + 1):
                run = tuple(lines[d][i : i + size])
                if run in seen:
                    again = True
                    if sum(count[d][i : i + size]) >= words:
                        gone[d] |= set(range(i, i + size))
                seen.add(run)
        if not again:
            break
    return gone


def kept_lines(docs, words=20):
    """[(doc_id, text)] in order of doc_id -> {doc_id: text} without the later lines."""
    gone, out = later_lines(docs, words), {}
    for d, t in docs:
        if t is None:
            out[d] = None
            continue
        keep, n = [], -1
        for line in t.split("\n"):
            full = bool(SPACED.search(line))
            n += full
            if not (full and n in gone[d]):
                keep.append(line)
        out[d] = "\n".join(keep)
    return out


_PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    """["kind:start:end"] of the base rules."""
    out = []
    for kind, pattern in _PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            fits = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and _luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


_FULL = r"[^ \t\n\x0b\f\r]"


def _instances(text):
    """(start, end, context, value, touches a base span, base spans that start in it) of identifier-like tokens."""
    kinds = list(_PII)
    base = []
    for span in base_spans(text):
        kind, a, b = span.split(":")
        match = text[int(a) : int(b)]
        digits = re.sub("[^0-9]", "", match)
        value = {"email": match.lower(), "ip": match, "card": digits, "phone": "+" + digits}[kind]
        base.append((int(a), int(b), kinds.index(kind), value))
    out, last, before = [], 0, ""
    for m in re.finditer(rf"(?<!{_FULL}){_FULL}*[0-9@]{_FULL}*", text):
        words = re.findall(f"{_FULL}+", text[last : m.start()])
        lead = len(re.match(r"[\"'(\[{<]*", m[0])[0])
        body = re.sub(r"[.,;:!?\"')\]}>|#*$%&]+$", "", m[0][lead:])
        a, b = m.start() + lead, m.start() + lead + len(body)
        touch = any(x < b and a < y for x, y, _, _ in base)
        out.append((a, b, (words[-1] if words else before).lower(), body.lower(), touch, {(k, v) for x, y, k, v in base if a <= x < b}))
        last, before = m.end(), m[0]
    return out


def personal(docs, support=3, score=0.6, least=5):
    """[(doc_id, text)] -> {doc_id: ["kind:start:end"]}: base spans, and what trusted contexts lead to."""
    edges, trust, total = defaultdict(lambda: defaultdict(float)), {}, Counter()
    tokens = {d: _instances(t or "") for d, t in docs}
    for d, t in docs:
        total.update(re.split(r"[ \t\n\x0b\f\r]+", (t or "").lower()))
        for _, _, context, value, touch, seeds in tokens[d]:
            for kind, seed in seeds:
                edges[context][seed] += 1 / len(seeds)
                trust[seed] = (1.0, min(kind, trust.get(seed, (0, 9))[1]))
            if not touch and len(value) >= least:
                edges[context][value] += 1.0
    edges = {c: vs for c, vs in edges.items() if c and len(vs) >= support}
    while True:
        best = {}
        for c, vs in edges.items():
            mass, n = Counter(), 0
            for v, times in vs.items():
                if v in trust:
                    mass[trust[v][1]] += times * trust[v][0]
                    n += 1
            s = int(min(1.0, sum(mass.values()) / total[c]) * 1024) / 1024
            if n >= support and s >= score:
                lead = max((m, -k) for k, m in mass.items())[1]
                for v in vs:
                    best[v] = max(best.get(v, (0, 0)), (s, lead))
        new = {v: (max(s, trust[v][0]), trust[v][1]) if v in trust else (s, -k) for v, (s, k) in best.items()}
        if all(trust.get(v) == x for v, x in new.items()):
            break
        trust |= new
    out = {}
    for d, t in docs:
        kinds = list(_PII)
        spans = [(kinds.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in base_spans(t))]
        spans += [(trust[v][1], a, b) for a, b, _, v, touch, _ in tokens[d] if not touch and len(v) >= least and trust.get(v, (0,))[0] >= score]
        out[d] = [f"{kinds[k]}:{a}:{b}" for k, a, b in sorted(spans)]
    return out


_M = (1 << 64) - 1


def _spread(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & _M
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & _M
    return x ^ (x >> 31)


def _hash(data):
    return _spread(sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(data)) & _M)


def machine_score(text, base, weights, factors):
    """Factorization machine over {slot: weight} and {slot: [factor]}: every pair of the text's slots is added up."""
    lower = "".join(chr(ord(c) + 32) if 0xC0 <= ord(c) <= 0xDE and ord(c) != 0xD7 else c for c in lower_(text))
    slots = set()
    for word in ALNUM.findall(lower):
        data = word.encode()
        slots.add(_hash(data) >> 46)
        slots |= {_spread(_hash(data[:n]) + n & _M) >> 46 for n in range(4, 9) if len(data) >= n}
    known = sorted(slots & set(weights))
    z = base + sum(weights[s] for s in known)
    for i, a in enumerate(known):
        for b in known[:i]:
            z += sum(x * y for x, y in zip(factors[a], factors[b]))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def kept_lines_of_all_runs(docs, words=20):
    """{doc_id: lines with a word that stay}"""
    gone = later_lines(docs, words)
    return {d: [x for i, x in enumerate(x for x in (t or "").split("\n") if SPACED.search(x)) if i not in gone[d]] for d, t in docs}


def trie(convs):
    """{conv_id: [(role, text)]} -> {(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved, ends)} of all prefixes."""
    members, ends, children = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(str(c))
    out = {}
    for node, who in members.items():
        below = [x for x in members if x[: len(node)] == node]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        leaves = sum(1 for x in below if not children[x])
        parent = min(members[node[:-1]]) if node else None
        out[min(who), len(node)] = (parent, len(who), len(children[node]), leaves, saved, sha(ends[node]))
    return out


def clusters(vectors, k, rounds, seed="3"):
    """[(vec_id, [whole numbers])] -> {vec_id: (cluster, distance)} and the centroids; every centroid is measured."""
    centroids = [list(v) for _, _, v in sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), i, v) for i, v in vectors)[:k]]
    for r in range(rounds + 1):
        found = {i: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for i, v in vectors}
        if r < rounds:
            for n in range(len(centroids)):
                own = [v for i, v in vectors if found[i][1] == n]
                if own:
                    centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    return {i: (n, d) for i, (d, n) in found.items()}, centroids


def interleaved(rows, shards, seed=1):
    """[(doc_id, source)] -> {doc_id: (shard, slot)}"""
    unit = lambda text: int(hashlib.md5(text.encode()).hexdigest()[:13], 16)
    own = defaultdict(list)
    for i, source in rows:
        own[source].append((unit(f"{seed}:{i}"), i))
    order = []
    for source, found in own.items():
        phase = (unit(f"{seed}:{source or ''}") + 0.5) / 2**52
        order += [((r + phase) / len(found), source is not None, source or "", r, i) for r, (_, i) in enumerate(sorted(found))]
    out, used = {}, Counter()
    for n, row in enumerate(sorted(order)):
        shard = n * shards // len(order)
        out[row[-1]] = (shard, used[shard])
        used[shard] += 1
    return out
