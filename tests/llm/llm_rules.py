"""Plain versions of the operators' rules, for small fixtures."""

import hashlib
import heapq
import math
import re
import zlib
from collections import Counter
from itertools import permutations

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) >= 5:
        return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    return frozenset([tuple(words)] if words else [])


def components(rows):
    """[(id, text)] -> {id: (set size, smallest id reachable)}."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_secrets(text):
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    order = ("assign", "access", "hex")
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def repeated_bytes(texts, length):
    """Per text: (bytes, removed, runs, sha256 of the rest)."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                covered[i:i + length] = b"\1" * length
        runs = sum(1 for j in range(len(b)) if covered[j] and (j == 0 or not covered[j - 1]))
        rest = bytes(x for x, c in zip(b, covered) if not c)
        out.append((len(b), sum(covered), runs, hashlib.sha256(rest).hexdigest()))
    return out


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items, window=10):
    """{doc: (words, hit words, items found)}."""
    windows = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOW))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i:i + n]), set()).add(item)
    out = {}
    for doc, text in docs:
        words, hit, found = WORD.findall((text or "").translate(LOW)), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i:i + n])]
        out[doc] = (len(words), hit, found)
    return out


def repair_cost(roles, merge=1.0, insert=2.0, relabel=3.0, unknown=1.0):
    """Cheapest repair of a role sequence, by Dijkstra's algorithm."""
    following = {"start": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]}
    queue, done = [(0.0, 0, "start")], set()
    while queue:
        cost, at, state = heapq.heappop(queue)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(roles) and state in ("start", "assistant"):
            return cost

        def change(role):
            given = roles[at]
            return 0.0 if given == role else relabel if given in following and given != "start" else unknown

        for role in following[state]:
            heapq.heappush(queue, (cost + insert, at, role))
            if at < len(roles):
                heapq.heappush(queue, (cost + change(role), at + 1, role))
        if at < len(roles) and state != "start":
            heapq.heappush(queue, (cost + change(state) + merge, at + 1, state))
    return None


def filter_steps(rows, labels):
    """[(id, text, lang)], [(id, quality, toxic)] -> {(part, order, step): counts}, by applying every order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    docs = []
    for i, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {c for c, f in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            re.search(r"[#$%&*|]", text), i is not None and i > first[text])) if f}
        docs.append((lang or "", fails, i in good, i in bad))
    out, shares = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            for step, c in enumerate(order, 1):
                gone = [d for d in left if c in d[1]]
                earlier = [d for d in docs if d[0] == part and c in d[1] and d[1] & set(order[:step - 1])]
                left = [d for d in left if c not in d[1]]
                shares[part, c] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(earlier), sum(d[0] == part and d[1] == {c} for d in docs),
                                                   sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def trie_nodes(convs):
    """{id: [(role, text)]} -> {(smallest member, depth): (parent, members, children, leaves, saved, sha256 of the ends)}."""
    nodes = {}
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            nodes.setdefault(tuple(convs[c][:d]), []).append(c)
    out = {}
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        leaves = sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below) for p in below)
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in members if len(convs[c]) == len(path))
        out[members[0], len(path)] = (nodes[path[:-1]][0] if path else None, len(members), sum(len(p) == len(path) + 1 for p in below),
                                      leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def rebuilt(rows):
    """[(conv, turn, role, text)] of distinct turns -> {conv: rebuilt turns}."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - int(math.fmod(c, 100)), [])[:h[c]] + own[c][h[c]:] for c in own}
