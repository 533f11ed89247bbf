"""Plain versions of the operators, a few lines each and far too slow for real tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


class Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def smallest(ids):
    real = [i for i in ids if i is not None]
    return min(real) if real else None


def shingles(text, k=4):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def near_groups(docs, percent=85, k=4):
    """[(doc_id, n_shingles, component_id)] of (doc_id, text) rows."""
    sets = [shingles(t, k) for _, t in docs]
    comp = Sets(len(docs))
    having = defaultdict(list)
    for n, s in enumerate(sets):
        for m, both in Counter(m for x in s for m in having[x]).items():
            if 100 * both >= percent * (len(s) + len(sets[m]) - both):
                comp.join(n, m)
        for x in s:
            having[x].append(n)
    members = defaultdict(list)
    for n in range(len(docs)):
        members[comp.find(n)].append(docs[n][0])
    return [(i, len(s), smallest(members[comp.find(n)]) if s else i) for n, ((i, _), s) in enumerate(zip(docs, sets))]


def repeats(docs, length=100):
    """[(doc_id, n_bytes, n_removed, n_spans, kept bytes)] in the order given."""
    seen, out = set(), []
    for i, t in docs:
        b = (t or "").encode()
        mark = bytearray(len(b))
        for s in range(len(b) - length + 1):
            x = b[s:s + length]
            if x in seen:
                mark[s:s + length] = b"\x01" * length
            else:
                seen.add(x)
        kept = bytes(c for c, m in zip(b, mark) if not m)
        out.append((i, len(b), sum(mark), len(re.findall(b"\x01+", bytes(mark))), kept))
    return out


def sha(b):
    return hashlib.sha256(b).hexdigest()


def vector_links(rows, cosine=0.98):
    """[(vec_id, n_links, component_id)] of (vec_id, embedding, label) rows."""
    def good(e, label):
        return label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
    comp, links = Sets(len(rows)), [0] * len(rows)
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if good(a, la) and good(b, lb) and la == lb and len(a) == len(b):
                c = sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))
                if c >= cosine:
                    comp.join(i, j)
                    links[i] += 1
                    links[j] += 1
    members = defaultdict(list)
    for i, r in enumerate(rows):
        members[comp.find(i)].append(r[0])
    return [(r[0], links[i], smallest(members[comp.find(i)])) for i, r in enumerate(rows)]


def base_rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    three = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if three[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def reshared(sizes, cap=3):
    """Targets of sources by resharing what is above the caps until none is."""
    names = sorted(sizes, key=lambda x: (x is None, x))
    weight, total, fixed = {n: (1, 2, 3)[i % 3] for i, n in enumerate(names)}, sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in fixed]
        part = {n: (total - sum(fixed.values())) * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if part[n] > cap * sizes[n]]
        if not over:
            return {**fixed, **part}
        fixed |= {n: float(cap * sizes[n]) for n in over}
