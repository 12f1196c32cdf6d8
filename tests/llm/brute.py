"""Plain Python versions of what SQL cannot express."""

import hashlib
import math
import re
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text):
    w = words(text)
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def near_components(docs):
    """[(doc_id, n_shingles, component)] of [(doc_id, text)]."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in where[x])
        for j, both in shared.items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
        for x in s:
            where[x].append(i)
    least = {}
    for i, (k, _) in enumerate(docs):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [(k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(docs, sets))]


def removed_lines(docs, threshold, least):
    """{doc_id: [line]} of [(doc_id, text)] with different ids, in order of id."""
    kept, where, first, out = [], defaultdict(list), {}, {}
    for k, text in sorted(docs):
        out[k] = []
        for i, line in enumerate((text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")):
            s = frozenset(line.split())
            if len(s) < least:
                continue
            if s in first:
                out[k].append(i)
                continue
            shared = Counter(j for w in s for j in where[w])
            near = any(o >= threshold * (len(s) + len(kept[j]) - o) - 1e-9 for j, o in shared.items())
            for w in s:
                where[w].append(len(kept))
            kept.append(s)
            first[s] = near
            if near:
                out[k].append(i)
    return out


def bm25(docs, query, k, k1=1.2, b=0.75):
    """[(score, doc_id)] of the best k."""
    counts = {d: Counter(words(t)) for d, t in docs}
    size = {d: sum(c.values()) for d, c in counts.items()}
    average, n = sum(size.values()) / len(size), len(docs)
    score = Counter()
    for w in set(words(query)):
        df = sum(w in c for c in counts.values())
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        for d, c in counts.items():
            if w in c:
                score[d] += idf * c[w] * (k1 + 1) / (c[w] + k1 * (1 - b + b * size[d] / average))
    return sorted((-round(s, 6), d) for d, s in score.items())[:k]


RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _fits(kind, x):
    digits = re.sub("[^0-9]", "", x)
    if kind == "ip":
        return all(int(p) <= 255 for p in x.split("."))
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(v - 9 if v > 9 else v for v in twice) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, r) in enumerate(RULES.items())
             for m in re.finditer(r, text or "") if _fits(kind, m.group())]
    joined = ",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in sorted(found))
    return joined, hashlib.sha256(joined.encode()).hexdigest()


def best_fit_bins(lengths, capacity):
    """The number of sequences of best-fit decreasing, one document at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def least_capacity(sizes, shards):
    """Smallest capacity of contiguous shards by dynamic programming."""
    total = [0]
    for s in sizes:
        total.append(total[-1] + s)
    best = [0] + [math.inf] * len(sizes)
    for _ in range(shards):
        best = [0] + [min(max(best[i], total[j] - total[i]) for i in range(j)) for j in range(1, len(total))]
    return best[-1]
