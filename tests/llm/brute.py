"""Plain definitions that the operators are held against."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = (int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [
        f"{k}:{m.start()}:{m.end()}" for k, p in KINDS.items() for m in re.finditer(p, text or "") if valid(k, m.group())
    ]


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_groups(docs):
    """id -> (number of shingles, smallest id reachable)."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def removed(docs, least=50):
    """id -> numbers of the lines in a run of `least` words or more that comes earlier, by trying every run."""
    lines = {i: [(n, x, len(WORD.findall(x))) for n, x in enumerate((t or "").split("\n")) if WORD.search(x)] for i, t in docs}
    first, gone = {}, {}
    for i, _ in docs:
        own = lines[i]
        for a in range(len(own)):
            words = 0
            for b in range(a, min(len(own), a + 120)):
                words += own[b][2]
                if words >= least:
                    key = tuple(x[1] for x in own[a : b + 1])
                    if first.setdefault(key, (i, a)) != (i, a):
                        gone.setdefault(i, set()).update(x[0] for x in own[a : b + 1])
    return gone


def quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    uses = Counter(windows)
    repeat = {i + j for i, w in enumerate(windows) if uses[w] > 1 for j in range(3)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeat)


def greedy_tiles(doc, item, k):
    """Tiles (word in the document, word in the item, words) by trying every pair of places for each of them."""
    free_doc, free_item, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        best = (k - 1, 0, 0)
        for a in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while a + n < len(item) and p + n < len(doc) and doc[p + n] == item[a + n] and free_doc[p + n] and free_item[a + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, p)
        n, a, p = best
        if n < k:
            return tiles
        tiles.append((p, a, n))
        free_doc[p : p + n] = free_item[a : a + n] = [False] * n
