"""Plain Python versions of the operators, for small inputs."""

import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def removed(rows, k):
    """Per row (id, text): its words and which are covered by a window of k words that also starts
    in a row with a smaller id (None is smallest)."""
    key = lambda i: -(2**63) if i is None else i
    split = [(key(i), WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for p in range(len(w) - k + 1):
            x = tuple(w[p : p + k])
            first[x] = min(first.get(x, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            if first[tuple(w[p : p + k])] < i:
                gone[p : p + k] = [True] * k
        out.append((w, gone))
    return out


def fingerprint(text, k=4):
    w = WORD.findall(lower(text))
    if not w:
        return 0
    shingles = [" ".join(w[p : p + k]) for p in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, bits):
    """Smallest position reachable over links of at most ``bits`` differing bits."""
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def contamination(rows, items, k=13):
    """Per row: words, hit words, ids of the items with an occurring window."""
    windows = {}
    for i, t in items:
        w = ALNUM.findall(lower(t))
        for p in range(max(1, len(w) - k + 1) if w else 0):
            windows.setdefault(tuple(w[p : p + k]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    out = []
    for _, t in rows:
        w = ALNUM.findall(lower(t))
        hit, found = [False] * len(w), set()
        for p in range(len(w)):
            for n in sizes:
                if p + n <= len(w) and (who := windows.get(tuple(w[p : p + n]))):
                    found |= who
                    hit[p : p + n] = [True] * n
        out.append((len(w), sum(hit), found))
    return out
