"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, n):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1)))


def near_groups(texts: dict, n: int, percent: int = 80) -> dict:
    """Smallest id that each id reaches, comparing all pairs."""
    sets = {i: shingle_set(t, n) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def repetition(text, min_repeat=8):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered, longest)"""
    w = words(text)
    text = text or ""
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    covered, longest = set(), 0
    for i in range(len(w)):
        for j in range(i + 1, len(w)):
            n = 0
            while j + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            if n >= min_repeat:
                longest = max(longest, n)
                covered |= {*range(i, i + n), *range(j, j + n)}
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i : i + 3])].append(i)
    repeated = {p + k for places in windows.values() if len(places) > 1 for p in places for k in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, copies, len(repeated), len(covered), longest


def base_spans(text):
    """Spans of the fixed secret patterns, joined."""
    out = []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text or ""):
        if len(m.group(2)) >= 12:
            out.append((m.start(), 0, m.end(), "assign"))
    for order, kind, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 18), (2, "hex", r"[0-9a-f]+", 16)):
        for m in re.finditer(pattern, text or ""):
            if m.end() - m.start() >= least:
                out.append((m.start(), order, m.end(), kind))
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(out))


def targets(sizes: dict, weights=(5, 2, 1), limit=3) -> dict:
    """Targets of sources, None last, by sharing the excess again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(sizes.values())
    target, open_, left = dict.fromkeys(order, 0.0), set(order), float(total)
    while open_ and left > 1e-9 * max(total, 1):
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += share[s]
            if target[s] >= limit * sizes[s]:
                left += target[s] - limit * sizes[s]
                target[s] = float(limit * sizes[s])
                open_.discard(s)
    return target


def edit_distance_in(pattern: str, text: str) -> int:
    """Smallest edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def fold(text):
    return "".join(c.lower() for c in text or "" if c.isalnum())


def alignment(texts: list, a, b, bytes_a: list, bytes_b: list) -> list:
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups), by walking through the tokens of both libraries."""
    import hashlib
    from collections import Counter

    found = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        if b"".join(bytes_a[i] for i in ids_a) != whole or b"".join(bytes_b[i] for i in ids_b) != whole:
            found.append(([], [], [], []))
            continue
        ends, at = {}, 0
        for i, t in enumerate(ids_a):
            at += len(bytes_a[t])
            ends[at] = i
        groups, links, at, i, j = [], [], 0, 0, 0
        for k, t in enumerate(ids_b):
            at += len(bytes_b[t])
            if at in ends:
                last = ends[at]
                groups.append(",".join(map(str, ids_a[i : last + 1])) + "|" + ",".join(map(str, ids_b[j : k + 1])))
                links.append((ids_a[last], t))
                i, j = last + 1, k + 1
        found.append((ids_a, ids_b, groups, links))
    counts = Counter(link for f in found for link in f[3])
    best = defaultdict(int)
    for (_, t), n in counts.items():
        best[t] = max(best[t], n)
    return [
        (len(x), len(y), len(g), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
         hashlib.sha256(";".join(g).encode()).hexdigest() if x else "")
        for x, y, g, links in found
    ]


def runs(w: list) -> list:
    """(start, length, period) of the stretches with at least four periods and six words, by start and period."""
    n, smallest = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                smallest.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in smallest.items())


def collapsed(w: list, found: list) -> str:
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def with_repeats(w: list, doc_id) -> list:
    import zlib

    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def repeated_bytes(texts: list, size: int = 400) -> list:
    """Per text the bytes that are left without what is covered by strings of ``size`` that start twice, and the spans that go."""
    raws = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for r in raws:
        for i in range(len(r) - size + 1):
            seen[r[i : i + size]] += 1
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - size + 1):
            if seen[r[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = re.finditer(b"\1+", bytes(gone))
        out.append((bytes(b for b, g in zip(r, gone) if not g), [m.span() for m in spans]))
    return out
