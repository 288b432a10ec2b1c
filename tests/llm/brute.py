"""Plain versions of the contracts, one document or one pair at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact(rows):
    """[(doc_id, text)] -> {doc_id: (keep_id, group_size, kept, sha)} for distinct ids."""
    groups = defaultdict(list)
    for d, t in rows:
        groups[normal(t)].append(d)
    return {d: (min(ds), len(ds), d == min(ds), sha(n)) for n, ds in groups.items() for d in ds}


def rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return {"n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup,
            "n_repeat_words": len(covered), "base_failed": n < 50 or 100 * len(covered) > 50 * n}


def fingerprint(text):
    import xxhash

    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(fps):
    """[(doc_id, fp)] -> {doc_id: smallest id reachable}, comparing every pair."""
    root = {d: d for d, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(fps):
        for b, y in fps[:i]:
            if bin(x ^ y).count("1") <= 3:
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: find(d) for d, _ in fps}


KINDS = ["assign", "access", "hex"]


def secrets(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def spans_text(spans, kinds):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def h(*parts):
    return sha("".join(parts))


def merkle_leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def merkle_levels(hashes):
    """All levels of a tree, leaves first."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def merkle_path(levels, at):
    """(left, right) siblings from a leaf up, where there is a level above."""
    out = []
    for level in levels[:-1]:
        first = at // 16 * 16
        out.append(("".join(level[first:at]), "".join(level[at + 1 : first + 16])))
        at //= 16
    return out


def merkle(rows, fields=lambda r: r):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted list of result rows."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, merkle_leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = merkle_levels([x[2] for x in groups[name]])
    top = merkle_levels([trees[name][-1][0] for name in names])
    out = []
    for k, name in enumerate(names):
        for at, (_, _, leaf, r) in enumerate(groups[name]):
            path = merkle_path(trees[name], at) + merkle_path(top, k)
            folded = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                low = None if r[4] is None else re.sub("[A-Z]", lambda m: m[0].lower(), r[4])
                folded = merkle_leaf((*r[:4], low))
            for a, b in path:
                folded = h(a, folded, b)
            root = top[-1][0]
            out.append((r[0], leaf, trees[name][-1][0], root, h(*[a + b for a, b in path]), folded, folded == root))
    return sorted(out, key=str)


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else (a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :])


def noisy_words(rows):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            x = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run[: x % len(run)] + run[x % len(run) + 1 :] if x % 31 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def variants(n, ratio=10):
    """{word: n} -> {word: (form, root, n, n_near, form_n)}, comparing every pair."""
    near = defaultdict(list)
    by_size = defaultdict(list)
    for w in n:
        by_size[len(w)].append(w)
    for size, words in by_size.items():
        for i, a in enumerate(words):
            for b in [*words[:i], *by_size.get(size - 1, [])]:
                if one_edit(a, b):
                    near[a].append(b)
                    near[b].append(a)
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= ratio * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def mixture(rows, weights=(1, 2, 3), epochs=3, seed="mix"):
    """rows: (doc_id, source, text) -> sorted [(doc_id, size, source_size, target, taken)]; ties of (id, size) are alike."""
    docs = [(d, s, len(WORD.findall(t or ""))) for d, s, t in rows]
    size = Counter()
    for _, s, k in docs:
        size[s] += k
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = sum(size.values()), set()
    while True:
        free = [s for s in names if s not in full]
        if not free:
            break
        level = (budget - sum(epochs * size[s] for s in full)) / sum(weight[s] for s in free)
        more = {s for s in free if level * weight[s] > epochs * size[s]}
        if not more:
            break
        full |= more
    target = {s: float(epochs * size[s]) if s in full else level * weight[s] for s in names}
    queue, taken = [], [0] * len(docs)
    for s in names:
        ids = lambda i: "" if docs[i][0] is None else str(docs[i][0])
        order = sorted((hashlib.md5(f"{seed}:{ids(i)}".encode()).hexdigest(), ids(i), docs[i][2], i) for i in range(len(docs)) if docs[i][1] == s and docs[i][2])
        sent = 0
        for epoch in range(epochs):
            for digest, d, k, i in order:
                sent += k
                queue.append((sent / target[s], s is None, s or "", epoch, digest, d, k, i))
    left = budget
    for *_, k, i in sorted(queue):
        taken[i] += min(k, left)
        left -= min(k, left)
    return sorted(((d, k, size[s], target[s], taken[i]) for i, (d, s, k) in enumerate(docs)), key=str)
