"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
STRIP = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SECRET = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text: str) -> int:
    return zlib.crc32((text or "").encode())


def line_dedup(rows, min_docs=10, min_chars=1):
    """(id, text) rows to (id, n_lines, n_dropped, kept)."""
    def key(line):
        return line.strip(STRIP).translate(LOWER)

    seen = Counter()
    for _, t in rows:
        seen.update({key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if seen[key(x)] < min_docs or len(key(x)) < min_chars]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def secrets(text: str):
    """Base spans (kind, start, end) by start, then kind."""
    spans = []
    for order, (kind, pattern, group, least) in enumerate(SECRET):
        spans += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "")
                  if len(m.group(group)) >= least]
    return [(k, a, b) for a, _, k, b in sorted(spans)]


def quality(text: str):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 5)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def shingles(text: str, k=5):
    w = WORD.findall(text or "")
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_classes(rows, threshold=0.8):
    """(id, text) rows to {id: least id of its component} by comparing all texts that share a window."""
    sets = {}
    for i, t in rows:
        s = shingles(t)
        sets.setdefault(s, []).append(i)
    keys = [s for s in sets if s]
    at = defaultdict(list)
    root = list(range(len(keys)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for n, s in enumerate(keys):
        common = Counter(m for g in s for m in at[g])
        for m, c in common.items():
            if c / (len(s) + len(keys[m]) - c) >= threshold - 1e-12:
                root[find(n)] = find(m)
        for g in s:
            at[g].append(n)
    least = {}
    for n, s in enumerate(keys):
        r = find(n)
        least[r] = min([least.get(r, math.inf), *sets[s]])
    out = {i: least[find(n)] for n, s in enumerate(keys) for i in sets[s]}
    out.update({i: i for i in sets.get(frozenset(), [])})
    return out


def targets(sizes: dict, top=3):
    """{source: words} to {source: target}."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, goal, free = sum(sizes.values()), {}, list(names)
    left = total
    while free:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * share >= top * sizes[s]]
        if not over:
            goal.update({s: weight[s] * share for s in free})
            break
        for s in over:
            goal[s] = float(top * sizes[s])
            left -= goal[s]
            free.remove(s)
    return goal


def smith_waterman(a, b):
    """Best local score; match 1, mismatch and gap -1."""
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (1 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row, best = new, max(best, max(new))
    return best


def folded(text: str):
    """Words as decontamination reads them."""
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").translate(LOWER))


def quality_em(patterns, n_rules, rounds=30, noise=0.005):
    """{votes: n} to {votes: probability of good}: class 0 good, class k the junk of rule k - 1."""
    total = sum(patterns.values())
    start = [[(noise, 0.8)] * n_rules] + [[(0.8, 0.1) if r == k else (0.2, 0.4) for r in range(n_rules)]
                                          for k in range(n_rules)]
    share, rates = [0.8] + [0.2 / n_rules] * n_rules, start

    def posterior(votes):
        like = [s * math.prod(m[r][0] if v < 0 else m[r][1] for r, v in enumerate(votes) if v)
                for s, m in zip(share, rates)]
        return [x / sum(like) for x in like]

    for _ in range(rounds):
        p = {v: posterior(v) for v in patterns}
        held = [sum(n * p[v][c] for v, n in patterns.items()) for c in range(n_rules + 1)]
        new = []
        for c in range(n_rules + 1):
            prior = total + 1 if c == 0 else 1
            against, for_ = ([sum(n * p[v][c] for v, n in patterns.items() if v[r] == side) for r in range(n_rules)]
                             for side in (-1, 1))
            new.append([((against[r] + prior * start[c][r][0]) / (held[c] + prior),
                         (for_[r] + start[c][r][1]) / (held[c] + 1)) for r in range(n_rules)])
        share, rates = [(h + 1) / (total + n_rules + 1) for h in held], new
    return {v: posterior(v)[0] for v in patterns}


def licence_hits(rows, every, header, stop, threshold=0.7, file_share=0.5):
    """(id, path, text) rows to {id: (own licence, score, is a licence file, licence, found in)}: all units of all
    texts against all templates."""
    split = lambda t: re.findall("[a-z0-9]+", t.lower())
    df, n = Counter(), len(rows)
    for _, _, t in rows:
        df.update(set(split(t or "")))
    vocabulary = {t for _, text in every for t in split(text)}
    idf = lambda t: math.log((1 + n) / (1 + (df[t] if t in vocabulary else 0))) + 1
    vector = lambda text: {t: c * idf(t) for t, c in Counter(split(text)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    vectors = [(name, v, norm(v)) for name, v in ((name, vector(text)) for name, text in every)]

    def best(text):
        u = vector(text)
        if not u:
            return 0.0, None
        scores = [sum(x * v.get(t, 0.0) for t, x in u.items()) / norm(u) / vn for _, v, vn in vectors]
        at = max(range(len(scores)), key=lambda i: (round(scores[i], 12), -i))
        return scores[at], vectors[at][0]

    def pieces(text):
        parts = re.split(stop, text)
        return [text, *parts] if len(parts) > 1 else [text]

    files = {}
    for i, path, text in rows:
        text, found, words = text or "", [], 0
        m = re.search(header, text)
        groups = [(-2, [text]), (-1, pieces(m.group(0) if m else "")), *enumerate(map(pieces, text.split("\n")))]
        for line, units in groups:
            hits = [(k, *best(u), len(WORD.findall(u))) for k, u in enumerate(units)]
            hits = [h for h in hits if h[1] >= threshold - 1e-9]
            found += [(round(score, 9), -line, -k, name) for k, score, name, _ in hits]
            if line >= 0 and hits:
                words += max(sum(w for k, _, _, w in hits if k), max([0] + [w for k, _, _, w in hits if not k]))
        top = max(found, default=(None, None, None, None))
        total = len(WORD.findall(text))
        speaks = any(f[1] == 2 for f in found) or (bool(found) and words > 0 and words >= file_share * total)
        files[i] = (path, top[3], top[0], speaks)
    spoken = {}
    for i, (path, own, score, speaks) in files.items():
        if speaks:
            folder = path.rpartition("/")[0]
            spoken[folder] = max(spoken.get(folder, (-1, 0, "")), (score, -i, own))
    out = {}
    for i, (path, own, score, speaks) in files.items():
        up, found = path.rpartition("/")[0], "file" if own else None
        while not own and found is None:
            if up in spoken:
                own, found = spoken[up][2], up
            elif not up:
                break
            up = up.rpartition("/")[0]
        out[i] = (files[i][1], score, speaks, own, found)
    return out
