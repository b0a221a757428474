"""Brute-force versions of the operators, and the rows that every operator must bear."""

import hashlib
import re
from collections import defaultdict

DATA = "/root/testdata"
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, window=10):
    """doc rows [(id, text)] -> [(id, n_words, hit positions, item ids)]."""
    wins = defaultdict(set)
    for name, text in items:
        w = LETTERS.findall(lower(text))
        if w:
            n = min(window, len(w))
            for k in range(len(w) - n + 1):
                wins[tuple(w[k : k + n])].add(name)
    sizes = {len(w) for w in wins}
    out = []
    for name, text in docs:
        w = LETTERS.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                ids = wins.get(tuple(w[k : k + n]))
                if ids:
                    hit.update(range(k, k + n))
                    found |= ids
        out.append((name, len(w), sorted(hit), {f for f in found if f is not None}))
    return out


def shingles(text, n=5):
    w = SPACED.findall(lower(text))
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def near_components(docs, percent=85):
    """[(id, text)] -> {id: (n_shingles, component)} by comparing all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    has = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            has[x].append(d)
    seen = set()
    for ids in has.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                if (a, b) in seen:
                    continue
                seen.add((a, b))
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((find(a), find(b)))
                    parent[high] = low
    return {d: (len(s), find(d)) for d, s in sets.items()}


def targets(sizes, weights=(3, 1, 2), epochs=1.5, most=2):
    """{source: words} -> {source: target}, resharing round by round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    goal, full = {}, set()
    while True:
        rest = epochs * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        goal = {s: most * sizes[s] for s in full} | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if goal[s] >= most * sizes[s]}
        if not over:
            return goal
        full |= over


#: null and empty texts, one word, white space, very long, repeated rows, a null id, other alphabets
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, "one"),
    (4, " \t\n\x0b\x0c\r "),
    (5, "a b c d e f g h i j k l m n o p"),
    (6, "a b c d e f g h i j k l m n o p"),
    (6, "a b c d e f g h i j k l m n o p"),
    (7, "x" * 3_000_000),
    (8, "lorem ipsum " * 120_000),
    (9, "Ünï çödé — 漢字 かな 🙂 \x00 \x85   end"),
    (None, "no id here at all"),
    (10, "one two three four\n\nfive six seven eight\r\nnine"),
]


def odd_documents(spark, extra=True):
    """ODD_TEXTS as documents, with columns whose names operators use themselves."""
    rows = [(d, t, "en", None if d == 3 else f"s{(d or 0) % 3}", len(t or "")) for d, t in ODD_TEXTS]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if extra:
        for c in ("score", "kept", "hit_words", "n_tokens", "size", "key", "list", "slot", "span", "label", "y"):
            df = df.selectExpr("*", f"'mine' AS {c}")
    return df


def empty_documents(spark):
    return odd_documents(spark, False).limit(0)
