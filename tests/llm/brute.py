"""Brute-force versions of the corpus queries, in plain Python, and the small documents they are held against."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def near(rows, k, percent):
    """doc_id -> (shingles, component, kept)."""
    sets = {}
    for d, x in rows:
        w = WORD.findall(lower(x))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def passages(rows, k=13):
    """doc_id -> (words, removed words, hash of the kept words)."""
    seen, out = {}, {}
    for d, x in sorted(rows):
        w = WORD.findall(x or "")
        gone, mine = [False] * len(w), set()
        for a in range(len(w) - k + 1):
            g = tuple(w[a:a + k])
            if g in seen:
                gone[a:a + k] = [True] * k
            else:
                mine.add(g)
        for g in mine:
            seen[g] = d
        out[d] = (len(w), sum(gone), sha(" ".join(a for a, b in zip(w, gone) if not b)))
    return out


def byte_repeats(rows, k=100):
    """doc_id -> (bytes, removed bytes, removed runs, hash of the rest)."""
    seen, out = set(), {}
    for d, x in sorted(rows):
        t = (x or "").encode()
        gone = bytearray(len(t))
        for a in range(len(t) - k + 1):
            if t[a:a + k] in seen:
                gone[a:a + k] = b"\1" * k
            else:
                seen.add(t[a:a + k])
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[d] = (len(t), sum(gone), spans, sha(bytes(c for c, g in zip(t, gone) if not g)))
    return out


def base_scores(rows):
    """doc_id -> (held_out, tokens, known, training tokens, base score)."""
    tokens = {d: WORD.findall(lower(x)) + [None] for d, x in rows}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    count = Counter(t for d in tokens if not held[d] for t in tokens[d])
    n, v = sum(count.values()), len(count)
    return {d: (held[d], len(t), sum(count[w] > 0 for w in t), n,
                sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t)) for d, t in tokens.items()}


def pair_scores(rows):
    """doc_id -> log10 of the Witten-Bell probability of the text, from exact counts."""
    tokens = {d: WORD.findall(lower(x)) + [None] for d, x in rows}
    train = [t for d, t in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    pair = Counter(p for t in train for p in zip(["<begin>", *t[:-1]], t))
    context, follow = Counter(), Counter()
    for (v, _), c in pair.items():
        context[v] += c
        follow[v] += 1
    n, size = sum(count.values()), len(count)
    out = {}
    for d, t in tokens.items():
        out[d] = 0.0
        for v, w in zip(["<begin>", *t[:-1]], t):
            p = (count[w] + 1) / (n + size + 1)
            if context[v]:
                p = (pair[v, w] + follow[v] * p) / (context[v] + follow[v])
            out[d] += math.log10(p)
    return out


def rules(text):
    """(words, word_chars, symbols, dup lines, repeat words, base_failed)."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            hit.update(range(i, i + 5))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            len(w) < 10 or 100 * len(hit) > 20 * len(w))


def item_words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", lower(text))


def leaks(rows, items, similarity=0.8):
    """(doc_id, item_id) -> (start word, words, similarity) of the best window."""
    out = {}
    for d, x in rows:
        w = item_words(x)
        for i, y in items:
            t = item_words(y)
            m, k = len(t), min(5, len(t))
            if not m:
                continue
            want = Counter(tuple(t[a:a + k]) for a in range(m - k + 1))
            size = min(m, len(w))  # a shorter document is one window
            for s in range(len(w) - size + 1 if size >= k else 0):
                have = Counter(tuple(w[a:a + k]) for a in range(s, s + size - k + 1))
                low = sum((want & have).values())
                sim = low / (m - k + 1 + size - k + 1 - low)
                if sim >= similarity and ((d, i) not in out or (-sim, s) < (-out[d, i][2], out[d, i][0])):
                    out[d, i] = (s, size, sim)
    return out


def corpus(n=60, seed=3):
    """Documents with copies, edited copies, shared passages and lines, and the odd cases."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and"] * 6 + ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 8))) for _ in range(300)]

    def prose(words):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(words))

    passage, line = prose(40), "This line is in many documents of the corpus."
    out = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one two"), (5, "one two"), (6, "a " * 300),
           (7, "a " * 90), (8, "x" * 500), (9, prose(3000))]
    for d in range(10, n):
        kind = d % 6
        if kind == 0:
            text = prose(rng.randint(1, 150))
        elif kind == 1:
            text = prose(30) + " " + passage + " " + prose(20)
        elif kind == 2:
            text = prose(20) + "\n" + line + "\n" + prose(10) + "\n  " + line.upper() + " \n"
        elif kind == 3:
            text = rng.choice(out[10:] or out)[1] or prose(12)
        else:
            w = (rng.choice(out[10:] or out)[1] or prose(60)).split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            text = " ".join(w)
        out.append((d, text))
    return out
