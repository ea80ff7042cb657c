"""Small documents with every awkward case, and brute-force twins."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOW = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def docs(spark, rows):
    """Documents from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], DOCS)


def prose(seed, n):
    rng = random.Random(seed)
    syllables = "an er on th re in the ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(w if rng.random() > share else "changed" + str(rng.randint(0, 9)) for w in text.split(" "))


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def word_shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def links(sets, percent=80):
    """All pairs of ids whose sets meet the threshold (prefix-filtered, exact)."""
    freq = Counter(x for s in sets.values() for x in s)
    seen, out = defaultdict(list), []
    for i in sorted(sets, key=lambda i: (len(sets[i]), str(i))):
        s = sets[i]
        if not s:
            continue
        order = sorted(s, key=lambda x: (freq[x], str(x)))
        near = set()
        for x in order[:len(s) - math.ceil(percent * len(s) / 100) + 1]:
            near.update(seen[x])
            seen[x].append(i)
        for j in near - {i}:
            k = len(s & sets[j])
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                out.append((i, j))
    return out
