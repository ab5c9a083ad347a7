"""Plain versions of the operators, for small inputs."""

import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class Union:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, width):
    w = SPACE.findall(lower(text))
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def near(docs, width, percent=80):
    """{id: (size, component)}"""
    sets = {i: shingles(t, width) for i, t in docs.items()}
    u, ids = Union(docs), sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                u.join(a, b)
    return {i: (len(sets[i]), u.find(i)) for i in ids}


def repeats(docs, window):
    """{id: (words, kept words)}"""
    first, out = {}, {}
    for i in sorted(docs):
        w = SPACE.findall(docs[i] or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first.setdefault(tuple(w[k : k + window]), i) < i:
                gone[k : k + window] = [True] * window
        out[i] = (w, [x for x, g in zip(w, gone) if not g])
    return out
