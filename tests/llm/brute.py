"""Plain versions of the operators, for comparison on small tables."""

import re
from functools import lru_cache

import xxhash


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingle_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return 0
    n = max(1, len(words) - 3)
    return majority([xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(n)], 64)


def majority(hashes, bits):
    return sum(1 << b for b in range(bits) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@lru_cache(maxsize=100_000)
def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def normalised_line(line):
    return re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", line.lower()).strip(" ")


def line_fingerprint(norm):
    return majority([xxhash.xxh64_intdigest(w.encode(), 42) & (1 << 60) - 1 for w in set(norm.split(" "))], 60)


def deduplicated(docs, least_words=5, bits=3, similarity=0.8):
    """{doc id: text} of distinct documents (id, text) after line deduplication; ids are unique."""
    lines = {}
    for doc, text in docs:
        for number, line in enumerate((text or "").split("\n") if text is not None else []):
            norm = normalised_line(line)
            if norm and len(norm.split(" ")) >= least_words:
                lines[(doc, number)] = norm
    first = {}
    for at in sorted(lines):
        first.setdefault(lines[at], at)
    marks = {norm: line_fingerprint(norm) for norm in first}
    groups = Groups(first.values())
    names = list(first)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            longest = max(len(a), len(b))
            if (marks[a] ^ marks[b]).bit_count() <= bits and edit_distance(a, b) <= int((1 - similarity) * longest + 1e-9):
                groups.join(first[a], first[b])
    out = {}
    for doc, text in docs:
        if text is None:
            out[doc] = None
            continue
        kept = [
            line
            for number, line in enumerate(text.split("\n"))
            if (doc, number) not in lines or groups.root(first[lines[(doc, number)]]) == (doc, number)
        ]
        out[doc] = "\n".join(kept)
    return out
