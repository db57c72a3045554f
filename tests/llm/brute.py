"""Plain versions of the operators' rules, for small inputs."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def shingles(text, n=5):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = WORD.findall(folded)
    if len(found) < n:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1))


def near_groups(rows, threshold):
    """(doc_id, text) rows -> list of (n_shingles, component id) in their order; linked by position."""
    sets = [shingles(t) for _, t in rows]
    groups = Sets()
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= threshold * (len(a) + len(sets[j]) - both) and sets[j]:
                groups.join(i, j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[groups.find(i)].append(doc_id)
    return [
        (len(s), (min(least[groups.find(i)], default=None) if s else rows[i][0])) for i, s in enumerate(sets)
    ]


def line_groups(rows, edits, least):
    """(doc_id, text) rows -> {(row, line): group} for lines with something in them."""
    lines = {(i, k): line for i, (_, t) in enumerate(rows) for k, line in enumerate((t or "").split("\n")) if re.search(r"[^ \t\n\x0b\f\r]", line)}
    long = sorted({x for x in lines.values() if len(x) >= least}, key=len)
    groups = Sets()
    for i, a in enumerate(long):
        for b in long[i + 1 :]:
            if len(b) - len(a) > edits:
                break
            if distance(a, b) <= edits:
                groups.join(a, b)
    return lines, {k: groups.find(x) for k, x in lines.items()}
