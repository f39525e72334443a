"""Brute-force versions that several test files use."""

import re

BLANK = re.compile("[\x20\x09-\x0d]+")


def split(text):
    return [w for w in BLANK.split(text or "") if w]


def classes(rows):
    """(set size, smallest linked id) of each document, by comparing all pairs."""
    sets = {}
    for d, t in rows:
        w = split(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    leader = {d: d for d in sets}

    def find(d):
        while leader[d] != d:
            d = leader[d]
        return d
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                leader[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def pattern_spans(text):
    """(start, kind, end) of the exact patterns' valid matches."""
    out = []
    for k, (_, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (k == 0 or k == 1 and all(int(p) <= 255 for p in m.group().split("."))
                    or k == 2 and 14 <= len(digits) <= 19 and luhn(digits) or k == 3 and 10 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)
