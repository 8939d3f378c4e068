"""Plain Python versions and fixtures' data for the operators' tests."""

import re

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingles(text, k=5):
    w = WORDS.findall(ascii_lower(text or ""))
    return frozenset(zip(*[w[i:] for i in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])


def alike(a, b, percent=80):
    both = len(a & b)
    return bool(a and b) and 100 * both >= percent * (len(a) + len(b) - both)


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one two"), (6, "A b c d e f g"),
           (7, "a B c d e f g"), (8, "x " * 30_000), (9, "é\U0001d11e  z\n\nend  "), (10, "</s> ~0 <s>[SEP]")]
