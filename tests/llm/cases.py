"""Small documents that hold the awkward cases, and plain definitions to compare with."""

import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{k} of a very long text" for k in range(4000))
BASE = " ".join(f"w{k}" for k in range(60))

# Nulls in every column, empty and blank texts, a long text, ties, repeated rows and repeated ids.
ROWS = [
    (1, BASE, "en", "a", len(BASE)),
    (2, BASE, "en", "b", len(BASE)),
    (2, BASE, "en", "b", len(BASE)),
    (3, BASE.replace("w30", "x"), None, "a", None),
    (4, BASE.upper(), "en", None, 1),
    (5, "", "en", "a", 0),
    (6, None, "de", "a", None),
    (7, "   \n\t ", "de", "b", 6),
    (8, "one two", "de", "b", 7),
    (9, "one two", "de", "b", 7),
    (10, LONG, "en", "a", len(LONG)),
    (11, LONG + " end", "en", "a", len(LONG) + 4),
    (12, "ÄÖÜ straße 中文 😀 don't we'll 123 " * 20, "de", "a", 0),
    (13, "other words here " * 30, "fr", "c", 0),
    (13, "entirely different words under the same id " * 5, "fr", "c", 0),
    (None, BASE, "en", "a", 0),
    (None, "a text that has no id and no copy anywhere else at all", None, None, None),
]


def documents(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, length):
    lowered = (text or "").translate({k: k + 32 for k in range(65, 91)})
    found = words(lowered)
    if len(found) < length:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + length]) for k in range(len(found) - length + 1)}


def components(rows, length, percent=80):
    """Smallest reachable id for every (id, text) row, by comparing all pairs."""
    sets = [shingles(text, length) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)].append(doc_id)
    own = [None if s else doc_id for (doc_id, _), s in zip(rows, sets, strict=True)]
    return [(len(s), min(ids[find(i)], default=None) if s else own[i]) for i, s in enumerate(sets)]
