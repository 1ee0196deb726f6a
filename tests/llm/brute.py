"""Plain Python versions of what the operators compute."""

import hashlib
import re
from collections import Counter

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(text):
    words = spaced((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def components(rows):
    """(id, n_shingles, component) for (id, text) rows, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[root(i)] = min(key, smallest.get(root(i), key))
    return [(key, len(sets[i]), smallest.get(root(i))) for i, (key, _) in enumerate(rows)]


def contamination(text, items, size=10):
    """n_words, n_hit and the items with occurring windows."""
    words, hit, found = plain(text), set(), set()
    for item, item_text in items:
        own = plain(item_text)
        k = min(size, len(own))
        if not k:
            continue
        windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                if item is not None:
                    found.add(item)
    return len(words), len(hit), found


def measures(text):
    words, text = spaced(text), text or ""
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)
