"""Brute-force versions that several tests compare with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    import xxhash

    words = [w.encode() for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """The smallest id of each row's component, by row number."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    return {i: min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(rows))}
