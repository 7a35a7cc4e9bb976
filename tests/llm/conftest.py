import collections
import re

import pytest


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


@pytest.fixture(scope="session")
def shingle_set():
    return shingles


@pytest.fixture(scope="session")
def brute_components():
    """{row: (set size, component)} of rows (doc_id, text) by comparing all pairs that share a shingle."""

    def run(rows, percent=80):
        sets = [shingles(t) for _, t in rows]
        holders = collections.defaultdict(list)
        for k, s in enumerate(sets):
            for x in s:
                holders[x].append(k)
        parent = list(range(len(rows)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for k, s in enumerate(sets):
            common = collections.Counter(j for x in s for j in holders[x] if j < k)
            for j, c in common.items():
                if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                    parent[find(k)] = find(j)
        least = {}
        for k, (doc, _) in enumerate(rows):
            least[find(k)] = min(least.get(find(k), doc), doc)
        return [(doc, len(sets[k]), least[find(k)]) for k, (doc, _) in enumerate(rows)]

    return run
