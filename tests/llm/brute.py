"""Plain Python versions of what the operators must return."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import xxhash

def words(text):
    return (text or "").encode().lower().split()


def fold(doc_id, k):
    return zlib.crc32(str(doc_id).encode()) % k


def fingerprint(text, k=3):
    w = words(text)
    if not w:
        return 0
    k = min(k, len(w))
    ones, n = [0] * 64, 0
    for i in range(len(w) - k + 1):
        h = xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42)
        n += 1
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > n)


def components(keys, prints, radius=2):
    """Smallest key of each row's component."""
    points = np.array(sorted(set(prints)), dtype=np.uint64)
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1:] ^ points[i]) <= radius):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    at = {int(p): find(i) for i, p in enumerate(points)}
    least = {}
    for key, p in zip(keys, prints, strict=True):
        least[at[p]] = min(least.get(at[p], key), key)
    return [least[at[p]] for p in prints]


def letters_and_digits(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def _bag(w, k=5):
    k = min(k, max(len(w), 1))
    return collections.Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def leaks(docs, items, least=0.8, k=5):
    """{(doc, item): best similarity} over all windows of an item's length."""
    out = {}
    for item, item_text in items:
        v = letters_and_digits(item_text)
        size = min(k, len(v))
        if not size:
            continue
        bag = collections.Counter(tuple(v[i:i + size]) for i in range(len(v) - size + 1))
        for doc, text in docs:
            w = letters_and_digits(text)
            runs = [tuple(w[i:i + size]) for i in range(len(w) - size + 1)]
            if not any(r in bag for r in runs):
                continue
            best, length = 0.0, len(v) - size + 1
            for at in range(max(1, len(runs) - length + 1)):
                got = collections.Counter(runs[at:at + length])
                both = sum((got & bag).values())
                best = max(best, both / (sum(got.values()) + sum(bag.values()) - both))
            if best >= least:
                out[doc, item] = best
    return out


def permuted(x, y, a, b, key, tweak, rounds=10):
    for i in range(rounds):
        digest = hashlib.sha256(f"{key}|{tweak}|{i}|{y}".encode()).hexdigest()
        x, y, a, b = y, (x + int(digest[:15], 16)) % a, b, a
    return x, y


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def suffix_tree(docs, least_count, least_gain, weight):
    """(scores, states by level) of (text, trained) rows: every context of every length, by plain
    dictionaries."""
    texts = [[*words(t), None] for t, _ in docs]  # None is the end
    trained = [t for t, (_, train) in zip(texts, docs, strict=True) if train]
    unigrams = collections.Counter(x for t in trained for x in t)
    total = sum(unigrams.values()) + len(unigrams) + 1
    states, levels = {}, []

    def chance(before, x):
        """P(x | longest state of what is before)."""
        p = (unigrams[x] + 1) / total
        for k in range(1, len(before) + 1):
            found = states.get(tuple(before[len(before) - k:]))
            if found is None:
                break
            n, w = sum(found.values()), weight * len(found)
            p = (found[x] + w * p) / (n + w)
        return p

    for k in range(1, max(map(len, texts), default=0)):
        followers = collections.defaultdict(collections.Counter)
        for t in trained:
            for i in range(k, len(t)):
                s = tuple(t[i - k:i])
                if k == 1 or s[1:] in states:
                    followers[s][t[i]] += 1
        passed = {}
        for s, c in followers.items():
            n, w = sum(c.values()), weight * len(c)
            if n >= least_count:
                gain = 0
                for x, m in c.items():
                    p = chance(s[1:], x)
                    gain += m * np.log((m - 1 + w * p) / (n - 1 + w) / p)
                if gain >= least_gain:
                    passed[s] = c
        if not passed:
            break
        states |= passed
        levels.append(len(passed))
    scores = [sum(np.log10(chance(t[:i], x)) for i, x in enumerate(t)) for t in texts]
    return scores, levels
