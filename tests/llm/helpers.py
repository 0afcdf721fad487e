"""Fixtures of awkward documents and plain Python versions of what the operators compute."""

import hashlib
import re
import zlib
from collections import defaultdict

SMALL = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, ddl="doc_id long, text string"):
    return spark.createDataFrame(rows, ddl)


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_id(df, key="doc_id"):
    found = {}
    for row in df.collect():
        assert row[key] not in found, f"{key} {row[key]} twice"
        found[row[key]] = row
    return found


def documents(spark, sf_dir=SMALL):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(texts):
    """Component by document, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(i for i in sets if sets[i])
    links = []
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                links.append((a, b))
    return groups(links, sets), {i: len(s) for i, s in sets.items()}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def contamination(texts, items, window=10):
    """n_words, n_hit and the sorted items by document."""
    found = {}
    split = {i: words(t) for i, t in items.items()}
    for d, text in texts.items():
        own, hit, met = words(text), set(), set()
        places = defaultdict(list)
        for k in {min(window, len(w)) for w in split.values() if w}:
            for i in range(len(own) - k + 1):
                places[tuple(own[i : i + k])].append(i)
        for item, w in split.items():
            k = min(window, len(w))
            for i in range(len(w) - k + 1 if w else 0):
                for at in places.get(tuple(w[i : i + k]), ()):
                    hit.update(range(at, at + k))
                    met.add(item)
        found[d] = (len(own), len(hit), sorted(met, key=str))
    return found


def remove_lines(rows, window=3):
    """Remaining text by id, for rows (id, text) with distinct ids."""
    seen, left = set(), {}
    for doc_id, text in sorted(rows):
        if text is None:
            left[doc_id] = None
            continue
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - window + 1):
            key = tuple(lines[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        left[doc_id] = "\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text
    return left


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
