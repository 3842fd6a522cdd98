"""Plain Python versions of the corpus operators, written from their contracts."""

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def bench_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def fingerprint(text, width=3):
    w = words((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    hashed = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def components(prints, bits=2):
    """Least id per id, from fingerprints by id."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    values = np.array([prints[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values[:k] ^ values[k]) <= bits):
            a, b = find(i), find(ids[j])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def contamination(text, items, width=13):
    """(words, hit words, item names) of a text; items are (id, text)."""
    w = bench_words(text)
    hit, names = [False] * len(w), set()
    for item, item_text in items:
        v = bench_words(item_text)
        for i in range(max(1, len(v) - width + 1) if v else 0):
            window = v[i : i + width]
            for k in range(len(w) - len(window) + 1):
                if w[k : k + len(window)] == window:
                    hit[k : k + len(window)] = [True] * len(window)
                    names.add("" if item is None else str(item))
    return len(w), sum(hit), sorted(names)


def shared_lines(docs, least=10):
    """{id: (lines, dropped, kept text)} for {id: text}."""
    blanks = " \t\n\x0b\x0c\r"
    key = lambda line: line.strip(blanks).translate(LOWER)
    holders = defaultdict(set)
    lines = {i: (t or "").split("\n") for i, t in docs.items()}
    for i, own in lines.items():
        for line in own:
            if len(key(line)) >= least:
                holders[key(line)].add(i)
    out = {}
    for i, own in lines.items():
        kept = [x for x in own if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        out[i] = len(own), len(own) - len(kept), "\n".join(kept)
    return out


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def jump(key, shards):
    key &= (1 << 64) - 1
    shard, after = -1, 0
    while after < shards:
        shard = after
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        after = int((shard + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return shard


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def conversation(turns):
    """Digests of (role, text) pairs in order."""
    spoken = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha(spoken), len(loss), sha(loss)
