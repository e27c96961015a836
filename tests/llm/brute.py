"""Plain single-machine versions of the operators' results, for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import xxhash

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TOKEN = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def tokens(rows, tokenizer):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (text_bytes(r[1])))):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def text_bytes(text):
    return (text or "").encode()


def licenses(text):
    words = WORD.findall(lower(text))
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    at, labels = [], set()
    for phrase, label in phrases.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i:i + len(own)] == own:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def simhash(text):
    words = TOKEN.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows):
    fps = [(i, simhash(t)) for i, t in rows]
    distinct = sorted({f for _, f in fps})
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(distinct)):
        for b in range(a + 1, len(distinct)):
            if (distinct[a] ^ distinct[b]).bit_count() <= 3:
                parent[find(distinct[a])] = find(distinct[b])
    least = defaultdict(list)
    for i, f in fps:
        if i is not None:
            least[find(f)].append(i)
    return [(i, f"{f:016x}", min(least[find(f)], default=None)) for i, f in fps]


def contamination(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall(lower(text))
        for i in range(max(len(words) - 9, 1) if words else 0):
            windows[tuple(words[i:i + 10])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        words, hit, found = WORD.findall(lower(text)), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i:i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text):
    """Counts and the base digest."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)]
    spans = [(m.start(), k, m.end(), name) for k, (name, pattern, ok) in enumerate(kinds)
             for m in re.finditer(pattern, text) if ok(m[0])]
    base = ",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(spans))
    count = [sum(s[1] == k for s in spans) for k in range(4)]
    return (*count, hashlib.sha256(base.encode()).hexdigest(), base)
