"""The contracts restated as plainly as possible, over lists of (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    words = SPACE.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def licenses(text):
    """n_words, n_base, first_word, last_word, base_labels"""
    words = ALNUM.findall((text or "").translate(LOWER))
    at, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        got = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        at += got
        labels |= {label} if got else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def private(text):
    """[(kind, start, end)] of the base patterns."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def contaminated(docs, items):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - 12)) if w else ():
            windows[tuple(w[i : i + 13])].add(item)
    lengths = {len(k) for k in windows}
    out = {}
    for doc, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, got = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    got |= found
        sha = hashlib.sha256(",".join(sorted(map(str, got))).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(got), sha, bool(hit) and 20 * len(hit) >= len(w))
    return out


def repeats(docs, n=50):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    first = {}
    for doc, text in docs:
        b = (text or "").encode()
        for i in range(len(b) - n + 1):
            k = b[i : i + n]
            first[k] = min(first.get(k, doc), doc)
    out = {}
    for doc, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if first[b[i : i + n]] < doc:
                gone[i : i + n] = b"\1" * n
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, b"\0" + gone))
        out[doc] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def near(docs):
    """{doc_id: (n_shingles, component_id)}"""
    sets = {}
    for doc, text in docs:
        w = SPACE.findall((text or "").translate(LOWER))
        sets[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    holders = defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            holders[x].append(doc)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    common = Counter()
    for h in holders.values():
        h = sorted(h)
        for i, a in enumerate(h):
            for b in h[i + 1 :]:
                common[a, b] += 1
    for (a, b), c in common.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}
