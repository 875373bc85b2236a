"""Burrows-Wheeler transforms of string collections, merged by iterative interleave refinement (after Holt
and McMillan, 2014).

A shard is a collection of different strings, each closed by END and read as one circular text. Its transform is
made once, where the strings are, and is all that travels: the last-to-first step is counted from it, and the
strings and their places are walked out of it again.

Merging refines one state, the interleave: which shard the next row comes from. It starts with the shards' rows
one shard after another. A round reads the shards' transforms in the order of the interleave, w symbols at a time
(as many as 16 bits can rank), and deals the interleave's entries out by what it read; rows of a shard keep their
order, no row number is kept, and no suffix is compared or sorted again. After k rounds all rows stand in the order
of their first w k symbols. A boundary that first shows between two rows in round k says that their common prefix
has w (k - 1) symbols or up to w - 1 more; rows without a boundary after n symbols form a repeated interval of a
string of n symbols.

Defined cases: no strings give no rows; equal strings may stand in different shards, and within a shard only once
(``collected`` sees to that); strings hold no byte END, which no UTF-8 text has; strings shorter than what is
looked for repeat nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Ends each string; no byte of UTF-8 text has this value.
END = 0xFF


@dataclass
class Shard:
    """A transform, and for each string the row that begins with its END."""

    symbols: np.ndarray
    ends: np.ndarray


def shard_transform(strings: list[bytes]) -> Shard:
    """The transform of different strings. Rows are sorted by their first eight symbols, and those that are equal so
    far by twice as many, until none are."""
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    n = len(text)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | np.roll(text, -i)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    edge = np.append(True, ordered[1:] != ordered[:-1])
    head = np.flatnonzero(edge)
    rank = np.empty(n, np.uint64)
    rank[order] = np.repeat(head, np.diff(np.append(head, n)))
    tied = np.flatnonzero(~(edge & np.append(edge[1:], True)))  # places in order, group after group
    depth = 8
    while len(tied) and depth < 2 * n:
        rows = order[tied]
        key = (rank[rows] << np.uint64(32)) | rank[(rows + depth) % n]
        by = np.argsort(key, kind="stable")
        rows, key = rows[by], key[by]
        order[tied] = rows
        edge = np.append(True, key[1:] != key[:-1])
        head = np.flatnonzero(edge)
        rank[rows] = np.repeat(tied[head], np.diff(np.append(head, len(tied))))
        tied = tied[~(edge & np.append(edge[1:], True))]
        depth *= 2
    rank = rank.astype(np.int32)
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    return Shard(text[order - 1], rank[ends])


def collected(strings: list[bytes], docs: np.ndarray, shard_bytes: int) -> list[list[int]]:
    """Numbers of strings by shard: about so many bytes a shard, and equal strings in different ones."""
    shards: list[tuple[set, list[int]]] = []
    size, open_ = [], 0
    for i, s in enumerate(strings):
        k = open_
        while k < len(shards) and (s in shards[k][0] or (size[k] and size[k] + len(s) > shard_bytes)):
            k += 1
        if k == len(shards):
            shards.append((set(), []))
            size.append(0)
        shards[k][0].add(s)
        shards[k][1].append(i)
        size[k] += len(s) + 1
        while open_ < len(shards) and size[open_] >= shard_bytes:
            open_ += 1
    return [x[1] for x in shards]


def smallest(n: int) -> type:
    return np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.uint32


def last_to_first(symbols: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """For each row of the joined shards, the row that begins one symbol earlier."""
    kind = smallest(max(1 << 16, (int(shard[-1]) + 1) << 8))
    order = np.argsort((shard.astype(kind) << kind(8)) | symbols, kind="stable")
    step = np.empty(len(symbols), np.int32)
    step[order] = np.arange(len(symbols), dtype=np.int32)
    return step


def codes(symbols: np.ndarray, step: np.ndarray, most: int) -> list[np.ndarray]:
    """For each row the rank of the one symbol before it, of the two, and so on: up to most symbols, and only as long as
    ranks fit into 16 bits, which sort in linear time."""
    one = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    size = int(one.max()) + 1
    out = [one.astype(np.uint16)]
    while len(out) < most:
        value = out[-1][step].astype(np.int64) * size + one
        there = np.zeros(int(value.max()) + 1, bool)
        there[value] = True
        rank = np.cumsum(there, dtype=np.int32)
        if rank[-1] > 1 << 16:
            break
        out.append((rank[value] - 1).astype(np.uint16))
    return out


def refined(symbols: np.ndarray, shard: np.ndarray, step: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of the joined shards (symbols, and the shard of each row) in the order of their first depth
    symbols, and the common prefix of each row with the row before (rounded down to whole rounds; depth: that or more)."""
    n = len(symbols)
    ranks = codes(symbols, step, min(depth, 6))
    widths = [len(ranks)] * (depth // len(ranks)) + [depth % len(ranks)] * (depth % len(ranks) > 0)
    interleave = shard.copy()
    block = np.zeros(n, np.int32)
    common = np.full(n, depth, np.int16)
    edge = np.empty(n, bool)
    read = np.empty(n, np.uint16)
    done, blocks = 0, 1
    for width in widths:
        read[np.argsort(interleave, kind="stable")] = ranks[width - 1]  # each shard's rows in their order, where the interleave has them
        order = np.argsort(read, kind="stable")
        interleave, b, s = interleave[order], block[order], read[order]
        edge[0] = True
        np.not_equal(b[1:], b[:-1], out=edge[1:])
        edge[1:] |= s[1:] != s[:-1]
        common[edge & (common == depth)] = done
        done += width
        np.cumsum(edge, out=block, dtype=np.int32)
        if block[-1] == blocks:
            break
        blocks = int(block[-1])
    common[0] = 0
    return interleave, common


def walked(symbols: np.ndarray, step: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the string it lies in and its distance from that string's end, and the length of each string; ends:
    the row of each string's END."""
    owner, left = np.empty(len(symbols), np.int32), np.empty(len(symbols), np.int32)
    length = np.empty(len(ends), np.int64)
    who, row, at = np.arange(len(ends), dtype=np.int32), ends, 0
    while len(who):
        owner[row], left[row] = who, at
        first = symbols[row] == END
        length[who[first]] = at
        who, row = who[~first], step[row[~first]]
        at += 1
    return owner, left, length


def repeats_across(shards: list[Shard], docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset), sorted, of all substrings of n symbols that a string of a smaller doc holds too; docs: of
    each string, shard after shard."""
    if not shards:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = [len(s.symbols) for s in shards]
    symbols = np.concatenate([s.symbols for s in shards])
    shard = np.repeat(np.arange(len(shards), dtype=smallest(len(shards))), sizes)
    starts = np.cumsum([0, *sizes[:-1]])
    step = last_to_first(symbols, shard)
    interleave, common = refined(symbols, shard, step, n)
    owner, left, length = walked(symbols, step, np.concatenate([s.ends + a for s, a in zip(shards, starts)]))
    row = np.empty(len(symbols), np.int32)
    row[np.argsort(interleave, kind="stable")] = np.arange(len(symbols), dtype=np.int32)
    owner, left = owner[row], left[row]
    whole = left >= n
    doc = np.where(whole, docs[owner], np.iinfo(np.int64).max)
    firsts = np.flatnonzero(common < n)
    least = np.minimum.reduceat(doc, firsts)
    hit = whole & (doc > np.repeat(least, np.diff(np.append(firsts, len(doc)))))
    who, offset = owner[hit], length[owner[hit]] - left[hit]
    order = np.lexsort((offset, who))
    return who[order].astype(np.int64), offset[order]


def repeated_in_smaller(strings: list[bytes], docs: np.ndarray, n: int, shard_bytes: int = 1 << 18) -> list[np.ndarray]:
    """For each string, where substrings of n symbols begin that a string of a smaller doc holds too."""
    parts = collected(strings, docs, shard_bytes)
    by = np.concatenate([np.asarray(p) for p in parts]) if parts else np.zeros(0, np.int64)
    who, offset = repeats_across([shard_transform([strings[i] for i in p]) for p in parts], docs[by], n)
    out = [np.zeros(0, np.int64)] * len(strings)
    for i, where in zip(by.tolist(), np.split(offset, np.searchsorted(who, np.arange(1, len(by))))):
        out[i] = where
    return out if strings else []
