"""Quality model, prefix trie and structure repair against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from functools import cache
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aridspan.llm import prefix_trie, quality_model, structure_repair
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def key(text):
    return hashlib.md5(text.encode()).hexdigest()


def ordered(rows, fill):
    """{conv_id: [(turn, role, text)]} in the order that both operators state."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn, fill if role is None else role, fill if text is None else text))
    for held in out.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), key(r[2])))
    return out


def conversations(seed):
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "usher"], ["Yes.", "No", " \t", None, "Why?", "", "Größe!\nJa", "Yes."]
    rows = []
    for conv in [*range(60), -3, -5, 1000, 1004]:
        for i in range(rng.choice([1, 1, 2, 4, 6, 9, 14])):
            turn = rng.choice([i, i, i, i + 1, None])
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.7 else rng.choice(roles)
            rows.append((conv, turn, role, "Hello there." if rng.random() < 0.3 else rng.choice(texts)))
    rows += [(7, t, ("user", "assistant")[t % 2], f"Turn {t % 50}.") for t in range(400)]  # a long one
    rows += [(c, t, ("user", "assistant")[t % 2], "Same.") for c in range(100, 300) for t in range(4)]  # a hot group
    return rows + [(None, 1, "user", "Nobody's."), (None, None, None, None)]


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("k", "key", "path", "depth", "n", "head", "digest", "signature", "audit", "rank", "part", "x"):
        df = df.withColumn(name, F.lit("clash"))
    return df


# 11 quality model


def test_quality_model_learns(spark, tmp_path):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["the", "river", "stone", "quietly", "mixes", "old"]) + rng.choice(["", ",", "."]) for _ in range(rng.randint(30, 90)))
    bad = lambda: rng.choice([" ".join("BUY%%%" for _ in range(40)), "\n".join(["home | about"] * 30), good().upper() + "!!!", "# $ %" * 60])
    rows = [(i, good() if i % 4 else bad()) for i in range(900)]
    docs = spark.createDataFrame(rows + [(2000, None), (2001, ""), (2002, "word " * 300_000), (None, "no id here")], "doc_id long, text string").withColumn("x", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i, _ in rows] + [(5000, 1), (None, 0), (3, None)], "doc_id long, quality int")
    docs.write.parquet(f"{tmp_path}/t/documents.parquet")
    labels.write.parquet(f"{tmp_path}/t/labels.parquet")
    got = {r.doc_id: r for r in quality_model.query(spark, f"{tmp_path}/t").collect()}
    assert len(got) == 904 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items() if d is not None) and not got[None].held_out
    held = [(r.score, d % 4 > 0) for d, r in got.items() if d is not None and d < 900 and r.held_out]
    assert np.mean([(s >= 0.3) == y for s, y in held]) > 0.97
    assert got[2000].score == got[2001].score
    assert {d: r.score for d, r in got.items()} == {r.doc_id: r.score for r in quality_model.query(spark, f"{tmp_path}/t").collect()}
    docs.limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/e/labels.parquet")
    assert quality_model.query(spark, f"{tmp_path}/e").count() == 0
    none = quality_model.fit_quality(docs, labels.limit(0))
    assert {r.score for r in quality_model.score(docs, none).collect()} == {0.5}
    one = quality_model.fit_quality(docs, labels.filter("quality = 1"), sample=50)
    assert [r.score for r in quality_model.score(docs, one).collect()] == [pytest.approx(51 / 52)] * 904


def plain_score(model, x):
    """The model's score of one row, entry by entry."""
    at = lambda edges, v: sum(e <= v for e in edges)
    odds = model.start + sum(t[at(e, v)] for e, t, v in zip(model.edges, model.tables, x))
    odds += sum(t[at(a, x[i]), at(b, x[k])] for i, k, a, b, t in model.pairs)
    return 1 / (1 + np.exp(-odds))


def test_quality_scores_are_sums_of_table_entries(spark):
    rng = np.random.default_rng(1)
    x = rng.random((600, len(quality_model.FEATURES))).round(2)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4)).astype(float)  # no single feature says anything, the pair all
    model = quality_model.fit(x, y)
    scores = model.scores(x)
    assert np.allclose(scores, [plain_score(model, r) for r in x])
    assert (0, 1) in {(i, k) for i, k, *_ in model.pairs} and np.mean((scores > 0.5) == y) > 0.9
    again = quality_model.fit(np.concatenate([x, x]), np.concatenate([y, y]))  # repeated rows
    assert np.mean((again.scores(x) > 0.5) == y) > 0.9


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 9), st.integers(0, 30)), min_size=1, max_size=9))
def test_a_step_is_the_best_tree(bins):
    g, n = (np.array(c, dtype=float) for c in zip(*bins))
    h = n / 4
    got = quality_model.step(g, h, n)
    total = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + quality_model.SMOOTH)
    fits = lambda a, b: n[a:b].sum() >= quality_model.LEAST_ROWS

    def best(a, b):
        cuts = [c for c in range(a + 1, b) if fits(a, c) and fits(c, b)]
        return max(cuts, key=lambda c: (total(a, c) + total(c, b), -c), default=None)

    first = best(0, len(g))
    cuts = [0, len(g)] if first is None else sorted({0, first, len(g), *(c for c in (best(0, first), best(first, len(g))) if c is not None)})
    want = [-g[a:b].sum() / (h[a:b].sum() + quality_model.SMOOTH) for a, b in zip(cuts, cuts[1:]) for _ in range(b - a)]
    assert len(got) == len(g) and (np.allclose(got, want) or first is not None)  # ties of gains may fall either way
    parts = [got[a:b] for a, b in zip(cuts, cuts[1:])]
    assert len(np.unique(got)) <= 4 and (first is None or len(parts) >= 2)


def test_features_of_whole_texts():
    x = dict(zip(quality_model.FEATURES, quality_model.features("AB cd, 12\nab CD ef é\n\nab CD ef é".encode())))
    assert x["words"] == np.log1p(11) and x["lines"] == np.log1p(3) and x["repeated_lines"] == pytest.approx(1 / 3)
    assert x["repeated_triples"] == pytest.approx(1 - 7 / 9) and x["distinct_words"] == pytest.approx(7 / 11)
    assert quality_model.features(None) == quality_model.features(b" \n") == [0.0] * len(quality_model.FEATURES)


# 12 prefix trie


def trie(rows):
    """The contract, with every prefix as a tuple."""
    own = {c: [(r, t) for _, r, t in held] for c, held in ordered(rows, "").items() if c is not None}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        first = c - int(np.fmod(c, 5))
        whole[c] = tuple(own.get(first, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(cs) - 1) * (len(node[-1][1].encode()) if node else 0)
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if whole[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_prefix_trie(spark, tmp_path, seed):
    rows = conversations(seed)
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    assert sorted(map(tuple, prefix_trie.query(spark, str(tmp_path)).collect()), key=repr) == trie(rows)


def test_preorder_intervals(spark):
    rows = [(c, k, "user", x) for c, word in enumerate(["ab", "abc", "abd", "b", "ab", "a", "zzzz"]) for k, x in enumerate(word)]
    every = prefix_trie.turns(frame(spark, rows)).withColumn("part", F.lit(0))
    got = prefix_trie.trie(every.select("conv_id").distinct(), every).collect()
    assert sorted(r.position for r in got) == list(range(len(got)))
    by_place = {r.position: r for r in got}
    for r in got:
        inside = [by_place[i] for i in range(r.position, r.subtree_end + 1)]
        assert all(x.depth > r.depth for x in inside[1:]) and sum(x.n_children == 0 for x in inside) == r.n_leaves
        after = by_place.get(r.subtree_end + 1)
        assert after is None or after.depth <= r.depth
    assert by_place[0].depth == 0 and by_place[0].subtree_end == len(got) - 1


def test_prefix_trie_of_nothing(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/e/conversations.parquet")
    assert prefix_trie.query(spark, f"{tmp_path}/e").count() == 0
    frame(spark, [(None, 1, "user", "x")]).write.parquet(f"{tmp_path}/n/conversations.parquet")
    assert prefix_trie.query(spark, f"{tmp_path}/n").count() == 0
    many = [(5 * c, 1, "user", "x") for c in range(9000)]  # a list of members in several strings
    frame(spark, many).write.parquet(f"{tmp_path}/m/conversations.parquet")
    assert sorted(map(tuple, prefix_trie.query(spark, f"{tmp_path}/m").collect()), key=repr) == trie(many)


def test_prefix_sums(spark):
    rows = [(i * 7919 % 1000, i % 13) for i in range(1000)]
    df = spark.createDataFrame(rows, "at int, n long")
    got = {r["at"]: r.n_before for r in prefix_trie.prefix_sums(df, ["at"], ["n"]).collect()}
    total = 0
    for at, n in sorted(rows):
        assert got[at] == total
        total += n
    assert prefix_trie.prefix_sums(df.limit(0), ["at"], ["n"]).count() == 0


# 13 structure repair


def cheapest(symbols):
    """(cost, audit) of (role's initial, must go, truncated) rows, from the end of the conversation to its beginning."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @cache
    def best(i, state, run):
        ways = [(0, "")] if i == len(symbols) and state in ("", "a") else []
        if run < 3:
            ways += [add(5, "I", best(i, to, run + 1)) for (a, x), to in after.items() if a == state and x in "ua"]
        if i < len(symbols):
            initial, gone, cut = symbols[i]
            ways.append(add(2, "D", best(i + 1, state, 0)))
            if not gone:
                extra = 5 if cut else 0
                ways += [add(1 + extra, "R", best(i + 1, to, 0)) for (a, x), to in after.items() if a == state and x in "ua"]
                if (state, initial) in after:
                    ways.append(add(extra, "K", best(i + 1, after[state, initial], 0)))
        return min(ways, default=(10**9, ""))

    add = lambda cost, letter, rest: (cost + rest[0], letter + rest[1])
    return best(0, "", 0)


def repaired(audit, rows):
    """role, text of each row after the edits."""
    out, left = [], list(rows)
    for letter in audit:
        row = None if letter == "I" else left.pop(0)
        if letter == "D":
            continue
        role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        out.append((row[1] if letter == "K" else role, row[2] if row else ""))
    return out


def judged(rows, damage=True):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)}"""
    ids, hurt = {r[0] for r in rows}, []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        hurt += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    held, out = ordered(hurt, " "), {}
    for conv in ids:
        symbols, seen, counts, turns = [], set(), [0, 0, 0], [t for t, _, _ in held[conv] if t is not None]
        for _, role, text in held[conv]:
            words = brute.SPACE.findall(text)
            fault = 0 if not words else 1 if (role, text) in seen else 2 if words[-1][-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            symbols.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = cheapest(symbols)
        body = "\n".join(f"{r}:{t}" for r, t in repaired(audit, held[conv]))
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("seed", [1, 2])
def test_structure_repair(spark, tmp_path, seed):
    rows = [r for r in conversations(seed) if r[0] != 7 or (r[1] or 0) < 60]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in structure_repair.query(spark, str(tmp_path)).collect()}
    assert got == judged(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("suaoSUAOd", max_size=9), min_size=1, max_size=12))
def test_answers_of_a_trie(signatures):
    walk = structure_repair.Trie()
    for s in sorted(set(signatures)):
        assert walk.answer(s) == cheapest([(x.lower(), x == "d", x.isupper()) for x in s])
    prefixes = {s[:i] for s in signatures for i in range(1, len(s) + 1)}
    assert walk.computed == len(prefixes)  # one layer for each node


def test_every_short_signature():
    walk = structure_repair.Trie()
    for s in sorted("".join(x) for n in range(5) for x in product("suaoUAd", repeat=n)):
        assert walk.answer(s) == cheapest([(x.lower(), x == "d", x.isupper()) for x in s]), s


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "tool", "Well."), (2, 0, "assistant", "Lonely.")]
    rows += [(3, t, ("user", "assistant")[t % 2], f"Long {t}.") for t in range(5000)] + [(4, 0, "user", "x" * 3_000_000 + "."), (4, 1, "assistant", "Fine.")]
    df = frame(spark, rows)
    plans = structure_repair.plan(df)
    out = defaultdict(list)
    for r in sorted(structure_repair.repair(df, plans).collect(), key=lambda r: (r.conv_id, r.place)):
        out[r.conv_id].append((r.role, r.text, r.edit))
    assert out[1] == [("system", "Be kind.", "K"), ("user", "Hi.", "K"), ("assistant", "Well.", "R")] and 2 not in out
    assert len(out[3]) == 5000 and [len(t) for _, t, _ in out[4]] == [3_000_001, 5]
    found = {r.conv_id: r.sha256 for r in structure_repair.digests(df, plans).collect()}
    assert found == {c: v[-1] for c, v in judged([r for r in rows if r[0] != 3], damage=False).items()} | {3: found[3]}
    none = structure_repair.plan(df.limit(0))
    assert none.count() == 0 and structure_repair.repair(df.limit(0), none).count() == 0
