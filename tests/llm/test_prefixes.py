"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from sluice.llm import prefixes

from .helpers import table, words

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows, period=20, kinds=4):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            held[conv].append((turn is not None, turn or 0, mark, (role, text)))
    lines = {c: [x[3] for x in sorted(v)] for c, v in held.items()}
    out = {}
    for c, line in lines.items():
        h = zlib.crc32(str(c).encode()) % kinds
        first = c - (abs(c) % period if c >= 0 else -(abs(c) % period))
        out[c] = lines.get(first, [])[:h] + line[h:]
    return out


def brute(lines):
    members = defaultdict(list)
    for c, line in lines.items():
        for d in range(len(line) + 1):
            members[tuple(line[:d])].append(c)
    rows = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        childless = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        saved = sum((len(members[q]) - 1) * len(words(q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(convs) if len(lines[c]) == len(p))
        rows.append((
            min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs),
            sum(len(q) == len(p) + 1 for q in below), len(childless), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def conversations(seed, count=60, kinds=3, depth=7):
    rng = random.Random(seed)
    rows = []
    for c in range(-5, count):
        if c % 11 == 7:
            continue  # some ids are missing
        for t in range(rng.randrange(1, depth)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t > 2 else "user", f"say {rng.randrange(kinds)} " * (t + 1)))
    return rows


def result(frame, **options):
    found = prefixes.prefix_trie(prefixes.shared_starts(prefixes.ordered_turns(frame)), **options).drop("node")
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("seed, turns", [(1, 1 << 16), (2, 12), (3, 1)])
def test_equals_plain_prefixes(spark, tmp_path, seed, turns):
    rows = conversations(seed)
    frame = table(spark, tmp_path, rows, SCHEMA)
    assert result(frame, trie_turns=turns) == brute(rebuilt(rows))


def test_nulls_ties_and_repeated_rows(spark, tmp_path):
    rows = [
        (0, None, "user", "a b"), (0, 1, None, "c"), (0, 2, "user", None), (0, 2, "user", "tie"), (0, 2, "user", "tie"),
        (1, 0, "user", "x"), (1, 0, "us", "erx"), (2, 5, "", ""), (2, 6, None, None), (None, 1, "user", "lost"),
        (None, 2, "user", "lost"), (41, 1, "user", "no first of its twenty"),
    ] + [(c, t, "user", "the same") for c in range(60, 75) for t in range(4)]
    rows += [(3, t, "user", "long " * 50) for t in range(40)]
    frame = table(spark, tmp_path, rows, SCHEMA)
    wide = frame.selectExpr("*", "1 AS node", "'x' AS depth", "2 AS Words", "3 AS mark", "4 AS path")
    assert result(wide) == brute(rebuilt(rows))


def test_empty_and_turnless(spark, tmp_path):
    assert result(table(spark, tmp_path, [], SCHEMA)) == []
    rows = [(c, 0, "user", "only") for c in (1, 2, 3, 5, 21, 22)]  # no first ones: some lose their only turn
    lines = rebuilt(rows)
    assert [] in lines.values()
    assert result(table(spark, tmp_path, rows, SCHEMA)) == brute(lines)
    bare = [(c, 0, "user", "only") for c, line in lines.items() if not line]
    assert result(table(spark, tmp_path, bare, SCHEMA)) == brute(rebuilt(bare))


@pytest.mark.parametrize("low, high, want", [(0, 1, 1), (0, 7, 4), (4, 7, 6), (5, 6, 6), (3, 12, 8), (8, 9, 9)])
def test_two_fattest(low, high, want):
    assert prefixes.two_fattest(low, high) == want


@pytest.mark.parametrize("seed", range(8))
def test_exit_nodes(seed):
    """Fat binary search ends where a walk over all nodes does, whatever was inserted before."""
    rng = random.Random(seed)
    trie, seen = prefixes.ZFastTrie(), []

    def path(line):
        out, last = [], prefixes.ROOT
        for x in line:
            last = hashlib.blake2b(last + bytes([x]), digest_size=16).digest()
            out.append(last)
        return out

    for _ in range(12):
        batch = []
        for _ in range(rng.randrange(1, 30)):
            start = rng.choice(seen)[: rng.randrange(20)] if seen and rng.random() < 0.7 else []
            batch.append([*start, *[rng.randrange(2) for _ in range(rng.randrange(12))]])
        ends = trie.insert_batch([(path(line), [1] * len(line)) for line in batch])
        for line, end in zip(batch, ends):
            assert trie.deep[end] == len(line) and trie.path[end][: len(line)] == path(line)
        seen += batch
        for line in [*seen[-20:], [rng.randrange(2) for _ in range(15)]]:
            p = path(line)
            whole = [v for v in range(len(trie.low)) if trie.deep[v] <= len(p) and trie.path[v][: trie.deep[v]] == p[: trie.deep[v]]]
            node, child = trie.exit(p)
            assert node == max(whole, key=lambda v: trie.deep[v])
            below = [v for v in range(1, len(trie.low)) if trie.parent[v] == node
                     and trie.deep[node] < len(p) and trie.path[v][trie.deep[node]] == p[trie.deep[node]]]
            assert below == ([] if child is None else [child])
