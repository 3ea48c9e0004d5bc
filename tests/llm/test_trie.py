"""The conversation trie against a trie built node by node."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from regiostat.llm.conversation_trie import trie

SCHEMA = "conv_id long, turn long, role string, text string, n long, path string, depth long"


def naive(rows, every=20, most=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest(), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % every) * (1 if c >= 0 else -1)
        full[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in full.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    total = {}
    for p in sorted(members, key=len, reverse=True):
        own_saved = (len(members[p]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0)
        total[p] = (sum(total[k][0] for k in children[p]) or 1, own_saved + sum(total[k][1] for k in children[p]))
    out = []
    for p, m in members.items():
        ended = ",".join(map(str, sorted(c for c in m if full[c] == p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *total[p], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(parts)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def random_rows(seed, n, alphabet, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        rows += [(c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", rng.choice(alphabet)) for t in range(rng.randint(1, longest))]
    return rows


@pytest.mark.parametrize("segment_turns, arity", [(60, 2), (400_000, 64)])
def test_against_naive(spark, segment_turns, arity):
    rows = random_rows(1, 150, ["a b", "c d e", "f", ""], 9) + [(500 + k, t, "user", "copy of a conversation") for k in range(60) for t in range(5)]
    assert got(trie(table(spark, rows), segment_turns=segment_turns, arity=arity)) == naive(rows)


def test_long_shared_conversations_over_many_segments(spark):
    rows = [(c, t, "u", f"w {t if t < 35 else t * 100 + c}") for c in range(40) for t in range(30 + c % 9)]
    assert got(trie(table(spark, rows), segment_turns=120, arity=2)) == naive(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (1, None, None, None), (1, 2, "user", ""), (1, 2, "user", ""), (2, 1, "", "x y"), (20, 3, "a", "bc"), (20, 3, "ab", "c"), (21, 1, "user", "one"),
            (-5, 1, "user", "neg"), (0, 0, "user", "base turn \t one"), (3, 5, "user", "late"), (3, -1, "user", "early"), (4, 0, "system", "é" * 50_000), (5, 0, "user", "ends at root")]
    assert got(trie(table(spark, rows))) == naive(rows)
    assert got(trie(table(spark, rows), segment_turns=4, arity=2)) == naive(rows)
    assert trie(table(spark, rows).limit(0)).collect() == []
