"""The trie of conversation prefixes against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from notegraph.llm import convtrie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, pos long, key string, c long, d long, words long"


def ordered(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            item = f"{len(role or '')}:{role or ''}{text or ''}".encode()
            by[c].append((turn is not None, turn or 0, role or "", hashlib.sha256(item).digest()[:16], text or ""))
    return {c: [(x[2], x[4]) for x in sorted(v)] for c, v in by.items()}


def rebuilt(turns):
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in turns}
    return {c: turns.get(c - c % 20, [])[: h[c]] + v[h[c] :] for c, v in turns.items()}


def brute(turns):
    members, children = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        for d in range(len(turns[c]) + 1):
            members[tuple(turns[c][:d])].append(c)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    out, leaves, saved = [], {}, {}
    for k in sorted(members, key=len, reverse=True):
        m = members[k]
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = sum(saved[x] for x in children[k]) + ((len(m) - 1) * len(WORD.findall(k[-1][1])) if k else 0)
        ends = ",".join(str(c) for c in m if len(turns[c]) == len(k))
        out.append((m[0], len(k), members[k[:-1]][0] if k else None, len(m), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, 3, 4) for r in rows], SCHEMA)


def test_query_equals_brute_force_and_sql(spark, sf, duck, same):
    df = convtrie.op11_prefix_trie(spark, sf)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(df) == brute(rebuilt(ordered(rows)))
    same(df, duck.sql(convtrie.OP11_SQL))


def test_trie_of_all_shapes(spark, monkeypatch):
    """Random tries over few texts, a long path that others leave, many siblings, equal conversations; small pieces and chunks."""
    monkeypatch.setattr(convtrie, "PIECE", 3)
    monkeypatch.setattr(convtrie, "CHUNK", 16)
    rng = random.Random(5)
    rows = [(c, t, rng.choice("ua"), rng.choice(["x", "x y", ""])) for c in range(60) for t in range(rng.randrange(1, 7))]
    rows += [(100, t, "u", f"long {t}") for t in range(70)]
    rows += [(200 + c, t, "u", f"long {t}" if t < 7 * c else f"own {c}") for c in range(10) for t in range(7 * c + 1)]
    rows += [(300 + c, t, "u", "same" if t == 0 else f"sibling {c}") for c in range(40) for t in range(2)]
    rows += [(400 + c, t, "u", "copy") for c in range(30) for t in range(3)]
    rows += [(-5, t, "u", f"long {t}") for t in range(9)]
    rng.shuffle(rows)
    assert got(convtrie.conversation_trie(frame(spark, rows))) == brute(ordered(rows))


def test_defined_cases(spark):
    rows = [(1, None, "u", "null first"), (1, 0, None, None), (1, 1, "b", "tie"), (1, 1, "a", "tie"), (1, 1, "a", "tie"), (None, 0, "u", "nobody"), (2, 5, "u", "w " * 50_000), (3, 1, "", ""), (41, 0, "u", "first"), (45, 0, "u", "")]
    assert got(convtrie.conversation_trie(frame(spark, rows))) == brute(ordered(rows))
    assert convtrie.conversation_trie(frame(spark, [])).count() == 0


def test_turnless_conversations_are_rebuilt(spark):
    """Conversations with no more turns than they drop, whose base is absent, end at the root."""
    from notegraph.llm.common import Scratch

    rows = [(c, t, "u", f"t{t}") for c in (21, 22, 23, 24, 25, 26, 40, 41, 43) for t in range(1 + c % 2)]
    scratch = Scratch(spark, "test")
    turns = convtrie.ordered_turns(frame(spark, rows), scratch)
    convs = turns.select("conv").distinct()
    found = got(convtrie.prefix_trie(scratch.write(convtrie.rebuilt(turns, convs), "rebuilt"), convs, scratch))
    want = rebuilt(ordered(rows))
    assert any(not v for v in want.values()) and found == brute(want)
