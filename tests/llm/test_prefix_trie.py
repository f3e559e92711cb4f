import hashlib
import math
import random
import zlib

import pytest
from pricecast.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
FIELDS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def words(text):
    return len([w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w])


def brute(sequences):
    """Nodes from all prefixes of all sequences."""
    members = {}
    for c, seq in sequences:
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append((c, len(seq)))
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) if kids else 1
        own = (len(members[p]) - 1) * words(p[-1][1]) if p else 0
        saved[p] = own + sum(saved[k] for k in kids)
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c, n in m if n == len(p))))
        up = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(c for c, _ in m), len(p), up, len(m), len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def rebuild(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = []
    for c, v in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(math.fmod(c, 20))  # the remainder has the sign of c, as in SQL
        out.append((c, own.get(base, [])[:h] + v[h:]))
    return out


def conversations(n=400, seed=5):
    r = random.Random(seed)
    texts = ["", "a", "a b", "hello there\nyou", "ünd  so\tweiter", "one two three four", None]
    roles = ["user", "assistant", "system", None]
    rows = []
    for c in r.sample(range(-40, 3 * n), n):
        kind = r.randrange(10)
        size = 12 if kind == 0 else r.randrange(1, 5)
        if kind < 5:  # many share beginnings
            seq = [(roles[i % 2], texts[(i * i) % 5]) for i in range(size)]
        else:
            seq = [(r.choice(roles), r.choice(texts)) for _ in range(size)]
        rows += [(c, None if i == 0 and kind == 3 else i, *t) for i, t in enumerate(seq)]
    rows += [(7000, i, "user", f"turn {i}") for i in range(300)]
    r.shuffle(rows)
    return rows


def nodes(df):
    rows = [tuple(x[f] for f in FIELDS) for x in df.collect()]
    return sorted(rows, key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("fan,per_task", [(64, 50_000), (2, 30), (3, 7)])
def test_against_all_prefixes(spark, monkeypatch, fan, per_task):
    """One partition or many, merged in few or many rounds."""
    monkeypatch.setattr(prefix_trie, "FAN", fan)
    monkeypatch.setattr(prefix_trie, "PER_TASK", per_task)
    monkeypatch.setattr(prefix_trie, "RUN", 3)
    rows = conversations()
    df = spark.createDataFrame([(*x, 1) for x in rows], SCHEMA + ", key int")
    assert nodes(prefix_trie.trie(prefix_trie.rebuilt(df))) == brute(rebuild(rows))


def test_copies_and_turnless(spark):
    """A conversation whose turns are all replaced by those of a missing one has none, and ends at the root."""
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in range(100, 140)}
    rows = [(c, 0, "user", "hi you") for c in h] + [(c, 1, "user", "x") for c in h if c % 2] + [(None, 0, "user", "lost")]
    rows = [x for x in rows if x[0] != 120]
    got = nodes(prefix_trie.trie(prefix_trie.rebuilt(spark.createDataFrame(rows, SCHEMA))))
    want = brute(rebuild(rows))
    assert got == want
    assert want[0][1] == 0 and any(d == 0 and e != hashlib.sha256(b"").hexdigest() for _, d, *_, e in want)


def test_equal_turns_and_empty(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (21, 0, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = (nodes(prefix_trie.trie(prefix_trie.as_sequences(x))) for x in (df, df.orderBy("text")))
    assert a == b and len(a) in (4, 5)
    assert nodes(prefix_trie.trie(prefix_trie.rebuilt(df.filter("1 = 0")))) == []


def test_query_matches_sql(spark):
    import compare as cmp
    from pricecast.llm import queries

    folder = "/root/testdata/sf0.001"
    ok, text, _ = cmp.compare(spark, cmp.connect(folder), folder, queries.op13_prefix_trie, queries.ORACLE["op13_prefix_trie"])
    assert ok, text
