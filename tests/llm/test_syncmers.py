import hashlib
import random

import numpy as np
import pytest
from pricecast.llm import syncmers


def test_anchor_definition():
    data = np.random.default_rng(0).integers(97, 107, 4000).astype(np.uint8)
    at, _ = syncmers.anchors(data)
    inner = syncmers.mix(np.lib.stride_tricks.sliding_window_view(data, syncmers.S).copy().view("<u4").ravel().astype(np.uint64))
    width = syncmers.K - syncmers.S + 1
    want = [i for i in range(len(data) - syncmers.K + 1) if inner[i : i + width].min() in (inner[i], inner[i + width - 1])]
    assert at.tolist() == want


def test_context_free():
    text = b"some passage with enough bytes to hold several anchors, whatever stands around it"
    a, ha = syncmers.anchors(np.frombuffer(text, np.uint8))
    b, hb = syncmers.anchors(np.frombuffer(b"before " + text + b" after", np.uint8))
    assert set(zip(a + 7, ha)) <= set(zip(b, hb))


def test_against_next(odd):
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    want = []
    for i, r in enumerate(rows):
        t, x = r.text or "", rows[(i + 1) % len(rows)].text or ""
        e = t[: len(t) - len(t) // 2] + x[: len(t) // 2]
        want.append((str(r.doc_id), len(t), hashlib.sha256(e.encode()).hexdigest()))
    for buckets in (1, 7):
        got = syncmers.against_edited_and_next(odd, buckets).collect()
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by = {}
    for r in odd.collect():
        by.setdefault(r.text or "", set()).add(r.doc_id)
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[0] & prints[1] and prints[2] & prints[3] == {""}
    whole = [r for r in got if r.n_chars > 300 and r.doc_id not in (7, 34)]
    assert sum(r.near_edited for r in whole) / len(whole) > 0.35


def test_one_row_and_none(spark, none):
    one = syncmers.against_edited_and_next(spark.createDataFrame([(4, "just one text that is its own next one")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert syncmers.against_edited_and_next(none).count() == 0


def test_passages_put_in_leave_the_rest_alike():
    r = np.random.default_rng(4)
    say = lambda n: [f"w{x}" for x in r.integers(0, 3000, n)]
    got = []
    for _ in range(60):
        base = say(600)
        at = len(base) // 2
        longer = base[:at] + say(90) + base[at:]
        x, y, z = syncmers.sketches([" ".join(t).encode() for t in (base, longer, say(600))])
        got.append(syncmers.likeness(x, y))
        assert syncmers.likeness(x, x) == 1 and syncmers.likeness(x, z) < 0.15
    assert min(got) > 0.75 and np.mean(got) > 0.88
    turned = [say(300), say(300)]
    x, y = syncmers.sketches([" ".join(turned[0] + turned[1]).encode(), " ".join(turned[1] + turned[0]).encode()])
    assert 0.4 < syncmers.likeness(x, y) < 0.9  # one of the halves keeps its order


def test_a_passage_shared_by_long_texts_is_seen():
    r = np.random.default_rng(6)
    say = lambda n: " ".join(f"w{x}" for x in r.integers(0, 10**6, n))
    passage = say(1200)
    x, y = syncmers.sketches([f"{say(9000)} {passage} {say(9000)}".encode(), f"{say(4000)} {passage} {say(14000)}".encode()])
    shared = np.intersect1d(x[0], y[0])
    assert len(x[0]) > 10 * syncmers.SKETCH and len(shared) > 30
    assert syncmers.likeness(x, y) > 0.03


@pytest.mark.parametrize("n", [1, 5, 12, 18, 25, 40, 100])
def test_likeness_of_texts_with_many_insertions(n):
    """Passages of 400 words with 60 words put in after each: likeness stays near the shared words' share."""
    r = random.Random(n)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(3, 9)))
    passages = [[word() for _ in range(400)] for _ in range(n)]
    plain = [w for p in passages for w in p]
    longer = [w for p in passages for w in [*p, *(word() for _ in range(60))]]
    a, b = syncmers.sketches([" ".join(plain).encode(), " ".join(longer).encode()])
    overlap = 2 * len(plain) / (len(plain) + len(longer))
    assert abs(syncmers.likeness(a, b) - overlap) < (0.05 if n > 1 else 0.12)
    other = syncmers.sketches([" ".join(word() for _ in range(400 * n)).encode()])[0]
    assert syncmers.likeness(a, other) < 0.05
