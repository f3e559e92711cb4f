import hashlib
import random
import re

import numpy as np
import pytest
from pricecast.llm import substring_dedup
from pricecast.llm.fm_index import FMIndex, WaveletMatrix


def test_wavelet_ranks():
    x = np.random.default_rng(1).integers(0, 37, 500)
    m = WaveletMatrix(x, 6)
    for s in (0, 5, 36):
        at = np.arange(501)
        sym = np.full(501, s)
        assert (m.follow(sym, at) - m.follow(sym, at * 0)).tolist() == [int((x[:i] == s).sum()) for i in at]


def test_classes_are_equal_windows():
    r = random.Random(2)
    seqs = [[r.choice([b"a", b"b", b"c"]) for _ in range(r.randrange(1, 60))] for _ in range(40)]
    index = FMIndex(seqs, 5)
    seen = {}
    for s, found in zip(seqs, index.classes(5)):
        assert len(found) == max(0, len(s) - 4)
        for i, g in enumerate(found):
            assert seen.setdefault(tuple(s[i : i + 5]), g) == g
    assert len(set(seen.values())) == len(seen)


def brute(rows):
    first = {}
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), d)
    out = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = set()
        for k in range(len(w) - 49):
            if d is not None and first[tuple(w[k : k + 50])] < d:
                gone |= set(range(k, k + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [substring_dedup.HOT, 1])
def test_matches_brute_force(odd, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    want = brute([(r.doc_id, r.text) for r in odd.collect()])
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(odd).collect())
    assert got == want and sum(x[2] for x in want) > 100


def test_empty_table(none):
    assert substring_dedup.remove_repeats(none).count() == 0
