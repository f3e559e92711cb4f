import re

import xxhash
from pricecast.llm import simhash


def brute(text):
    text = (text or "").translate({k: k + 32 for k in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes) > 0)


def test_fingerprints_and_components_match_brute_force(odd):
    rows = [(r.doc_id, brute(r.text)) for r in odd.collect()]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = sorted((str(d), f"{fp:016x}", str(least.get(find(i)))) for i, (d, fp) in enumerate(rows))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(odd).collect())
    assert got == want


def test_links_at_three_bits_but_not_four(spark):
    near = spark.createDataFrame([(0, 0), (0b111, 0b111), (1 << 40 | 1 << 50 | 1 << 63 - 1, 1 << 40 | 1 << 50 | 1 << 62), (0b1111 << 20, 0b1111 << 20)], "id long, sig long")
    roots = {r.id: r.root for r in simhash.link_in_cells(simhash.grid_cells(near), simhash.within(3)).collect()}
    assert roots == {0: 0, 7: 0, (1 << 40 | 1 << 50 | 1 << 62): 0}


def test_chain_is_one_component(spark):
    chain = [sum(0b111 << 3 * k for k in range(n)) for n in range(20)]
    nodes = spark.createDataFrame([(c, c) for c in chain], "id long, sig long")
    roots = {r.id: r.root for r in simhash.link_in_cells(simhash.grid_cells(nodes), simhash.within(3)).collect()}
    assert set(roots.values()) == {0} and len(roots) == 20


def test_empty_table(none):
    assert simhash.near_duplicates(none).count() == 0


def test_keep_one_drops_near_copies_and_keeps_the_rest(spark, odd):
    import random

    r = random.Random(1)
    say = lambda n: [f"t{r.randrange(10**6)}" for _ in range(n)]
    base = say(300)
    rows = [(0, " ".join(base))]
    for k in range(1, 8):
        w = list(base)
        w[31 * k] = "changed"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, " ".join(say(200))) for k in range(10)]
    rows += [(3, rows[3][1]), (100, rows[8][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x.doc_id for x in simhash.keep_one(docs).collect()) == [0] + list(range(100, 110))
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and 0 < kept.count() < odd.count()
    assert simhash.keep_one(odd.filter("1 = 0")).count() == 0


def test_groups_are_those_of_exact_shingle_likeness(spark):
    import random

    r = random.Random(8)
    say = lambda n: [f"t{r.randrange(10**6)}" for _ in range(n)]
    texts = []
    for k in range(120):  # each changed word costs five shingles: likenesses around 0.8
        base = say(r.randrange(90, 400))
        n = len(base) - 4
        near = list(base)
        for at in r.sample(range(0, len(base) // 6), round(n * r.uniform(0.10, 0.13) / 5)):
            near[6 * at] = f"new{at}"
        texts += [" ".join(base), " ".join(near)]
    phrase = " ".join(say(12))
    texts += [f"{phrase} " * 80 + " ".join(say(60)) for _ in range(4)]  # alike only where repeats count
    texts += ["a b", "A  b", "", None, " ".join(["same"] * 50), " ".join(["same"] * 90)]

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    levels = []
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x == y or 5 * len(x & y) >= 4 * len(x | y):
                root = [root[j] if g == root[i] else g for g in root] if root[j] < root[i] else [root[i] if g == root[j] else g for g in root]
            if x & y:
                levels.append(len(x & y) / len(x | y))
    assert sum(0.75 < v < 0.8 for v in levels) > 10 < sum(0.8 <= v < 0.85 for v in levels)
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {x.id: x.group_id for x in simhash.similar_groups(docs).collect()}
    assert got == dict(enumerate(root))


def test_near_copies_meet_by_segment_popcounts_first(spark, monkeypatch):
    import random

    r = random.Random(4)
    base = [f"t{r.randrange(10**6)}" for _ in range(2000)]
    near = [*base[:-1], "other"]  # a likeness of 0.999
    far = [*base[:900], *(f"u{r.randrange(10**6)}" for _ in range(100)), *base[1000:]]  # 0.9: more bits than cells reach
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate((base, near, far, base[::-1]))], "id long, text string")
    fps = {x.id: x.fp for x in docs.select("id", simhash.F.col("text").cast("binary")).mapInArrow(simhash._keys(5), "id long, key long, fp long").collect()}
    assert ((fps[0] ^ fps[1]) & (2**64 - 1)).bit_count() <= 3 < ((fps[0] ^ fps[2]) & (2**64 - 1)).bit_count()
    found, whole = [], simhash.link_in_cells

    def watched(cells, *rest):
        probes = cells.filter("probe").count()
        out = whole(cells, *rest)
        found.append((probes > 0, out.count()))
        return out

    monkeypatch.setattr(simhash, "link_in_cells", watched)
    got = {x.id: x.group_id for x in simhash.similar_groups(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3}
    assert found == [(True, 2), (False, 3)]  # the grid links two, the prefixes add the third


def test_counters_reach_the_driver_as_arrow(spark, odd, monkeypatch):
    from pricecast.llm import line_dedup

    def refused(self):
        raise AssertionError("rows as Python objects take hundreds of megabytes of the driver")

    docs = odd.selectExpr("doc_id AS id", "text")
    monkeypatch.setattr(type(docs), "toPandas", refused)
    assert simhash.similar_groups(docs).count() == docs.count()
    assert line_dedup.by_document(odd).count() == odd.count()


def test_keep_one_follows_links_of_both_kinds(spark):
    """Documents that op1 links went on to the next stage where their shingle sets were less alike."""
    import random

    r = random.Random(6)
    say = lambda n: " ".join(f"t{r.randrange(10**6)}" for _ in range(n))
    phrase, ends = say(41), [say(60) for _ in range(2)]  # an odd number of shingles: no bit is a tie
    texts = [f"{phrase} " * 400 + e for e in ends]  # one fingerprint, unlike sets
    base = say(200).split()
    alike = [*base]
    alike[100:110] = [f"changed{k}" for k in range(10)]  # a likeness of 0.87, more than three bits away
    texts += [" ".join(base), " ".join(alike), say(90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    linked = {x.doc_id: x.component_id for x in simhash.near_duplicates(docs).collect()}
    likeness = {x.id: x.group_id for x in simhash.similar_groups(docs.withColumnRenamed("doc_id", "id")).collect()}
    assert linked == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4} and likeness == {0: 0, 1: 1, 2: 2, 3: 2, 4: 4}
    assert sorted(x.doc_id for x in simhash.keep_one(docs).collect()) == [0, 2, 4]


def test_nothing_that_grows_is_broadcast(spark, odd, monkeypatch):
    """A small estimate before an explode sent all cells through the driver."""
    plans = []

    def watched(df, name, write=simhash.materialise):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    from pricecast.llm import graph

    monkeypatch.setattr(simhash, "materialise", watched)
    monkeypatch.setattr(graph, "materialise", watched)
    out = simhash.near_duplicates(odd)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert out.count() == odd.count()
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastExchange" in p for p in plans)
