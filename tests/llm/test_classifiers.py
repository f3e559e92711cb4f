import numpy as np
from pricecast.llm import labelled, quality, toxicity
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


def accuracy(scored, labels, label, at):
    both = scored.join(labels, "doc_id").filter("held_out").select((F.col("score") >= at).cast("int").alias("p"), label).collect()
    return np.mean([p == y for p, y in both])


def test_held_out_accuracy(spark):
    from pricecast.llm import queries

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    assert accuracy(queries.QUERIES["op7_quality"](spark, FOLDER), labels, "quality", 0.3) > 0.95
    assert accuracy(queries.QUERIES["op10_toxicity"](spark, FOLDER), labels, "toxic", 0.7) > 0.9


def test_odd_rows_and_missing_labels(spark, odd, none):
    nobody = spark.createDataFrame([(0, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    one_kind = spark.createDataFrame([(0, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    learn = labelled.remainder("doc_id", 5) != 0
    for module in (quality, toxicity):
        for labels in (nobody, one_kind):
            out = module.score(odd, module.fit(odd, labels, learn))
            assert out.count() == odd.count() and out.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
        assert module.score(none, module.fit(none, one_kind, learn)).count() == 0


def test_paths_become_rules(spark):
    tree = "DecisionTree\n  If (feature 0 <= 0.5)\n   If (feature 0 <= 0.2)\n    Predict: 0.0\n   Else (feature 0 > 0.2)\n    Predict: 1.0\n  Else (feature 0 > 0.5)\n   Predict: 1.0\n"
    assert quality.paths(tree) == [((0, "<=", 0.5),), ((0, "<=", 0.2),), ((0, "<=", 0.5), (0, ">", 0.2)), ((0, ">", 0.5),)]
    row = spark.createDataFrame([([0.3],), ([0.7],)], "s array<double>")
    assert [r[0] for r in row.select(quality.rule_column(quality.paths(tree)[2], F.col("s"))).collect()] == [1.0, 0.0]


def test_statistics():
    x = quality.statistics_of([None, b"", b"Ab cd ab\nAB 12 !!", b"a a a a a"])
    s = quality.STATISTICS
    assert not x[0].any() or x[0].tolist() == x[1].tolist()
    assert x[2][s.index("n_words")] == 6 and x[2][s.index("mean_line")] == 3 and x[2][s.index("digit_share")] == 2 / 12
    assert x[3][s.index("distinct_share")] == 0.2 and x[3][s.index("repeat_share")] == 0.8


def test_label_model_finds_accurate_voters():
    r = np.random.default_rng(3)
    y = r.random(4000) < 0.2
    good = [np.where(y, r.random(4000) < 0.8, r.random(4000) < 0.02).astype(np.int8) for _ in range(4)]
    noise = (r.random(4000) < 0.3).astype(np.int8)
    votes = np.column_stack([*good, noise, noise, noise])
    model = toxicity.fit_label_model(votes)
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95
    assert model.weight[4] < 0.5 < model.weight[0]
