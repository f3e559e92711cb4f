import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricecast.functions.numeric import clamp_denominator, finite_or_zero, metric_ok, pct_change
from pricecast.functions.text import parse_history, percent_to_number, to_date, to_number, volume_to_number
from pricecast.operators.clean import clean_bars, cleaning_report
from pricecast.sources import files

INF = float("inf")


def column(spark, values, fn, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_volume(spark):
    given = ["1.5K", "2,300.1m", "1B", "", None, "-", "1.5KM", "12", "1.5 K", "12d", "nan", "1_000"]
    want = [1500.0, 2300100000.0, 1e9, 0.0, 0.0, None, None, 12.0, 1500.0, None, None, None]
    assert column(spark, given, volume_to_number) == want


def test_percent_and_number(spark):
    assert column(spark, ["-1,2.5%", " 3 %", "x%", None], percent_to_number) == [-12.5, 3.0, None, None]
    assert column(spark, ["1,234.5", "1e3", "12d", " .5 ", "5."], to_number) == [None, 1000.0, None, 0.5, 5.0]


def test_dates(spark):
    got = column(
        spark,
        ["2024-03-01", "12/31/2023", "2024-13-40", "2024-3-1", "", None, "2023-02-29"],
        lambda c: to_date(c, ("yyyy-MM-dd", "MM/dd/yyyy")),
    )
    assert got == [dt.date(2024, 3, 1), dt.date(2023, 12, 31), None, None, None, None, None]
    both = column(spark, ["13/02/2024", "02/03/2024"], lambda c: to_date(c, ("MM/dd/yyyy", "dd/MM/yyyy")))
    assert both == [dt.date(2024, 2, 13), dt.date(2024, 2, 3)]
    assert column(spark, ["Mar 05, 2024"], lambda c: to_date(c, ("MMM dd, yyyy",))) == [dt.date(2024, 3, 5)]


def test_history_text(spark):
    assert column(spark, ["1, 2,,x,3", ""], parse_history) == [[1.0, 2.0, 3.0], []]


def test_guards(spark):
    nan = float("nan")
    assert column(spark, [0.0, -1e-9, 2.0], clamp_denominator, "double") == [1e-8, 1e-8, 2.0]
    assert column(spark, [nan, INF, None, 1.5], finite_or_zero, "double") == [0.0, 0.0, 0.0, 1.5]
    assert column(spark, [0.0, 5.0], lambda c: pct_change(F.lit(5.0), c), "double") == [INF, 0.0]
    assert column(spark, [0.0], lambda c: pct_change(F.lit(0.0), c), "double") == [None]
    assert column(spark, [nan, None, 0.995], lambda c: metric_ok(c, 0.99, False), "double") == [False, False, True]


ROWS = [
    # Thursday, Friday, Saturday, Monday, repeated Monday, bad price, bad date, Tuesday
    ("2024-01-04", "10", "", "11", "9", "1K", "1%"),
    ("2024-01-05", "11", "10.5", "12", "10", "-", "2%"),
    ("2024-01-06", "99", "99", "99", "99", "9K", "9%"),
    ("2024-01-08", "12", "11.5", "13", "11", "2K", ""),
    ("2024-01-08", "13", "", "14", "12", "3K", "3%"),
    ("2024-01-09", "1,234.5", "1", "1", "1", "1", "1%"),
    ("2024-13-40", "12", "1", "1", "1", "1", "1%"),
    ("2024-01-10", "14", "13.5", "15", "", "", "4%"),
]
HEADER = "Date, Price ,Open,High,Low,Vol.,Change %"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "bars.csv"
    lines = [",".join(f'"{c}"' if "," in c else c for c in r) for r in ROWS]
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return files.read_raw_bars(spark, str(path), "s")


def test_clean_bars(raw):
    got = {r.date.isoformat(): r for r in clean_bars(raw).collect()}
    assert sorted(got) == ["2024-01-04", "2024-01-05", "2024-01-08", "2024-01-10"]
    assert got["2024-01-04"].open == 10.5  # leading gap takes the next value
    assert got["2024-01-08"].price == 13.0 and got["2024-01-08"].open == 10.5  # last row; Saturday feeds nothing
    assert got["2024-01-05"].vol == 0.0 and got["2024-01-10"].vol == 0.0
    assert got["2024-01-10"].low == 12.0
    report = cleaning_report(raw, clean_bars(raw)).first()
    assert (report.original_rows, report.cleaned_rows, report.dropped_rows) == (8, 4, 4)


def test_missing_column_and_path(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="Low"):
        clean_bars(raw.drop("Low"))
    with pytest.raises(Exception):
        files.read_raw_bars(spark, str(tmp_path / "none.csv"))


def test_ingest_and_stage_files(spark, raw, tmp_path):
    src = tmp_path / "in.csv"
    src.write_text(HEADER + "\n2024-01-04,1,1,1,1,1,1%\n")
    report = files.ingest(spark, str(src), str(tmp_path / "raw")).first()
    assert (report.n_rows, report.n_columns) == (1, 7)
    clean = clean_bars(raw)
    files.write_stage(clean, str(tmp_path / "clean"), ("series_id",))
    assert files.read_stage(spark, str(tmp_path / "clean")).count() == 4
    files.write_stage(clean, str(tmp_path / "csv"), as_csv=True)
    assert "Change %" in spark.read.csv(str(tmp_path / "csv"), header=True).columns
    files.write_report(clean.limit(1).select(F.struct("price").alias("bar")), str(tmp_path / "report"))
    assert files.read_report(spark, str(tmp_path / "report"), "bar struct<price:double>").first().bar.price > 0


def lineitem(spark, folder):
    """A small table of line items on which every kind of cell comes up."""
    rows = [
        (k, k % 50, k % 9, k % 7 + 1, float(k % 50), 1000.0 + k, (k % 11) / 100, (k % 9) / 100, "ANR"[k % 3], "FO"[k % 2], dt.datetime(2020, 1, 1) + dt.timedelta(days=k % 600))
        for k in range(1800)
    ]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame(rows, names + ", l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_parsing_behind_a_filter_stays_compiled(spark, tmp_path):
    """The JVM runs methods of over 8,000 bytes interpreted; the filters repeat the parsing of what they test."""
    from pricecast.operators import clean
    from pricecast.sources.tables import raw_bar_text

    parsed = clean.parse_bars(raw_bar_text(spark, lineitem(spark, tmp_path)))
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    codes = getattr(getattr(debug, "package$"), "MODULE$")
    for df in (clean.drop_unusable(parsed), clean.weekdays(clean.drop_unusable(parsed))):
        made = codes.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        assert max([made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())], default=0) < 8000


def test_panels_that_are_read_often_do_not_lead_back_to_trades(spark, tmp_path):
    from pricecast.plans import frames

    folder = lineitem(spark, tmp_path)
    for panel in (frames.split_bars(spark, folder), frames.split_features(spark, folder)):
        assert panel.count() > 0 and not any("lineitem" in name for name in panel.inputFiles())
