import zipfile

from pyspark.sql import functions as F

from ledgerlens import cli
from ledgerlens.operators import scorecard as S
from ledgerlens.plans.holdings import holdings
from ledgerlens.sources import readers, sinks
from ledgerlens.streaming.deltas import fill_counters, landing


def test_vendor_csv(spark, tmp_path):
    path = tmp_path / "v.csv"
    path.write_text("Fund Allocator ID,As At Date,Current Cost,Source Asset,Current Cost Unit\n3.95E+42,31-Mar-26,12.5,Acme,USD\n0042,bad,NaN,,USD\n")
    rows = readers.vendor_csv(spark, str(path)).orderBy("fund_id").collect()
    assert [(r["fund_id"], str(r["as_at_date"]), r["current_cost"], r["source_asset"]) for r in rows] == [("0042", "None", None, None), ("3.95E+42", "2026-03-31", 12.5, "Acme")]
    assert readers.fund_slice(readers.vendor_csv(spark, str(path)), "0042", ["source_asset", "nothing"]).columns == ["source_asset", "as_of_iso"]


def test_roundtrip(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, ["a"]), (2, "x\x01y", [])], "a int, b string, c array<string>")
    sinks.jsonl(rows, str(tmp_path / "j"))
    assert sorted(readers.jsonl(spark, str(tmp_path / "j"), rows.schema).collect()) == sorted(rows.collect())
    assert readers.jsonl(spark, str(tmp_path / "none"), rows.schema).count() == 0
    sinks.csv_report(rows.select("a", "b"), str(tmp_path / "c"), single=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    sinks.workbook({"Sheet": rows, "A very long name of more than thirty-one": rows.limit(0)}, str(tmp_path / "w.xlsx"))
    with zipfile.ZipFile(tmp_path / "w.xlsx") as z:
        assert b"xy" in z.read("xl/worksheets/sheet1.xml") and len(z.namelist()) == 6


def test_lines_and_cells(spark):
    words = spark.createDataFrame([("d", 1, 0, "b", 50.0, 10.1, 55.0, 12.0), ("d", 1, 1, "a", 5.0, 9.9, 9.0, 12.0), ("d", 1, 2, "c", 5.0, 20.0, 9.0, 22.0)], "doc_id string, page int, word_no int, text string, x0 double, top double, x1 double, bottom double")
    assert [r["text"] for r in readers.lines_of(words).orderBy("line_no").collect()] == ["a b", "c"]
    assert [(r["row_index"], r["col_index"], r["text"]) for r in readers.grid_cells(words, [30.0]).orderBy("row_index", "col_index").collect()] == [(0, 0, "a"), (0, 1, "b"), (1, 0, "c")]


def test_stream_adds_up(spark, sf_dir, tmp_path):
    panel = holdings(spark, sf_dir).withColumn("arrived", F.col("as_at_date").cast("timestamp"))
    panel.write.parquet(str(tmp_path / "in"))
    stream = fill_counters(landing(spark, str(tmp_path / "in"), panel.schema), "arrived")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("fills").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("fills").agg(F.sum("n_rows"), F.sum("filled_cells")).first()
    want = S.scorable(panel).agg(F.count("*"), F.sum(S.filled())).first()
    assert tuple(got) == tuple(want)


def test_cli_options():
    args = cli.parser().parse_args(["extract", "--rows", "a", "--out", "b"])
    assert (args.command, args.rows, args.out) == ("extract", "a", "b")
