"""CSV ingest with quarantine, presence gate, layer routing."""

import os

import pytest
from pyspark.sql import functions as F

from stratum import fixed
from stratum.operators.quality import GateError
from stratum.sources.csv import read_csv_positional
from stratum.sources.presence import require_sources, source_presence
from stratum.sources.tables import layer_name, layer_path, write_table

HEADER = "listing_id,review_id,date,reviewer_id"


def _write(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def test_csv_dialect_and_quarantine(spark, scratch):
    body = "\n".join([
        'listing_id,name,city',                    # header names are ignored
        '1,"Loft, with ""view""",Paris',            # quoted comma and doubled quote
        '2,NA,NULL',                                # null tokens
        '3,,null',                                  # empty field
        '4,too,many,fields',                        # malformed: extra field
        '5,short',                                  # malformed: missing field
        '6,"",Rome',                                # quoted empty string
    ]) + "\n"
    path = _write(scratch, "Listings_utf8.csv", body)
    good, rejects = read_csv_positional(spark, path, ("listing_id", "name", "city"),
                                        stage_to=os.path.join(scratch, "parsed"))
    rows = {r.listing_id: (r.name, r.city) for r in good.collect()}
    assert rows == {"1": ('Loft, with "view"', "Paris"), "2": (None, None), "3": (None, None),
                    "6": (None, "Rome")}
    bad = sorted(r.listing_id for r in rejects.collect())
    assert bad == ["4", "5"]
    assert all(r.line for r in rejects.collect())


def test_csv_embedded_newline_needs_multiline(spark, scratch):
    path = _write(scratch, "Listings_utf8.csv", 'listing_id,name\n1,"two\nlines"\n2,plain\n')
    good, rejects = read_csv_positional(spark, path, ("listing_id", "name"), multiline=True)
    assert {r.listing_id: r.name for r in good.collect()} == {"1": "two\nlines", "2": "plain"}
    assert rejects.count() == 0


def test_csv_latin1(spark, scratch):
    path = _write(scratch, "Listings.csv", "listing_id,name\n1,Café\n", encoding="latin-1")
    good, _ = read_csv_positional(spark, path, ("listing_id", "name"), encoding="ISO-8859-1")
    assert good.first().name == "Café"


def test_presence_gate(spark, scratch):
    _write(scratch, "Listings_utf8.csv", "a\n1\n")
    with pytest.raises(GateError, match="Reviews_utf8.csv"):
        require_sources(spark, scratch)
    _write(scratch, "Reviews_utf8.csv", "a\n1\n")
    require_sources(spark, scratch)
    got = {r.required_name: r.present for r in source_presence(spark, scratch).collect()}
    assert got == {n: True for n in fixed.REQUIRED_SOURCES}
    empty = os.path.join(scratch, "empty")
    os.makedirs(empty)
    with pytest.raises(GateError, match="no files"):
        require_sources(spark, empty)


def test_layer_routing_and_full_refresh(spark, scratch):
    assert layer_name("  gold ") == "GOLD" and layer_name(None) == "DEFAULT"
    assert layer_path("/x/", "silver", "t") == "/x/SILVER/t"
    df = spark.range(5)
    write_table(df, scratch, "bronze", "t")
    again = write_table(df, scratch, "bronze", "t")   # overwrite, not append
    assert again.count() == 5


def test_csv_named_scan_for_profiling(spark, scratch):
    path = _write(scratch, "Listings_utf8.csv", 'city,price\nParis,"$1,200"\nRome,NA\n')
    from stratum.sources.csv import read_csv_named
    df = read_csv_named(spark, path)
    assert df.columns == ["city", "price"]
    assert [tuple(r) for r in df.collect()] == [("Paris", "$1,200"), ("Rome", "NA")]


def test_command_line_profile(spark, scratch):
    from stratum.__main__ import main
    path = _write(scratch, "Listings_utf8.csv", "city,price\nParis,80\nAtlantis,NA\nParis,80\n")
    out = os.path.join(scratch, "profile")
    assert main(["profile", path, out, "--name", "listings"]) == 0
    report = spark.read.parquet(out)
    got = {(r.section, r.metric): r.amount for r in report.collect() if r.column_name in (None, "city")
           and r.value in (None, "Atlantis")}
    assert got[("shape", "rows")] == 3.0 and got[("duplicates", "duplicate_rows")] == 1.0
    assert got[("coverage", "rows")] == 1.0


def test_materialize_writes_fresh_parquet_and_cuts_lineage(spark):
    from stratum.sources.tables import materialize
    df = spark.range(100).withColumn("sq", F.col("id") * F.col("id"))
    a, b = materialize(df), materialize(df)
    assert a.inputFiles() and set(a.inputFiles()).isdisjoint(b.inputFiles())   # a new folder per call
    assert "Range" not in a._jdf.queryExecution().optimizedPlan().toString()    # reads files, not the plan
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, df.collect()))


def test_quoted_line_breaks_stay_in_their_field(spark, scratch):
    import os
    from stratum.sources.csv import read_csv_named, read_csv_positional
    path = os.path.join(scratch, "l.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('a,b\n1,"two\nlines, ""quoted"""\n2,plain\n3,x,too many\n')
    good, rejects = read_csv_positional(spark, path, ("a", "b"))
    assert sorted(map(tuple, good.collect())) == [("1", 'two\nlines, "quoted"'), ("2", "plain")]
    assert [r.a for r in rejects.collect()] == ["3"]
    assert read_csv_named(spark, path).where("a = '1'").first().b == 'two\nlines, "quoted"'


def test_a_session_without_a_shared_folder_is_an_error():
    import pytest
    from stratum.session import shared_dir

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")
