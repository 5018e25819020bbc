"""Cases that bounded forms of operators used to lose."""

from datetime import date

from marketloom.operators import asof, intraday, news


def test_snap_far_outside_the_calendar(spark):
    sessions = spark.createDataFrame([(date(2020, 1, 2), 1), (date(2020, 1, 6), 2)], "date date, day_idx int")
    dates = spark.createDataFrame([(date(1999, 1, 1),), (date(2020, 1, 1),), (date(2020, 1, 3),), (date(2020, 1, 6),), (date(2031, 1, 1),), (None,)], "d date")
    forward = {r.d: r.day_idx for r in asof.snap_to_session(dates, "d", sessions).collect()}
    assert forward == {date(1999, 1, 1): 1, date(2020, 1, 1): 1, date(2020, 1, 3): 2, date(2020, 1, 6): 2, date(2031, 1, 1): None, None: None}
    backward = {r.d: r.day_idx for r in asof.snap_to_session(dates, "d", sessions, direction="backward").collect()}
    assert backward == {date(1999, 1, 1): None, date(2020, 1, 1): None, date(2020, 1, 3): 1, date(2020, 1, 6): 2, date(2031, 1, 1): 2, None: None}


def test_names_of_any_length(spark):
    nine = "Royal North East Harbour Light Rail And Tram"
    docs = spark.createDataFrame([(1, f"Yesterday {nine.upper()}, said so."), (2, nine.removesuffix(" Tram")), (3, "tram " * 3), (4, None), (5, "light rail")], "doc_id long, text string")
    names = spark.createDataFrame([(7, nine, None), (8, "tram", "TRAM"), (9, "light rail", None), (10, "", None)], "symbol long, name string, ticker string")
    got = {tuple(r) for r in news.named_in(docs, names).collect()}
    assert got == {(1, 7), (1, 8), (1, 9), (2, 9), (3, 8), (5, 9)}


def test_verified_attribution(spark):
    names = spark.createDataFrame([(1, "Mane Corp.", "MANE"), (2, "The Bagmane Group", "BAGM"), (3, None, "ALL"), (4, "Allstate Holdings", "ALL"), (5, "X", "X"), (6, "Quiet Sea Limited", None)], "symbol long, name string, ticker string")
    docs = [
        (1, "Bagmane grows", None), (2, "MANE grows", None), (3, "MANE, or Mane, grows", None), (4, "$mane.A grows", None), (5, "Mane grows", 1), (6, "nothing here", 1), (7, "ALL of Allstate", None), (8, "$ALL", None), (9, "$X X", 5), (10, "quiet sea", 6),
        (11, "BAGMANE $BAGM", None), (12, None, 2), (13, "XMANE MANE1 _MANE_", None),
    ]
    got = {(r.doc_id, r.symbol): r.method for r in news.verified(spark.createDataFrame(docs, "doc_id long, text string, tag long"), names).collect()}
    assert got == {
        (2, 1): "ticker+name", (3, 1): "ticker+name", (4, 1): "name", (5, 1): "name", (6, 1): "rejected", (7, 3): "rejected", (7, 4): "name", (8, 3): "cashtag", (8, 4): "cashtag", (9, 5): "cashtag", (10, 6): "name",
        (11, 2): "ticker+name", (12, 2): "rejected", (13, 1): "ticker+name",
    }


def test_value_area_of_any_bins(spark):
    df = spark.createDataFrame([([1.0, 5.0, 9.0, 2.0],)], "h array<double>")
    r = df.select(intraday.value_area("h").alias("a")).first().a
    assert (r.low, r.high) == (1, 2)
