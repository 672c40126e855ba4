import csv
from datetime import date
from decimal import Decimal

import pytest

from tablewarden.operators import normalise
from tablewarden.schemas import BOOKING_COLUMNS, DROPPED_COLUMNS, GUEST_COLUMNS
from tablewarden.sources import bars_csv, bookings

# one good row, by column
GOOD = dict(
    zip(
        BOOKING_COLUMNS,
        "City Hotel,0,342,2015,July,27,1,0,2,2,1,0,BB,PRT,Direct,Direct,0,0,0,C,C,3,No Deposit,9,14,0,Transient,12.345,0,1,"
        "Check-Out,2015-07-01".split(","),
    )
)


def _write(path, rows, names=None):
    names = list(names or BOOKING_COLUMNS)
    path.parent.mkdir(exist_ok=True)
    lines = [",".join(names)]
    for row in rows:
        lines.append(row if isinstance(row, str) else ",".join(row[n] for n in names))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def _line(**changed):
    return {**GOOD, **changed}


def _load(spark, tmp_path, rows, names=None):
    _write(tmp_path / "in.csv", rows, names)
    out = str(tmp_path / "out")
    bookings.load(spark, str(tmp_path / "in.csv"), out)
    return spark.read.parquet(out)


def test_good_row(spark, tmp_path):
    row = bookings.good(_load(spark, tmp_path, [GOOD])).first()
    assert row.adr == Decimal("12.35") and row.children == 1 and row.reservation_status_date == date(2015, 7, 1)
    assert row.agent == "9" and row.lead_time == 342 and row.id is not None


def test_null_words_count_only_in_three_columns(spark, tmp_path):
    rows = [_line(children=w, agent=w, company=w, country=w, meal=w) for w in ("NULL", "NA", "")]
    got = bookings.good(_load(spark, tmp_path, rows)).orderBy("id").collect()
    assert [(r.children, r.agent, r.company) for r in got] == [(None, None, None)] * 3
    assert [(r.country, r.meal) for r in got] == [("NULL", "NULL"), ("NA", "NA"), ("", "")]


BAD = {
    "lead_time: not an integer": _line(lead_time=""),
    "babies: not an integer": _line(babies="1.5"),
    "is_canceled: not an integer": _line(is_canceled="9999999999"),
    "adr: not a number": _line(adr="abc"),
    "adr: out of range": _line(adr="123456789"),
    "children: not a number": _line(children="two"),
    "reservation_status_date: not a date": _line(reservation_status_date="2017-02-30"),
    "hotel: too long": _line(hotel="H" * 51),
}


def test_each_fault_has_its_reason_and_the_load_goes_on(spark, tmp_path):
    loaded = _load(spark, tmp_path, [*BAD.values(), GOOD, _line(hotel="H" * 51, adr="x")])
    rejects = bookings.rejected(loaded)
    want = {**{r: 1 for r in BAD}, "adr: not a number": 2}
    assert {r.reason: r.hata_sayisi for r in bookings.reject_counts(rejects).collect()} == want
    assert {r.status: r["count"] for r in bookings.load_counts(loaded).collect()} == {"good": 1, "rejected": 9}
    first = bookings.first_rejects(rejects).collect()
    assert [r.reason for r in first] == list(BAD)[:5]


def test_bare_year_and_empty_date_are_faults(spark, tmp_path):
    rows = [_line(reservation_status_date="2017"), _line(reservation_status_date="")]
    assert bookings.rejected(_load(spark, tmp_path, rows)).count() == 2


def test_blanks_beyond_the_length_are_cut(spark, tmp_path):
    row = bookings.good(_load(spark, tmp_path, [_line(hotel="H" * 50 + "  ")])).first()
    assert row.hotel == "H" * 50


def test_short_and_long_rows(spark, tmp_path):
    whole = ",".join(GOOD.values())
    short_text = whole.rsplit(",", 2)[0]  # text and date absent: null
    short_int = whole.rsplit(",", 3)[0]  # a whole number absent: rejected
    empty_tail = whole.rsplit(",", 2)[0] + ",,2015-07-01"  # present but empty: stays empty
    loaded = _load(spark, tmp_path, [short_text, short_int, empty_tail, whole + ",more,again"])
    good = bookings.good(loaded).orderBy("id").collect()
    assert [(r.reservation_status, r.reservation_status_date) for r in good] == [
        (None, None),
        ("", date(2015, 7, 1)),
        ("Check-Out", date(2015, 7, 1)),
    ]
    assert bookings.rejected(loaded).first().reason == "total_of_special_requests: not an integer"


def test_quotes_and_blank_lines(spark, tmp_path):
    row = ",".join(f'"{v}"' if n == "hotel" else v for n, v in _line(hotel="City, Hotel").items())
    loaded = _load(spark, tmp_path, [row, "", GOOD])
    assert {r.hotel for r in bookings.good(loaded).collect()} == {"City, Hotel", "City Hotel"}
    assert loaded.count() == 2


def test_columns_are_matched_by_name(spark, tmp_path):
    names = list(reversed(BOOKING_COLUMNS))
    row = bookings.good(_load(spark, tmp_path, [GOOD], names)).first()
    assert row.hotel == "City Hotel" and row.adr == Decimal("12.35")
    _write(tmp_path / "more" / "a.csv", [GOOD])
    _write(tmp_path / "more" / "b.csv", [GOOD], names)
    with pytest.raises(Exception, match="header"):
        bookings.typed(bookings.read_strings(spark, str(tmp_path / "more"))).collect()
    (tmp_path / "other.csv").write_text("hotel,adr\nx,1\n")
    with pytest.raises(ValueError, match="lead_time"):
        bookings.read_strings(spark, str(tmp_path / "other.csv"))


def test_lines_and_files_agree(spark, tmp_path):
    rows = [*BAD.values(), GOOD, _line(country="", agent="NA")]
    whole = [",".join(r.values()) for r in rows] + [",".join(GOOD.values()).rsplit(",", 2)[0]]
    _write(tmp_path / "in.csv", whole)
    a = bookings.typed(bookings.read_strings(spark, str(tmp_path / "in.csv")))
    b = bookings.typed(bookings.strings_from_lines(spark.createDataFrame([(w,) for w in whole], "line string")))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


def test_reload_replaces_and_append_adds(spark, tmp_path):
    assert bookings.rejected(_load(spark, tmp_path, list(BAD.values()))).count() == len(BAD)
    loaded = _load(spark, tmp_path, [GOOD])
    assert bookings.rejected(loaded).count() == 0 and bookings.good(loaded).count() == 1
    target = str(tmp_path / "target")
    for _ in range(2):
        bookings.append(bookings.good(loaded), target)
    assert spark.read.parquet(target).count() == 2


def test_reject_report_reads_files_directly(spark, tmp_path):
    _write(tmp_path / "in.csv", list(BAD.values()))
    rows = bookings.typed(bookings.read_strings(spark, str(tmp_path / "in.csv")))
    assert bookings.reject_counts(rows.where("reason is not null")).count() == len(BAD)


def test_normalise(spark, tmp_path):
    loaded = bookings.good(_load(spark, tmp_path, [GOOD, *BAD.values(), GOOD]))
    guests, stays = normalise.guests(loaded, "secret"), normalise.reservations(loaded)
    assert guests.count() == stays.count() == 2
    assert stays.join(guests, "musteri_id", "left_anti").count() == 0
    assert guests.columns == ["musteri_id", "ulke", "musteri_tipi", "tekrar_misafir", "kredi_karti"]
    assert len(stays.columns) == 2 + len(BOOKING_COLUMNS) - len(GUEST_COLUMNS) - len(DROPPED_COLUMNS) == 29
    assert "Exchange" not in stays._jdf.queryExecution().executedPlan().toString()


TEXTS = ['say "hi", you', "q", '"q"', "a, b\\", "back\\slash", 'one " quote']


def _python_csv(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows(rows)


def test_quoted_texts_are_those_of_python(spark, tmp_path):
    names = list(BOOKING_COLUMNS)
    rows = [list(_line(hotel=t).values()) for t in TEXTS]
    _python_csv(tmp_path / "in.csv", [names, *rows])
    lines = spark.read.text(str(tmp_path / "in.csv")).where("not value like 'hotel,%'").toDF("line")
    broken = [list(_line(hotel="two\nlines").values())]
    _python_csv(tmp_path / "broken.csv", [names, *rows, *broken])
    for strings, want in (
        (bookings.read_strings(spark, str(tmp_path / "in.csv")), TEXTS),
        (bookings.strings_from_lines(lines), TEXTS),
        (bookings.read_strings(spark, str(tmp_path / "broken.csv"), multi_line=True), [*TEXTS, "two\nlines"]),
    ):
        typed = bookings.typed(strings).collect()
        assert sorted(r.hotel for r in typed) == sorted(want) and not any(r.reason for r in typed)
    cut = bookings.typed(bookings.read_strings(spark, str(tmp_path / "broken.csv"))).collect()
    assert sorted(r.hotel for r in cut if not r.reason) == sorted(TEXTS)
    assert sum(1 for r in cut if r.reason) == 2


def test_quoted_bars(spark, tmp_path):
    head = ["date", "open", "high", "low", "close", "volume", "Name"]
    row = ["2013-02-08", "1", "2", "1", "2", "5"]
    symbols = ['A"B', "A,B", "A\\", "AB"]
    _python_csv(tmp_path / "in.csv", [head, *[[*row, s] for s in symbols]])
    path = str(tmp_path / "in.csv")
    lines = bars_csv.raw_lines(spark.read, path)
    for bars in (bars_csv.read_bars(spark, path), bars_csv.read_bars(spark, path, multi_line=True), bars_csv.bars_from_lines(lines)):
        assert sorted(r.symbol for r in bars.collect()) == sorted(symbols)
    (tmp_path / "open.csv").write_text(",".join(head) + "\n" + ",".join(row) + ',"AB\n')
    with pytest.raises(Exception, match="quoted"):
        bars_csv.read_bars(spark, str(tmp_path / "open.csv")).collect()


def test_ids_go_on_over_appended_loads(spark, tmp_path):
    _write(tmp_path / "in.csv", [GOOD, _line(adr="2")])
    out = str(tmp_path / "out")
    for _ in range(3):
        bookings.load(spark, str(tmp_path / "in.csv"), out, mode="append")
    assert [r.id for r in spark.read.parquet(out).orderBy("id").collect()] == sorted({r.id for r in spark.read.parquet(out).collect()})
    assert spark.read.parquet(out).select("id").distinct().count() == 6


def test_a_load_counts_its_outcomes_while_it_writes(spark, tmp_path):
    rows = [*BAD.values(), GOOD, GOOD, _line(hotel="H" * 51, adr="x"), _line(babies="")]
    _write(tmp_path / "in.csv", rows)
    out = str(tmp_path / "out")
    counts = bookings.load(spark, str(tmp_path / "in.csv"), out)
    loaded = spark.read.parquet(out)
    rejects = {r.reason: r.hata_sayisi for r in bookings.reject_counts(bookings.rejected(loaded)).collect()}
    assert counts == {"good": 2, **rejects} and set(rejects) <= set(bookings.possible_reasons())
    assert sum(counts.values()) == loaded.count() == len(rows)
    again = bookings.load(spark, str(tmp_path / "in.csv"), out, mode="append")
    assert again == counts
    _write(tmp_path / "none.csv", [])
    assert bookings.load(spark, str(tmp_path / "none.csv"), str(tmp_path / "empty")) == {}


def test_lines_are_parsed_by_compiled_steps(spark, tmp_path):
    (tmp_path / "in.csv").write_text("\n".join([",".join(BOOKING_COLUMNS), ",".join(GOOD.values())]) + "\n")
    rows = bookings.typed(bookings.read_strings(spark, str(tmp_path / "in.csv")))
    steps = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate explode" in line]
    assert len(steps) > 4 and all("*(" in line.split("Generate")[0] for line in steps)


def test_a_load_counts_with_one_aggregate(spark, tmp_path, monkeypatch):
    seen = []
    frame = type(spark.range(0))
    observe = frame.observe
    monkeypatch.setattr(frame, "observe", lambda self, o, *e: seen.append(len(e)) or observe(self, o, *e))
    faults = {"adults": "x", "lead_time": "y", "adr": "z", "reservation_status_date": "2017-02-30"}
    lines = [",".join({**GOOD, **({c: faults[c]} if c else {})}.values()) for c in (None, None, *faults, "adr")]
    (tmp_path / "in.csv").write_text("\n".join([",".join(BOOKING_COLUMNS), *lines]) + "\n")
    want = {"good": 2, "adults: not an integer": 1, "lead_time: not an integer": 1, "adr: not a number": 2, "reservation_status_date: not a date": 1}
    assert bookings.load(spark, str(tmp_path / "in.csv"), str(tmp_path / "out")) == want
    (tmp_path / "none.csv").write_text(",".join(BOOKING_COLUMNS) + "\n")
    assert bookings.load(spark, str(tmp_path / "none.csv"), str(tmp_path / "empty")) == {}
    assert seen == [1, 1]
