import os
import tempfile
from decimal import Decimal

import pytest

from conftest import D, d, make

from freightlens.sources import apply_defaults, quarantine, read_table, read_view_csv, read_with_rejects, write_view_csv
from freightlens.sources.tables import write_table


def test_csv_round_trip_null_token_crlf_and_boolean_ints(spark):
    df = spark.createDataFrame(
        [(1, d("2024-01-02"), "Alpha", "Utrecht → Lyon", D("10.00"), None, d("2024-01-03"), d("2024-01-04"), 1,
          D("5.00"), D("0.5000"), "Delayed", None, 1),
         (2, d("2024-01-05"), "Beta", "Utrecht → Lyon", D("3.00"), "Textiles", None, None, None,
          D("1.50"), D("0.5000"), "Delivered", "", 0)],
        "shipment_id int, shipment_date date, provider_name string, lane string, weight_kg decimal(10,2), "
        "commodity_type string, promised_delivery date, actual_delivery date, delay_days int, "
        "total_cost_eur decimal(10,2), actual_cost_per_kg decimal(14,4), status string, delay_reason string, "
        "customer_complaint int")
    out = os.path.join(tempfile.mkdtemp(prefix="fl-csv-"), "detail")
    write_view_csv(df, out)
    raw = b"".join(open(os.path.join(out, f), "rb").read() for f in sorted(os.listdir(out)) if f.endswith(".csv"))
    assert b"\r\n" in raw and b"NULL" in raw and "→".encode() in raw
    back = read_view_csv(spark, out, "v_detail").orderBy("shipment_id").collect()
    assert back[0].customer_complaint is True and back[1].customer_complaint is False
    assert back[0].commodity_type is None and back[1].promised_delivery is None
    assert back[0].actual_cost_per_kg == Decimal("0.5000")
    assert back[0].delay_reason is None


def test_defaults_and_typed_table_round_trip(spark):
    df = make(spark, "shipments", [{"shipment_id": 1, "shipment_date": d("2024-01-01"), "customer_complaint": None}])
    assert apply_defaults(df, "shipments").first().customer_complaint is None  # a stored NULL stays
    assert apply_defaults(df.drop("customer_complaint"), "shipments").first().customer_complaint is False
    path = os.path.join(tempfile.mkdtemp(prefix="fl-tab-"), "shipments")
    write_table(df, path)
    write_table(df, path)  # idempotent rebuild
    back = read_table(spark, path, "shipments")
    assert back.count() == 1 and back.first().customer_complaint is None
    assert dict(back.dtypes)["weight_kg"] == "decimal(10,2)"


def test_inline_rows_and_append(spark):
    from freightlens.sources import append_rows, inline_rows

    df = inline_rows(spark, "providers", [{"provider_id": 1, "provider_name": "Alpha Freight"},
                                          (2, "Beta Logistics", None, None, None, False, D("90.00"), None)])
    got = sorted((r.provider_id, r.eu_presence) for r in df.collect())
    assert got == [(1, True), (2, False)]
    path = os.path.join(tempfile.mkdtemp(prefix="fl-app-"), "providers")
    write_table(df, path)
    append_rows(inline_rows(spark, "providers", [{"provider_id": 3, "provider_name": "Gamma Cargo"}]), path)
    assert read_table(spark, path, "providers").count() == 3


def test_core_table_csv_with_zero_one_booleans(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="fl-core-csv-"), "shipments.csv")
    with open(path, "w", newline="") as f:
        f.write("shipment_id,provider_id,route_id,shipment_date,weight_kg,volume_cbm,commodity_type,"
                "promised_delivery,actual_delivery,freight_cost_eur,fuel_surcharge_eur,total_cost_eur,status,"
                "delay_reason,customer_complaint\r\n")
        f.write("1,1,1,2024-01-02,550.00,NULL,Textiles,2024-01-04,2024-01-04,180.00,13.05,193.05,Delivered,NULL,0\r\n")
        f.write("2,1,1,2024-01-03,100.00,NULL,NULL,2024-01-04,2024-01-06,30.00,2.00,32.00,Delayed,Customs,1\r\n")
        f.write("3,1,1,2024-01-03,100.00,NULL,NULL,2024-01-04,2024-01-04,30.00,2.00,32.00,Delivered,NULL,NULL\r\n")
    got = {r.shipment_id: r for r in read_table(spark, path, "shipments", "csv").collect()}
    assert [got[i].customer_complaint for i in (1, 2, 3)] == [False, True, None]
    assert got[2].delay_reason == "Customs" and got[1].delay_reason is None
    assert got[1].total_cost_eur == D("193.05") and got[1].shipment_date == d("2024-01-02")


def test_absent_columns_take_their_default_and_bad_cells_are_errors(spark):
    base = tempfile.mkdtemp(prefix="fl-bad-csv-")

    def read(name, text):
        with open(os.path.join(base, name), "w", newline="") as f:
            f.write(text)
        return read_table(spark, os.path.join(base, name), "shipments", "csv")

    ok = read("a.csv", "shipment_id,shipment_date,total_cost_eur\n1,2024-01-02,5.00\n").first()
    assert ok.customer_complaint is False and ok.status is None and ok.total_cost_eur == D("5.00")
    for bad in ("1,2024-01-02,abc,1\n", "1,2024-01-02,5.00,maybe\n"):
        with pytest.raises(Exception):
            read("b.csv", "shipment_id,shipment_date,total_cost_eur,customer_complaint\n" + bad).collect()
    path = os.path.join(base, "narrow")
    make(spark, "providers", [{"provider_id": 1, "provider_name": "Alpha"}]).select("provider_id", "provider_name").write.parquet(path)
    assert read_table(spark, path, "providers").first().eu_presence is True


HEADER = "shipment_id,provider_id,shipment_date,weight_kg,total_cost_eur,customer_complaint"
GOOD = ["1,1,2024-01-02,550.00,193.05,0", "2,NULL,2024-01-03,NULL,32.00,true", "3,2,2024-01-03,7,32.5,NULL"]
BAD = {"4,1,2024-01-02,abc,5.00,1": ["weight_kg: not decimal(10,2): abc"],
       "5,x,2024-13-02,1.00,5.00,maybe": ["provider_id: not int: x", "shipment_date: not date: 2024-13-02", "customer_complaint: not boolean: maybe"],
       "NULL,1,2024-01-02,1.00,5.00,1": ["shipment_id: missing"],
       "6,1,2024-01-02,1.005,5.00,1": ["weight_kg: not decimal(10,2): 1.005"],
       "7,1,2024-01-02": ["line: not as many cells as the header"],
       "8,1,2024-01-02,1.00,5.00,1,9": ["line: not as many cells as the header"]}


def _csv(lines):
    path = os.path.join(tempfile.mkdtemp(prefix="fl-rej-csv-"), "shipments.csv")
    with open(path, "w", newline="") as f:
        f.write("\r\n".join([HEADER, *lines]) + "\r\n")
    return path


def test_bad_rows_go_to_the_rejects_with_their_reasons(spark):
    lines = [x for pair in zip(GOOD, BAD, strict=False) for x in pair] + list(BAD)[3:]
    path = _csv(lines)
    good, rejects = read_with_rejects(spark, path, "shipments")
    strict = read_table(spark, _csv(GOOD), "shipments", "csv")
    assert good.dtypes == strict.dtypes and sorted(map(str, good.collect())) == sorted(map(str, strict.collect()))
    got = rejects.collect()
    assert sorted(r.reasons for r in got) == sorted(BAD.values())
    assert all(r.file.endswith("shipments.csv") for r in got) and any('"weight_kg":"abc"' in r.line for r in got)
    with pytest.raises(Exception):
        read_table(spark, path, "shipments", "csv").collect()
    for df in (good, rejects):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_quarantine_counts_and_a_repeated_load(spark):
    table = os.path.join(tempfile.mkdtemp(prefix="fl-quar-"), "rejects")
    _, rejects = read_with_rejects(spark, _csv([*GOOD, *BAD]), "shipments")
    for _ in range(2):  # the same load again replaces its rows
        counts = {r.reason: r.rows for r in quarantine(rejects, table, "day1").collect()}
        assert counts == {"weight_kg: not decimal(10,2)": 2, "provider_id: not int": 1, "shipment_date: not date": 1, "customer_complaint: not boolean": 1,
                          "shipment_id: missing": 1, "line: not as many cells as the header": 2}
    quarantine(read_with_rejects(spark, _csv(list(BAD)[:1]), "shipments")[1], table, "day2")
    assert spark.read.parquet(table).groupBy("load").count().orderBy("load").collect() == [("day1", 6), ("day2", 1)]


def test_rejects_of_a_clean_or_empty_file(spark):
    for lines in (GOOD, []):
        good, rejects = read_with_rejects(spark, _csv(lines), "shipments")
        assert (good.count(), rejects.count()) == (len(lines), 0)
