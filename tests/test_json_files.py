import json

import pytest
from pyspark.errors import AnalysisException

from daybook.params import DATE_TIME_FORMAT, PipelineParams
from daybook.plans.staging import bookings_plan
from daybook.schemas import BOOKINGS_RAW, CUSTOMERS_RAW
from daybook.sources.json_files import read_bookings, read_customers, write_json
from tests.helpers import GOOD_BOOKING, GOOD_CUSTOMER, bag, bookings, customers, ids, plan


def saved(tmp_path, text):
    path = tmp_path / "day.json"
    path.write_text(text)
    return str(path)


RECORDS = [{**GOOD_BOOKING, "booking_id": f"B{i}"} for i in range(3)]


def test_one_array_on_one_line(spark, tmp_path):
    df = read_bookings(spark, saved(tmp_path, json.dumps(RECORDS)))
    assert df.schema == BOOKINGS_RAW
    assert ids(df, "booking_id") == ["B0", "B1", "B2"]


def test_one_record_per_line(spark, tmp_path):
    df = read_bookings(spark, saved(tmp_path, "\n".join(map(json.dumps, RECORDS))))
    assert ids(df, "booking_id") == ["B0", "B1", "B2"]


def test_pretty_printed_needs_multi_line(spark, tmp_path):
    path = saved(tmp_path, json.dumps(RECORDS, indent=2))
    assert ids(read_bookings(spark, path, multi_line=True), "booking_id") == ["B0", "B1", "B2"]
    assert all(r.booking_id is None for r in read_bookings(spark, path).collect())


def test_folder_of_part_files(spark, tmp_path):
    for i, record in enumerate(RECORDS):
        (tmp_path / f"part-{i}.json").write_text(json.dumps([record]))
    assert read_bookings(spark, str(tmp_path)).count() == 3


def test_extra_missing_and_mistyped_values(spark, tmp_path):
    records = [
        {"booking_id": 7, "extra": 1},
        {"booking_id": "b", "total_amount": "12.5"},
        {"booking_id": "c", "total_amount": "abc"},
        {"booking_id": "d", "total_amount": 3},
    ]
    df = read_bookings(spark, saved(tmp_path, "\n".join(map(json.dumps, records))))
    rows = {r.booking_id: r for r in df.collect()}
    assert set(rows) == {"7", "b", "c", "d"}
    assert rows["7"].customer_id is None
    assert [rows[k].total_amount for k in "bcd"] == [None, None, 3.0]


def test_malformed_line_becomes_nulls(spark, tmp_path):
    df = read_customers(spark, saved(tmp_path, json.dumps(GOOD_CUSTOMER) + "\n{oops\n"))
    assert sorted(r.customer_id or "" for r in df.collect()) == ["", "C1"]


def test_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_bookings(spark, str(tmp_path / "none.json"))


def test_round_trip_keeps_nulls(spark, tmp_path):
    df = bookings(spark, {}, {"status": None}, {"total_amount": None, "end_time": None})
    write_json(df, f"{tmp_path}/out.json")
    assert bag(read_bookings(spark, f"{tmp_path}/out.json")) == bag(df)
    parts = (tmp_path / "out.json").glob("part-*.json")
    lines = [line for part in parts for line in part.read_text().splitlines()]
    assert len(lines) == 3
    assert {tuple(sorted(json.loads(line))) for line in lines} == {tuple(sorted(BOOKINGS_RAW.names))}


def test_customers_round_trip(spark, tmp_path):
    df = customers(spark, {}, {"email": None})
    write_json(df, f"{tmp_path}/out.json")
    back = read_customers(spark, f"{tmp_path}/out.json")
    assert back.schema == CUSTOMERS_RAW
    assert bag(back) == bag(df)


def test_input_path():
    params = PipelineParams("20241017", "s3a://feed/staging/")
    assert params.input_path("bookings") == "s3a://feed/staging/bookings_20241017.json"
    prefixed = PipelineParams("20241017", "/in", file_prefix="cars_")
    assert prefixed.input_path("customers") == "/in/cars_customers_20241017.json"


def test_params_from_job_strings():
    params = PipelineParams.from_mapping(
        {
            "date": "20241017",
            "path": "/in/",
            "bookings_delta_table": "main.sales.bookings",
            "multi_line": "true",
            "broadcast_limit_bytes": "1024",
        }
    )
    assert params.bookings_delta_table == "main.sales.bookings"
    assert params.multi_line is True
    assert params.broadcast_limit_bytes == 1024
    assert params.date_time_format == DATE_TIME_FORMAT


@pytest.mark.parametrize(
    "values",
    [
        {"date": "2024-10-17", "path": "/in"},
        {"date": "*", "path": "/in"},
        {"date": "20241017", "path": "/in", "colour": "red"},
        {"date": "20241017", "path": "/in", "multi_line": "maybe"},
        {"date": "20241017", "path": "/in", "target_mode": "magic"},
    ],
)
def test_bad_params(values):
    with pytest.raises(ValueError):
        PipelineParams.from_mapping(values)


# --- long arrays, cut into records ---

PIECES = {
    "one line": '[{"booking_id": "a", "total_amount": 1.5},{"booking_id":"b"} , {"booking_id": null}]',
    "blanks": ' [ {"booking_id": "a" ,\t"status" : "x"}\n,\n{ } ] ',
    "several arrays": '[{"booking_id":"a"}]\n[{"booking_id":"b"},{"booking_id":"c"}]\n[]\n',
    "records by line": '{"booking_id":"a"}\n{"booking_id":"b","other":true}\n',
    "escapes": r'[{"booking_id":"q\"\\","status":"x\u007d"},{"booking_id":"ä,[]:"}]',
    "other types": '[{"booking_id":7,"total_amount":"12.5"},{"booking_id":-1.5,"total_amount":2e1}]',
    "empty": "[]",
    "nothing": "",
    "brace in a value": '[{"booking_id":"a}"},{"booking_id":"{b"}]',
    "nested": '[{"booking_id":"a","more":{"x":1}},{"booking_id":"b"}]',
    "malformed": '{"booking_id":"a"}\n{"booking_id":\n{"booking_id":"c"}\n',
    "cut off": '[{"booking_id":"a"},{"booking_id":"b"',
    "null in an array": '[null,{"booking_id":"a"}]',
}


@pytest.mark.parametrize("name", [n for n in PIECES if n != "blanks"])
def test_cut_arrays_give_the_same_rows(spark, tmp_path, name):
    (tmp_path / "f.json").write_text(PIECES[name], encoding="utf-8")
    path = str(tmp_path / "f.json")
    assert bag(read_bookings(spark, path, split_arrays=True)) == bag(read_bookings(spark, path))


def test_records_over_several_lines(spark, tmp_path):
    (tmp_path / "f.json").write_text(PIECES["blanks"])
    path = str(tmp_path / "f.json")
    cut = read_bookings(spark, path, split_arrays=True)
    assert bag(cut) == bag(read_bookings(spark, path, multi_line=True))
    assert sorted((r["booking_id"] or "", r["status"] or "") for r in cut.collect()) == [("", ""), ("a", "x")]


def test_one_line_takes_many_tasks(spark, tmp_path, settings):
    settings(spark__sql__files__maxPartitionBytes="64k", spark__sql__files__openCostInBytes="1k")
    records = [{"booking_id": f"B{i}", "status": "x" * (i % 50), "total_amount": i / 2} for i in range(20_000)]
    (tmp_path / "f.json").write_text(json.dumps(records))
    cut = read_bookings(spark, str(tmp_path / "f.json"), split_arrays=True)
    assert cut.rdd.getNumPartitions() > 10
    assert min(cut.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) > 0
    assert read_bookings(spark, str(tmp_path / "f.json")).rdd.getNumPartitions() >= 1
    assert bag(cut) == bag(read_bookings(spark, str(tmp_path / "f.json")))
    assert "Exchange" not in plan(cut, "simple") and "Python" not in plan(cut, "simple")


def test_long_values_do_not_overflow(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps([{"booking_id": 'x\\"' * 200_000}, {"booking_id": "y"}]))
    cut = read_bookings(spark, str(tmp_path / "f.json"), split_arrays=True)
    assert sorted(len(r["booking_id"]) for r in cut.collect()) == [1, 600_000]


def test_a_split_record_is_parsed_once_whatever_filters_follow(spark, tmp_path):
    changes = [{}, {"booking_id": None}, {"start_time": "bad"}, {"status": "odd"}]
    path = saved(tmp_path, json.dumps([{**GOOD_BOOKING, **change} for change in changes]))
    kept = bookings_plan(read_bookings(spark, path, split_arrays=True), DATE_TIME_FORMAT, "UTC")
    assert ids(kept, "booking_id") == ["B1"]
    assert plan(kept, "simple").count("from_json") == 1
