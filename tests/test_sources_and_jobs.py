import csv
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clicktide.plans import jobs
from clicktide.sources import event_files, tables

COMMON = ["page_url", "timestamp", "event_name", "event_data", "user_agent"]


def write_csv(folder, name, header, rows):
    with open(folder / name, "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(header)
        writer.writerows(rows)


def body(tx, revenue):
    return json.dumps({"transaction_id": tx, "revenue": revenue, "items": [{"item_variant": '76"W'}]})


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    u, ua = "https://shop.example.com/?gclid=1", "Mozilla (iPhone)"
    write_csv(raw, "events_20250223.csv", ["client_id", "referrer", *COMMON], [
        ["u1", "https://google.com/", u, "2025-02-23T10:00:00.000Z", "page_viewed", "{}", ua],
        ["u1", "", u, "2025-02-23T10:05:00.000Z", "checkout_completed", body("t1", 100), ua],
        ["NA", "null", "line\nbreak", "2025-02-23T10:06:00.000Z", "page_viewed", '{"a": "x,y"}', ua],
        ["u1", "", u, "2025-02-23T10:07:00.000Z", "checkout_completed", body("t2", 0), ua],
    ])
    write_csv(raw, "events_20250224.csv", ["clientId", *COMMON], [
        ["u1", u, "2025-02-24T09:00:00.000Z", "page_viewed", "{}", ua],
        ["u2", u, "2025-02-24T09:01:00.000Z", "checkout_completed", body("t3", 50), ua],
    ])
    write_csv(raw, "events_20250225.csv", ["clientId", *COMMON], [])
    (raw / "notes.txt").write_text("not an event file")
    return raw


def test_headers_are_united_by_name(spark, folder):
    events = event_files.read_event_folder(spark, str(folder))
    rows = {r.timestamp: r for r in events.collect()}
    assert len(rows) == 6
    old, new = rows["2025-02-23T10:00:00.000Z"], rows["2025-02-24T09:00:00.000Z"]
    assert (old.client_id, old.clientId, old.referrer) == ("u1", None, "https://google.com/")
    assert (new.client_id, new.clientId, new.referrer) == (None, "u1", None)
    assert (old.partition_date, new.partition_date) == ("20250223", "20250224")
    odd = rows["2025-02-23T10:06:00.000Z"]
    assert (odd.client_id, odd.referrer, odd.page_url) == (None, None, "line\nbreak")
    assert odd.event_data == '{"a": "x,y"}'
    assert new.source_columns == ["clientId", *COMMON]
    assert len({r.event_id for r in rows.values()}) == 6


def test_empty_folder_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        event_files.read_event_folder(spark, str(tmp_path))


def test_partition_date_from_names(spark):
    names = ["events_20250223.csv", "events_cleaned_20250224.csv", "a1b2.csv", "x20250223112233.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    rows = df.select(event_files.date_from_name(F.col("n")), event_files.date_token(F.col("n"))).collect()
    assert [r[0] for r in rows] == ["20250223", "20250224", None, "20250223"]
    assert rows[0][1] == "20250223"


def test_all_jobs_over_a_folder(spark, folder, tmp_path):
    events = tables.stage(event_files.read_event_folder(spark, str(folder)), str(tmp_path / "landed"))
    headers = event_files.partition_headers(spark, str(folder))
    out = str(tmp_path / "out")

    quality = jobs.quality_job(events, partitions=headers, folder=f"{out}/quality")
    scores = {r.partition_date: r for r in quality["scores"].collect()}
    assert set(scores) == {"20250223", "20250224", "20250225"}
    assert scores["20250223"].p1_failed == 2  # invalid purchase, 25% without identity
    assert scores["20250224"].decision == "WARN"  # no referrer
    drift = {r.partition_date for r in quality["drift"].where("check_id like '%schema%'").collect()}
    assert drift == {"20250224", "20250225"}

    cleaning = jobs.cleaning_job(events, folder=f"{out}/cleaning")
    summary = {r.partition_date: (r.clean_rows, r.quarantine_rows) for r in cleaning["summary"].collect()}
    assert summary == {"20250223": (3, 1), "20250224": (2, 0)}
    stored = tables.read_by_partition(spark, f"{out}/cleaning/events/status=quarantine")
    assert [r.quarantine_reason for r in stored.collect()] == ["invalid_purchase_fields_or_revenue"]
    assert cleaning["quarantined"].count() == 1 and cleaning["cleaned"].count() == 5
    scan = cleaning["cleaned"]._jdf.queryExecution().executedPlan().toString()
    assert "status" in scan[scan.index("PartitionFilters") :][:200]

    made = jobs.transformation_job(cleaning["cleaned"], folder=f"{out}/transform")
    recon = made["reconciliation"].first()
    assert (recon.input_event_rows, recon.purchases_table_rows, recon.revenue_sum_purchases) == (5, 2, 150.0)
    assert recon.revenue_sum_diff_purchases_vs_attrib == 0.0
    assert made["sessions"].count() == 4
    assert made["touchpoints"].count() == 4
    sessionized = spark.read.parquet(f"{out}/transform/events_with_sessions")
    assert sessionized.count() == 5
    assert made["fact"].agg(F.sum("revenue")).first()[0] == 150.0

    analysis = jobs.analysis_job(made["sessions"], made["purchases"], made["attribution"], f"{out}/analysis")
    assert analysis["totals"].first().total_purchases == 2
    assert sum(r.rows for r in analysis["time_to_purchase_histogram"].collect()) == 2

    saved = tables.load_quality_scores(spark, f"{out}/quality/scores")
    watch = jobs.monitoring_job(
        made["sessions"], made["purchases"], made["fact"], scores=saved, folder=f"{out}/monitoring"
    )
    assert watch["dq_rollup"].first().partitions == 3
    assert [r.day for r in watch["last_days"].collect()] == ["2025-02-23", "2025-02-24"]
    assert watch["alerts"].count() == 0


def test_transformation_without_a_folder_can_clean_first(spark, folder):
    events = event_files.read_event_folder(spark, str(folder))
    made = jobs.transformation_job(events, clean_first=True)
    assert made["purchases"].count() == 2
    assert made["funnel"].agg(F.sum("page_viewed")).first()[0] == 3


def test_contract_document(spark, tmp_path):
    path = tmp_path / "contract.json"
    path.write_text(json.dumps({
        "required_base_columns": ["a"], "identity_columns": ["id"], "allowed_events": ["e"],
        "event_data_requirements": {"e": {"required_fields": ["f", "g"]}},
    }))
    contract = tables.load_contract(spark, str(path))
    assert (contract.required_columns, contract.identity_columns) == (("a",), ("id",))
    assert contract.payload_requirements == {"e": ("f", "g")}
    fallback = tables.load_contract(spark, str(tmp_path / "absent.json"))
    assert "checkout_completed" in fallback.allowed_events


def test_quality_scores_may_be_absent_or_broken(spark, tmp_path):
    assert tables.load_quality_scores(spark, None) is None
    assert tables.load_quality_scores(spark, str(tmp_path / "none")) is None
    broken = tmp_path / "broken.json"
    broken.write_text("{not json")
    assert tables.load_quality_scores(spark, str(broken)) is None
    good = tmp_path / "good.json"
    good.write_text(
        '{"partition_date":"20250223","dq_score":85,"p0_failed":0}\n'
        '{"partition_date":"oops","dq_score":1,"p0_failed":1}\n'
    )
    rows = tables.load_quality_scores(spark, str(good), dated_only=True).collect()
    assert [(r.day, r.dq_score) for r in rows] == [("2025-02-23", 85)]
    every = tables.load_quality_scores(spark, str(good)).collect()
    assert sorted((r.day or "", r.p0_failed) for r in every) == [("", 1), ("2025-02-23", 0)]


def test_csv_and_parquet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "1,\"x\""), ("b", None)], "k string, v string")
    for kind in ("parquet", "csv"):
        path = tables.write_table(df, str(tmp_path / kind), kind)
        back = tables.read_table(spark, path, kind)
        assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_a_day_run_again_leaves_the_other_days(spark, make_events, tmp_path):
    rows = [{"timestamp": f"2025-02-2{d}T10:00:00Z", "page_url": u} for d in (7, 8) for u in "ab"]
    path = str(tmp_path / "t")
    tables.write_by_partition(make_events(rows), path)
    again = make_events([{"timestamp": "2025-02-28T10:00:00Z", "page_url": "new"}])
    tables.write_by_partition(again, path, replace="days")
    got = {(r.partition_date, r.page_url) for r in tables.read_by_partition(spark, path).collect()}
    assert got == {("20250227", "a"), ("20250227", "b"), ("20250228", "new")}
    tables.write_by_partition(again, path)
    assert tables.read_by_partition(spark, path).count() == 1
    with pytest.raises(ValueError):
        tables.write_by_partition(again, path, replace="day")


def test_cleaning_a_day_again_replaces_both_sides(spark, make_events, tmp_path):
    """The second run of a day has no bad row left, and none of the first run stays."""

    def sold(day, tx, revenue):
        stamp = f"2025-02-{day}T10:00:00Z"
        return {"timestamp": stamp, "event_name": "checkout_completed", "event_data": body(tx, revenue)}

    out = str(tmp_path / "clean")
    first = make_events([sold(27, "a", 5), sold(27, "b", 0), sold(28, "c", 5), sold(28, "d", 0)])
    jobs.cleaning_job(first, out, replace="days")
    mended = make_events([sold(28, "c", 5), sold(28, "d", 3), sold(28, "e", 4)])
    made = jobs.cleaning_job(mended, out, replace="days")
    sides = {r.partition_date: (r.clean_rows, r.quarantine_rows) for r in made["summary"].collect()}
    assert sides == {"20250227": (1, 1), "20250228": (3, 0)}
    assert [r.partition_date for r in made["quarantined"].collect()] == ["20250227"]
    assert made["cleaned"].count() == 4 and "is_marker" not in made["cleaned"].columns
    # The same run once more changes nothing.
    made = jobs.cleaning_job(mended, out, replace="days")
    assert made["cleaned"].count() == 4 and made["quarantined"].count() == 1


# --- reading files split over tasks -------------------------------------------------


def random_files(raw, rng, files=6, rows=60):
    """Files of two headers with line breaks, quotes and commas inside quoted fields, some with CRLF."""
    letters = ["a", "é", '"', "\n", ",", " ", "x", "\r\n", "😀", "\n\n"]
    want = {}
    for k in range(files):
        name = f"events_202502{k + 1:02d}.csv"
        header = ["client_id", "page_url", "event_name"] if k % 2 else ["event_name", "clientId", "user_agent"]
        lines = [["".join(rng.choice(letters) for _ in range(rng.randrange(1, 12))) + "z" for _ in header] for _ in range(rows)]
        with open(raw / name, "w", newline="", encoding="utf-8") as f:
            writer = csv.writer(f, lineterminator="\r\n" if k % 3 == 2 else "\n")
            writer.writerow(header)
            writer.writerows(lines)
            if k == 1:
                f.write("\n\nlast,line,without feed")
                lines = [*lines, ["last", "line", "without feed"]]
        want[name] = [dict(zip(header, line)) for line in lines]
    return want


def found_rows(events):
    names = ["client_id", "clientId", "page_url", "event_name", "user_agent"]
    out = {}
    for r in sorted(events.collect(), key=lambda r: r.event_id):
        out.setdefault(r.source_file, []).append({c: r[c] for c in names if c in r.source_columns})
    return out


@pytest.mark.parametrize("split", ["37b", "200b", "1m"])
def test_quoted_line_breaks_at_the_borders_of_splits(spark, tmp_path, split):
    """Every record comes out whole, in order, and with the same id for any size of splits."""
    import random

    raw = tmp_path / "raw"
    raw.mkdir()
    want = random_files(raw, random.Random(4))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        events = event_files.read_event_folder(spark, str(raw))
        rows = events.collect()
        assert found_rows(events) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    ids = {(r.source_file, r.event_name, r.event_id) for r in rows}
    again = event_files.read_event_folder(spark, str(raw)).collect()
    assert {(r.source_file, r.event_name, r.event_id) for r in again} == ids and len(ids) == len(rows)
    offsets = sorted(r.event_id & (1 << event_files.OFFSET_BITS) - 1 for r in rows if r.source_file == "events_20250201.csv")
    data = (raw / "events_20250201.csv").read_bytes()
    assert all(data[o - 1 : o] == b"\n" for o in offsets)


def test_a_field_longer_than_many_splits(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    long = "line\n" * 400 + 'and "more"'
    write_csv(raw, "events_20250201.csv", ["client_id", "event_data"], [["a", "x"], ["b", long], ["c", "y\nz"]])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        events = event_files.read_event_folder(spark, str(raw))
        got = {r.client_id: r.event_data for r in events.collect()}
        assert got == {"a": "x", "b": long, "c": "y\nz"}
        # Other splits than those that were counted are an error, not wrong rows.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "77b")
        with pytest.raises(Exception, match="split sizes have changed"):
            events.groupBy("client_id").count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_thousand_small_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for k in range(1000):
        header = ["client_id", "event_name"] if k % 2 else ["event_name", "clientId"]
        write_csv(raw, f"events_{20000101 + k}.csv", header, [["u", "v"]])
    paths = event_files.list_files(spark, str(raw))
    headers = event_files.file_headers(spark, paths)
    assert len(headers) == 1000 and set(headers.values()) == {("client_id", "event_name"), ("event_name", "clientId")}
    events = event_files.read_event_folder(spark, str(raw))
    assert events.count() == 1000
    some = event_files.read_event_folder(spark, str(raw), since="20000103", until="20000105")
    assert sorted(r.partition_date for r in some.collect()) == ["20000103", "20000104", "20000105"]


def test_odd_headers(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "events_20250101.csv").write_bytes(b'\xef\xbb\xbf\n"a\nb",,x,X,"q""q"\n1,2,3,4,5\n\n6,7\n')
    (raw / "events_20250102.csv").write_bytes(b"")
    (raw / "events 20250103.csv").write_bytes(b"only,header")
    names = event_files.file_headers(spark, event_files.list_files(spark, str(raw)))
    # A file of no bytes is not listed.
    assert sorted(names.values()) == [("a\nb", "_c1", "x2", "X3", 'q"q'), ("only", "header")]
    rows = event_files.read_event_folder(spark, str(raw)).orderBy("event_id").collect()
    assert [(r["a\nb"], r["_c1"], r.x2, r.X3, r['q"q']) for r in rows] == [("1", "2", "3", "4", "5"), ("6", "7", None, None, None)]
    assert {r.partition_date for r in event_files.partition_headers(spark, str(raw)).collect()} == {"20250101", "20250103"}


def test_lines_as_records(spark, tmp_path):
    """Without `multi_line` a stray quote ends with its line."""
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "events_20250101.csv").write_text('client_id,page_url\na,5" screen\nb,c\n')
    got = {r.client_id: r.page_url for r in event_files.read_event_folder(spark, str(raw), multi_line=False).collect()}
    assert got == {"a": '5" screen', "b": "c"}


def test_numbers_of_splits_match_a_plain_loop():
    """Offsets, open quotes and owners of splits, in any order of the measurements and over several tables."""
    rng = random.Random(11)
    rows, want = [], {}
    for rank, file in enumerate((-7, 3, 2**62, 5)):
        offset = inside = owner = 0
        for split in range(0, rng.randrange(1, 9) * 100, 100):
            size, quotes = rng.randrange(1, 200), rng.randrange(4)
            last = [rng.choice([-1, rng.randrange(size)]) for _ in range(2)]
            rows.append((file, split, size, quotes, *last))
            want[file, split] = event_files.Split(rank, offset, bool(inside), owner)
            owner = offset + last[inside] if last[inside] >= 0 else owner
            offset, inside = offset + size, (inside + quotes) % 2
    rng.shuffle(rows)
    names = ["file", "split", "bytes", "quotes", "last_outside", "last_inside"]
    tables = [
        pa.table({n: pa.array([r[k] for r in part], pa.int64()) for k, n in enumerate(names)})
        for part in (rows[:4], rows[4:], [])
    ]
    splits = event_files.Splits(tables, {-7: 0, 3: 1, 2**62: 2, 5: 3})
    assert {key: splits.find(*key) for key in want} == want
    assert splits.find(3, 50) is None and splits.find(4, 0) is None and splits.find(2**62, 10**6) is None
    assert len(event_files.Splits([t.slice(0, 0) for t in tables], {}).file) == 0
