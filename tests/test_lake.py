import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tradeloom.config import SYMBOLS
from tradeloom.sources import ingest, medallion

NOW = 1_700_000_000_000


def test_trade_rules(spark):
    rows = [
        ("AAPL", 1.0, 0.0, NOW, None),
        ("AAPL", 1.0, 1.0, NOW - 60_000, None),
        ("AAPL", 1.0, 1.0, NOW + 999_999, None),
        ("NOPE", 1.0, 1.0, NOW, "unknown_symbol"),
        (None, 1.0, 1.0, NOW, "unknown_symbol"),
        ("AAPL", None, 1.0, NOW, "missing_price"),
        ("AAPL", 0.0, 1.0, NOW, "bad_price"),
        ("AAPL", -1.0, 1.0, NOW, "bad_price"),
        ("AAPL", 1.0, None, NOW, "missing_volume"),
        ("AAPL", 1.0, -0.1, NOW, "bad_volume"),
        ("AAPL", 1.0, 1.0, None, "missing_time"),
        ("AAPL", 1.0, 1.0, NOW - 60_001, "stale"),
    ]
    df = spark.createDataFrame(rows, "s string, p double, v double, t bigint, want string")
    got = df.withColumn("got", ingest.reject_reason(SYMBOLS, F.lit(NOW), 60_000))
    assert got.filter(~F.col("want").eqNullSafe(F.col("got"))).collect() == []
    assert ingest.valid_trades(df, SYMBOLS, F.lit(NOW), 60_000).count() == 3


def test_session_hours(spark):
    at = ["2024-03-15 13:29:59", "2024-03-15 13:30:00", "2024-03-15 19:59:59", "2024-03-15 20:00:00", "2024-03-16 15:00:00", "2024-01-05 14:29:00", "2024-01-05 14:30:00"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(at)], "i int, x string").withColumn("t", F.unix_millis(F.col("x").cast("timestamp")))
    assert [r.i for r in df.filter(ingest.in_session(F.col("t"))).orderBy("i").collect()] == [1, 2, 6]


SPIKE = dict(
    signal_type="volume_spike", symbol="a", price=1.5, trade_volume=2, avg_volume=1.0, spike_ratio=4.0, window_trade_count=3,
    window_span_secs=60.0, trade_ts=NOW, detected_at="2023-11-14T22:13:20.000Z", ml_anomaly_score=None,
)
MOVE = dict(
    signal_type="momentum_signal", symbol="a", direction="UP", candles_in_direction=3, total_candles=5, oldest_open=1.0,
    latest_close=2.0, pct_change=100.0, window_start_ts=NOW - 300_000, window_end_ts=NOW, detected_at="2023-11-14T22:13:21.000Z",
    ml_anomaly_score=0.4,
)
ENTRY = dict(symbol="a", last_price=None, open_price=None, pct_change=None, trade_count=0, total_volume=0.0, last_trade_ts=None, is_stale=False)
SNAP = dict(signal_type="sector_snapshot", snapshot_ts="2023-11-14T22:14:00.000Z", symbols=[ENTRY, ENTRY | {"symbol": "b", "last_price": 2.5, "last_trade_ts": NOW}])


def without(d, *keys):
    return {k: v for k, v in d.items() if k not in keys}


def bodies(spark, *payloads):
    texts = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(texts, "i int, body string")


@pytest.mark.parametrize(
    "payload, error",
    [
        (SPIKE, None),
        (SPIKE | {"price": "1.5", "window_trade_count": 3.0, "extra": 1}, None),
        (MOVE, None),
        (SNAP, None),
        (SPIKE | {"price": "x"}, "price"),
        (SPIKE | {"price": None}, "price"),
        (SPIKE | {"window_trade_count": 3.5}, "window_trade_count"),
        (SPIKE | {"ml_anomaly_score": "high"}, "ml_anomaly_score"),
        (without(SPIKE, "ml_anomaly_score"), "ml_anomaly_score"),
        (without(SPIKE, "symbol", "price"), "symbol"),
        (MOVE | {"direction": "FLAT"}, "direction"),
        (SPIKE | {"signal_type": "other"}, "unknown_type"),
        (without(SPIKE, "signal_type"), "unknown_type"),
        (SNAP | {"symbols": [ENTRY, without(ENTRY, "is_stale")]}, "symbols"),
        (SNAP | {"symbols": [without(ENTRY, "last_price")]}, "symbols"),
        (SNAP | {"symbols": "a"}, "symbols"),
        (without(SNAP, "symbols"), "symbols"),
        ("{", "bad_json"),
        ("[1]", "bad_json"),
    ],
)
def test_signal_validation(spark, payload, error):
    (r,) = ingest.validate_signals(bodies(spark, payload)).collect()
    assert (r.error, r.is_valid) == (error, error is None)


def test_encode_and_decode_agree(spark):
    import base64

    checked = ingest.validate_signals(bodies(spark, SPIKE, MOVE, SNAP))
    for kind, payload in (("volume_spike", SPIKE), ("momentum_signal", MOVE), ("sector_snapshot", SNAP)):
        typed = ingest.typed_signals(checked, kind).withColumn("signal_type", F.lit(kind))
        (r,) = ingest.encode_signals(typed).collect()
        assert (r.key, json.loads(r.value)) == (kind, payload)
    wrapped = [json.dumps({"kinesis": {"data": base64.b64encode(b).decode()}}) for b in (b'{"s":"a","p":1,"v":2,"t":3}', b"oops")]
    records = spark.createDataFrame([(w,) for w in [*wrapped, '{"kinesis":{"data":"%%"}}', "junk"]], "value string")
    assert [tuple(r) for r in ingest.parse_trades(ingest.decode_envelopes(records)).collect()] == [("a", 1.0, 2.0, 3)]


def test_silver_last_arrival_wins(spark):
    payloads = [SPIKE, SPIKE | {"price": 9.0}, MOVE, SNAP, "junk"]
    routed = medallion.route_silver(ingest.validate_signals(bodies(spark, *payloads)), "i")
    got = {r.path: (r.signal_type, str(r.date), r.i) for r in routed.collect()}
    assert got == {
        "silver/volume/2023/11/14/2023-11-14T22-13-20.000Z_a.json": ("volume_spike", "2023-11-14", 1),
        "silver/momentum/2023/11/14/2023-11-14T22-13-21.000Z_a.json": ("momentum_signal", "2023-11-14", 2),
        "silver/sector/2023/11/14/2023-11-14T22-14-00.000Z.json": ("sector_snapshot", "2023-11-14", 3),
    }


def test_silver_reader_trusts_the_path(spark):
    rows = [("silver/volume/x.json", json.dumps(SPIKE)), ("silver/momentum/x.json", json.dumps(SPIKE)),
            ("silver/foo/x.json", json.dumps(SPIKE)), ("bronze/volume/x.json", json.dumps(SPIKE)), ("silver", json.dumps(SPIKE)),
            ("silver/volume/y.json", "{")]
    assert medallion.read_silver(spark.createDataFrame(rows, "path string, body string")).count() == 1


def test_gold_is_loaded_once(spark, tmp_path):
    gold = medallion.GoldFolder(spark, str(tmp_path))
    assert gold.volume_spikes.count() == 0
    stamps = [F.lit(f"2024-01-0{i} 00:00:00").cast("timestamp") for i in (1, 2)]

    def rows(*payloads, stamp):
        return medallion.gold_from_signals(ingest.validate_signals(bodies(spark, *payloads)), "volume_spike", stamp)

    first = rows(SPIKE, SPIKE | {"price": 9.0}, SPIKE | {"symbol": "b"}, stamp=stamps[0])
    gold.upsert("volume_spikes", first)
    gold.upsert("volume_spikes", first)
    gold.upsert("volume_spikes", rows(SPIKE | {"price": 7.0}, SPIKE | {"symbol": "c"}, stamp=stamps[1]))
    got = gold.volume_spikes.orderBy("symbol").collect()
    assert [r.symbol for r in got] == ["a", "b", "c"]
    assert {str(r.date) for r in got} == {"2023-11-14"}
    assert got[0].price == 1.5
    gold.upsert("volume_spikes", first.limit(0))

    snapshot = medallion.gold_from_signals(ingest.validate_signals(bodies(spark, SNAP)), "sector_snapshot", stamps[0])
    gold.upsert("sector_snapshots", snapshot)
    gold.upsert("sector_snapshots", snapshot)
    assert [(r.symbol, r.last_price) for r in gold.sector_snapshots.orderBy("symbol").collect()] == [("a", None), ("b", 2.5)]


def test_gold_ddl_twice(spark, tmp_path):
    for _ in range(2):
        medallion.create_gold(spark, "signals_test", str(tmp_path))
    assert {t.name for t in spark.catalog.listTables("signals_test")} == {
        "volume_spikes", "momentum_signals", "volatility_spikes", "sector_snapshots",
    }
    spark.sql("DROP DATABASE signals_test CASCADE")


def test_bronze_over_midnight(spark, tmp_path):
    path = str(tmp_path / "bronze")
    at = [datetime(2024, 1, 1, 23, 58), datetime(2024, 1, 2, 0, 1), datetime(2024, 1, 1, 22, 0)]
    times = [medallion._epoch_ms(x) for x in at]
    lines = [(json.dumps({"s": "a", "p": 1, "v": 1, "t": t}), t) for t in times] + [("", times[0]), ("{bad", times[1])]
    df = spark.createDataFrame(lines, "value string, t bigint")
    medallion.write_bronze(df, F.timestamp_millis("t"), path)
    plain = tmp_path / "bronze" / "year=2024" / "month=01" / "day=02" / "hour=00" / "plain.txt"
    plain.write_text(json.dumps({"s": "b", "p": 1, "v": 1, "t": times[1]}) + "\n")
    now = datetime(2024, 1, 2, 0, 2)
    recent = medallion.recent_bronze(spark, path, now, 300_000)
    assert sorted((r.s, r.t) for r in recent.collect()) == [("a", times[0]), ("a", times[1]), ("b", times[1])]
    assert medallion.lookback_bronze(spark, path, now, 14).count() == 4
    assert medallion.read_bronze(spark, path).count() == 4


def test_retention(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),), (date(2024, 1, 2),), (date(2024, 3, 1),)], "date date")
    got = [tuple(r) for r in medallion.expired_partitions(df, "bronze", date(2024, 4, 2)).orderBy("date").collect()]
    assert got == [("bronze", date(2024, 1, 1), 1), ("bronze", date(2024, 1, 2), 2)]
    assert medallion.expired_partitions(df, "features", date(2024, 3, 31)).count() == 2


def test_stage_folder_comes_from_the_session():
    from types import SimpleNamespace

    from tradeloom.storage import shared_root

    def session(master, **conf):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=context)

    assert shared_root(session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    with pytest.raises(ValueError):
        shared_root(session("yarn"))
    local = session("local[2]")
    assert shared_root(local) == shared_root(local)


def test_stage_table_is_built_once(spark):
    from tradeloom.storage import Stage

    stage, built = Stage(spark, "stage-test"), []

    def build():
        built.append(1)
        return spark.range(3).filter("id > 5")

    assert stage.table("empty", build).count() == 0
    assert stage.table("empty", build).columns == ["id"]
    assert built == [1]


def test_expired_folders_are_dropped_by_name(spark, tmp_path):
    from datetime import date

    days = [("2024-01-01",), ("2024-03-20",), ("2024-04-01",)]
    path = str(tmp_path / "features")
    spark.createDataFrame(days, "date string").selectExpr("1 AS x", "date").write.partitionBy("date").parquet(path)
    listed = medallion.drop_expired(spark, path, "features", date(2024, 4, 10))
    assert [p.rsplit("/", 1)[1] for p in listed] == ["date=2024-01-01"]
    assert spark.read.parquet(path).count() == 3
    assert medallion.drop_expired(spark, path, "features", date(2024, 4, 20), dry_run=False)
    assert spark.read.parquet(path).count() == 1
    assert medallion.drop_expired(spark, str(tmp_path / "nothing"), "bronze", date(2024, 4, 10)) == []


def test_recent_bronze_looks_for_its_hours_only(spark, tmp_path):
    from datetime import datetime

    rows = [("2024-01-01 10:59:00",), ("2024-01-01 11:30:00",), ("2024-01-01 12:01:00",)]
    lines = spark.createDataFrame(rows, "at string").selectExpr(
        "to_json(named_struct('s', 'a', 'p', 1.0, 'v', 2.0, 't', unix_millis(cast(at as timestamp)))) AS value",
        "cast(at as timestamp) AS at",
    )
    path = str(tmp_path / "bronze")
    medallion.write_bronze(lines, F.col("at"), path)
    got = medallion.recent_bronze(spark, path, datetime(2024, 1, 1, 12, 5), 3_600_000)
    assert got.count() == 2
    assert len({f for f in got.inputFiles()}) == 2
    assert medallion.recent_bronze(spark, path, datetime(2023, 1, 1), 3_600_000).count() == 0
