"""Readers, sinks and streams."""

import datetime as dt

import pytest

from hexdrift.operators import kernels
from hexdrift.sources import readers, sinks
from hexdrift.streaming import upsert


def test_wkt_and_geojson(spark, tmp_path):
    (tmp_path / "a.csv").write_text('MinSignal,WKT\n-90,"POLYGON ((0 0, 4 0, 4 4, 0 0))"\n1,\nx,"POINT (1 1)"\n')
    rows = readers.wkt_table(spark, str(tmp_path / "a.csv")).collect()
    assert [(r.signal, [(p.x, p.y) for p in r.ring]) for r in rows] == [(-90.0, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)])]
    (tmp_path / "a.json").write_text('{"features": [{"properties": {"id": "7"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 0]]]}}]}')
    r = readers.geojson(spark, str(tmp_path / "a.json")).first()
    assert r.properties == {"id": "7"} and [(p.x, p.y) for p in r.ring] == [(0, 0), (2, 0), (2, 2)]


def test_structures(spark, tmp_path):
    def line(kind, n, **at):
        f = [kind] + [""] * (n - 1)
        for k, v in at.items():
            f[int(k[1:])] = v
        return "|".join(f)

    place = dict(_6="40", _7="30", _8="0", _9="N", _11="100", _12="15", _13="0", _14="W")
    (tmp_path / "co").write_text("\n".join([line("CO", 15, _3="r1", _4="1", **place), line("CO", 15, _3="r1", _4="1", **place), line("CO", 15, _3="r2", _4="2", **place), line("CO", 15, _3="r3", _4="3", **(place | {"_6": "5"})), "CO|x"]))
    ra = dict(_8="C", _30="106.3", _28="88.4", _12="03/04/2024")
    (tmp_path / "ra").write_text("\n".join([line("RA", 33, _3="r1", _4="1", **ra), line("RA", 33, _3="r2", _4="9", **(ra | {"_30": "", "_28": "", "_12": "", "_9": "2023-01-02"})), line("RA", 33, _4="3", **ra)]))
    got = {r.unique_id: (r.lat, r.lng, r.height_m, r.event_date) for r in readers.structures(spark, str(tmp_path / "co"), str(tmp_path / "ra")).collect()}
    assert got == {"1": (40.5, -100.25, 106.3, dt.date(2024, 3, 4)), "2": (40.5, -100.25, None, dt.date(2023, 1, 2))}


def test_files_backend(spark, data, tmp_path):
    own = readers.source("lineitem", spark, data)
    path = str(tmp_path / "layers")
    sinks.write_layers(own.layers(), path)
    files = readers.source("files", spark, path)
    assert files.vintages() == ["prior", "current"] and files.resolve("current") == ("current", "prior")
    assert files.fetch(0, "N", "current").count() == own.fetch(0, "N", "current").count() > 0
    with pytest.raises(ValueError):
        readers.source("none", spark, path)


def test_upsert_stream(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    for i, rows in enumerate([[(1, "a", 1), (2, "a", 1)], [(1, "b", 2), (3, "c", 1)]]):
        spark.createDataFrame(rows, "k int, v string, t int").write.mode("append").parquet(str(src))
        stream = spark.readStream.schema("k int, v string, t int").parquet(str(src))
        upsert.upsert_stream(stream, out, ["k"], "t", str(tmp_path / "cp")).awaitTermination()
    assert {(r.k, r.v) for r in upsert.latest(spark, out).collect()} == {(1, "b"), (2, "a"), (3, "c")}


def test_windowed_tests(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet")
    assert upsert.windowed_tests(events).agg({"tests": "sum"}).first()[0] == events.count()


def test_assignment_is_optimal():
    from itertools import permutations

    import numpy as np

    rng = np.random.default_rng(3)
    for n, m in ((1, 1), (3, 4), (5, 5), (4, 6)):
        c = rng.random((n, m))
        best = min(sum(c[i, p[i]] for i in range(n)) for p in permutations(range(m), n))
        got = kernels.assign(c)
        assert len(set(got)) == n and abs(c[np.arange(n), got].sum() - best) < 1e-9


def test_summary(spark):
    df = spark.createDataFrame([(1, 0, "N", "00001", 0.5, True, "why")], "rank int, provider_id int, technology string, county_geoid string, priority_score double, flag_for_review boolean, flag_reason string")
    assert "| 1 | 0 | N | 00001 | 0.500 | why |" in sinks.summary(df) and "INCOMPLETE" in sinks.summary(df, 1)


def test_states_are_replaced_one_by_one(spark, tmp_path):
    path = f"file://{tmp_path}/batches"
    schema = "state_fips string, cell long, signal_dbm double"
    sinks.write_states(spark.createDataFrame([("01", 1, -80.0), ("01", 2, -81.0), ("02", 3, -82.0), (None, 4, -83.0)], schema), path, "b1")
    sinks.write_states(spark.createDataFrame([("01", 9, -90.0)], schema), path, "b2")
    sinks.write_states(spark.createDataFrame([], schema), path, "b3")
    read = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    assert sorted((r.cell, r.batch_ts) for r in read.parquet(f"{path}/coverage").collect()) == [(3, "b1"), (4, "b1"), (9, "b2")]
    assert sorted((r.state or "", r.n, r.batch_ts) for r in read.json(f"{path}/manifest").collect()) == [("", 1, "b1"), ("01", 1, "b2"), ("02", 1, "b1")]
