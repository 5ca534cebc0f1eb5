"""Registered sinks hold all rows of the tables."""

from geoobs.plans import adapters as A
from geoobs.plans import load, store_queries, stream_queries
from geoobs.plans.registry import Tables
from geoobs.sources import sinks
from tests.compare import compare, connect

SF = "/root/testdata/sf0.01"


def _written(spark, tmp_path, monkeypatch, module, query):
    """Folder that ``query`` wrote its first sink to."""
    monkeypatch.setattr(module, "shared_dir", lambda _, purpose: str(tmp_path / purpose))
    load().QUERIES[query](spark, SF)
    return tmp_path


def test_landed_files_grow_with_the_rows(spark, tmp_path, monkeypatch):
    con = connect(SF)
    monkeypatch.setattr(store_queries, "FILE_ROWS", 500, raising=False)
    for name, folder, table, least in (("ocean_file_rows", "ocean-csv", "orders", 8),
                                       ("flux_files", "flux-csv", "lineitem", 4)):
        at = tmp_path / name
        monkeypatch.setattr(store_queries, "shared_dir", lambda _, purpose: str(at / purpose))
        # Several blocks a file: only the first of them holds the header.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        try:
            assert compare(spark, con, name, SF) is None
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert len(list((at / folder).glob("part=*/*.txt"))) >= least


def test_all_deployments_are_stored(spark, tmp_path, monkeypatch):
    path = _written(spark, tmp_path, monkeypatch, store_queries, "ocean_store") / "ocean"
    stored = sinks.ocean_store(str(path)).read(spark)
    track = A.track(Tables(spark, SF))
    columns = ["deployment", "seq", "variable", "value"]
    assert track.filter("deployment >= 30").count() > 0
    assert stored.count() == track.count()
    assert stored.select(*columns).exceptAll(track.select(*columns)).isEmpty()


def test_gas_of_all_stations_is_stored(spark, tmp_path, monkeypatch):
    path = _written(spark, tmp_path, monkeypatch, stream_queries, "stream_gas_ingest")
    stored = sinks.gas_store(str(path / "gas-stations")).read(spark)
    gas = A.gas_rows(Tables(spark, SF)).filter("gas IS NOT NULL")
    columns = ["gas", "station_id", "seq", "value"]
    assert gas.filter("station_id >= 40").count() > 0
    assert stored.count() == gas.count()
    assert stored.select(*columns).exceptAll(gas.select(*columns)).isEmpty()
