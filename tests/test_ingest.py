import json
import os

import pytest
from pyspark.sql import functions as F

from custbehav.config import PipelineConfig
from custbehav.operators import features
from custbehav.plans import ingest as ingest_plan
from custbehav.plans.export import export, export_query, export_snapshot, read_export, snapshot_path
from custbehav.plans.ingest import ingest, source_decisions
from custbehav.schema import MANIFEST, RAW
from custbehav.sources import versions
from custbehav.sources.raw_files import read_csv, read_json, source_listing
from custbehav.sources.store import EventStore
from tests.fixtures import made, write_csv

CFG = PipelineConfig(source_files=("sample.csv",), rows_per_chunk=2)


class Runtime:
    def __init__(self, spark, folder):
        self.data = str(folder / "data")
        os.makedirs(self.data)
        self.store = EventStore(spark, str(folder / "store"))

    def write(self, rows, name="sample.csv", columns=None):
        write_csv(f"{self.data}/{name}", rows, columns)

    def load(self, rows=None, **options):
        if rows is not None:
            self.write(rows)
        return ingest(self.store, self.data, CFG, **options)[0]

    def users(self):
        return sorted(row["user_id"] for row in self.store.events().collect())


@pytest.fixture
def runtime(spark, tmp_path):
    return Runtime(spark, tmp_path)


def test_copies_skip_and_replacement(runtime):
    a, b = made(), made(who=2)
    result = runtime.load([a, b, a])
    assert (result["rows_read"], result["rows_inserted"], result["duplicates_removed"]) == (3, 2, 1)
    assert runtime.load()["status"] == "SKIPPED"
    assert runtime.users() == [1, 2]
    runtime.load([a, made(who=3), made(who=3), made(who=3)])
    assert runtime.users() == [1, 3]
    assert 2 not in {r["user_id"] for r in features.serving_features(runtime.store.events(), CFG).collect()}
    assert runtime.store.drop_superseded_loads() == 1
    assert runtime.users() == [1, 3]
    # Attempts that are skipped are not logged.
    assert [r["status"] for r in runtime.store.log("run_log").orderBy("id").collect()] == ["SUCCESS"] * 2


def test_malformed_number_keeps_old_rows(runtime):
    runtime.load([made()])
    with pytest.raises(Exception, match="invalid-id"):
        runtime.load([made(who=2), made(who="invalid-id")])
    assert runtime.users() == [1]
    last = runtime.store.log("run_log").orderBy(F.desc("id")).first()
    assert last["status"] == "FAILED" and "invalid-id" in last["error_message"]


def test_source_without_valid_rows_keeps_old_rows(runtime):
    runtime.load([made()])
    with pytest.raises(ValueError, match="no valid event"):
        runtime.load([made(what="bad"), made(price=-1)])
    assert runtime.users() == [1]


def test_failure_before_the_commit_is_invisible(runtime, monkeypatch):
    runtime.load([made()])
    monkeypatch.setattr(ingest_plan, "_check_cleaned", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        runtime.load([made(who=2), made(who=3)])
    assert runtime.users() == [1]
    monkeypatch.undo()
    runtime.load()
    assert runtime.users() == [2, 3]


def test_source_that_changes_meanwhile_is_not_committed(runtime, monkeypatch):
    runtime.load([made()])
    check = ingest_plan._check_cleaned

    def change(*args):
        runtime.write([made(who=u) for u in range(9)])
        check(*args)

    monkeypatch.setattr(ingest_plan, "_check_cleaned", change)
    with pytest.raises(RuntimeError, match="while it was being loaded"):
        runtime.load([made(who=2), made(who=3)])
    assert runtime.users() == [1]


def test_sample_grows_to_full_load(runtime):
    runtime.load([made(who=u) for u in range(1, 5)], max_chunks=1)
    assert len(runtime.users()) == 2
    runtime.load()
    assert runtime.users() == [1, 2, 3, 4]


def test_full_load_is_kept_when_a_sample_is_requested(runtime):
    runtime.load([made(who=u) for u in range(1, 4)])
    assert runtime.load(max_chunks=1)["status"] == "SKIPPED"
    assert len(runtime.users()) == 3


def test_sample_is_not_shrunk(runtime):
    runtime.load([made(who=u) for u in range(1, 5)], max_chunks=2)
    with pytest.raises(ValueError, match="into another store"):
        runtime.load(max_chunks=1)
    assert runtime.store.current_loads().first()["rows_loaded"] == 4


def test_limit_must_be_positive(runtime):
    with pytest.raises(ValueError):
        runtime.load([made()], max_chunks=0)


def test_all_sources_must_exist(runtime):
    runtime.write([made()])
    with pytest.raises(FileNotFoundError, match="other.csv"):
        ingest(runtime.store, runtime.data, CFG, sources=("sample.csv", "other.csv"))
    assert not runtime.store.has_events()


def test_reports_and_warning(runtime):
    result = runtime.load([made(who=u) for u in range(1, 6)] + [made(what="signup")])
    assert result["status"] == "QUALITY_WARNING" and result["rows_rejected"] == 1
    reports = runtime.store.log("quality_log").collect()
    assert [(r["source_file"], r["total_records"], r["status"]) for r in reports] == [("sample.csv", 6, "FAILED")]
    assert json.loads(reports[0]["details"])["valid_event_types_rate"] == 0.8333


def test_failed_load_leaves_no_report(runtime):
    with pytest.raises(ValueError):
        runtime.load([made(what="bad")])
    assert runtime.store.log("quality_log").count() == 0


def test_sources_do_not_share_deduplication(spark, runtime):
    runtime.write([made()], "a.csv")
    runtime.write([made()], "b, c=1.csv")
    ingest(runtime.store, runtime.data, CFG, sources=("a.csv", "b, c=1.csv"))
    assert sorted(r["source_file"] for r in runtime.store.events().collect()) == ["a.csv", "b, c=1.csv"]


def test_decisions(spark):
    listing = spark.createDataFrame([(n, "f") for n in "abcdef"], "source_file string, fingerprint string")
    loads = [("b", "old", None), ("c", "f", None), ("d", "f", 4), ("e", "f", 2), ("f", "f", 8)]
    manifest = spark.createDataFrame(
        [(name, 1, print_, limit, 1, None) for name, print_, limit in loads], MANIFEST
    )
    decide = lambda limit: {
        r["source_file"]: r["decision"] for r in source_decisions(listing, manifest, limit).collect()
    }
    assert decide(4) == {"a": "LOAD", "b": "LOAD", "c": "SKIP", "d": "SKIP", "e": "LOAD", "f": "REFUSE"}
    assert decide(None) == {"a": "LOAD", "b": "LOAD", "c": "SKIP", "d": "LOAD", "e": "LOAD", "f": "LOAD"}
    with pytest.raises(ValueError):
        source_decisions(listing, manifest, -1)


def test_csv_dialect(spark, runtime):
    columns = list(reversed(RAW.names)) + ["note"]
    rows = [
        made(1, brand="NA", price="n/a"), made(2, brand='say "hi", then', note="x"), made(3, category_code="", price="NaN"),
    ]
    runtime.write(rows, columns=columns)
    found = {r["user_id"]: r for r in read_csv(spark, f"{runtime.data}/sample.csv").collect()}
    assert found[1]["brand"] is None and found[1]["price"] is None
    assert found[2]["brand"] == 'say "hi", then' and found[2]["category_id"] == "2053013555631882655"
    assert found[3]["category_code"] is None and found[3]["price"] is None
    runtime.write([made(1, brand="NA")])
    assert read_csv(spark, f"{runtime.data}/sample.csv", keep_tokens=True).first()["brand"] == "NA"


def test_csv_row_width(spark, runtime):
    runtime.write([made(1)])
    path = f"{runtime.data}/sample.csv"
    with open(path, "a") as file:
        file.write("2020-01-01 00:00:00 UTC,view,5\n")
    short = read_csv(spark, path).filter("user_id is null").first()
    assert short["product_id"] == 5 and short["user_session"] is None
    with open(path, "a") as file:
        file.write("2020-01-01 00:00:00 UTC,view,5,1,a,b,1.0,2,session-0001,surplus\n")
    with pytest.raises(Exception, match="more fields"):
        read_csv(spark, path).collect()


def test_csv_missing_column(spark, runtime):
    runtime.write([made(1)], columns=[c for c in RAW.names if c != "brand"])
    with pytest.raises(ValueError, match="brand"):
        read_csv(spark, f"{runtime.data}/sample.csv")


def test_json_source(spark, runtime):
    document = {**made(5773203), "category_id": 1487580005134238553, "category_code": "", "_id": "x"}
    with open(f"{runtime.data}/events.json", "w") as file:
        file.write(json.dumps(document) + "\n")
    row = read_json(spark, f"{runtime.data}/events.json").first()
    assert row["category_id"] == "1487580005134238553" and row["category_code"] is None and row["price"] == 12.5


def test_fingerprint_follows_the_file(spark, runtime):
    runtime.write([made(1)])
    before = source_listing(spark, runtime.data, ("sample.csv",), CFG).first()["fingerprint"]
    assert before.endswith("etl-v2")
    assert before == source_listing(spark, runtime.data, ("sample.csv",), CFG).first()["fingerprint"]
    runtime.write([made(1), made(2)])
    assert before != source_listing(spark, runtime.data, ("sample.csv",), CFG).first()["fingerprint"]


def failing(spark, rows=10):
    return spark.range(rows).select(F.when(F.col("id") < rows - 1, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))


def test_exports(spark, runtime, tmp_path):
    runtime.load([made(), made(who=2)])
    runtime.store.events().createOrReplaceTempView("exported_events")
    path = str(tmp_path / "out")
    folder = export_query(spark, "select *, null as nothing from exported_events", path)
    written = read_export(spark, path)
    assert written.count() == 2 and written.schema["nothing"].dataType.simpleString() == "string"
    assert any(name.endswith(".snappy.parquet") for name in os.listdir(folder))
    with pytest.raises(Exception, match="lost"):
        export(failing(spark), path)
    assert read_export(spark, path).count() == 2
    export(read_export(spark, path).limit(1), path)  # reads what it replaces
    assert read_export(spark, path).count() == 1
    assert versions.drop_superseded(spark, path) == 1 and read_export(spark, path).count() == 1
    export_snapshot(runtime.store.events(), str(tmp_path), "20200301")
    assert read_export(spark, snapshot_path(str(tmp_path), "20200301")).count() == 2
    assert read_export(spark, str(tmp_path / "none")) is None
    with pytest.raises(ValueError):
        export(spark.range(1).select(), str(tmp_path / "none"))


def test_a_failed_replacement_keeps_the_table(spark, runtime):
    store = runtime.store
    store.replace_table("numbers", spark.range(10))
    with pytest.raises(Exception, match="lost"):
        store.replace_table("numbers", failing(spark))
    assert store.table("numbers").count() == 10
    store.replace_table("numbers", spark.range(3))
    assert store.table("numbers").count() == 3 and store.drop_superseded_tables("numbers") == 1
    versions.publish(spark.range(1), store.path("health"), "json")
    with pytest.raises(Exception, match="lost"):
        versions.publish(failing(spark), store.path("health"), "json")
    assert versions.read(spark, store.path("health")).count() == 1


@pytest.mark.parametrize("partitions", ["1", "16"])
def test_sample_is_the_first_rows_of_the_file(spark, runtime, partitions):
    runtime.write([made(who=u, brand="x" * (u % 40)) for u in range(1, 401)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2kb")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        path = f"{runtime.data}/sample.csv"
        assert read_csv(spark, path).rdd.getNumPartitions() > 10
        for n in (1, 7, 150, 400, 1000):
            found = sorted(r["user_id"] for r in read_csv(spark, path, first=n).collect())
            assert found == list(range(1, min(n, 400) + 1))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
