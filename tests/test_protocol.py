"""Quoted line breaks, load states, judged loads, snapshots, parsed reports, registry verdicts, silhouettes, readiness."""

import csv
import random
from multiprocessing.pool import ThreadPool

import numpy as np
import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from custbehav.config import PipelineConfig
from custbehav.operators import quality, readiness, silhouette
from custbehav.plans import models, snapshots
from custbehav.plans.ingest import judge_loads, persist_reports
from custbehav.schema import EVENTS, RAW
from custbehav.sources.raw_files import NULL_TOKENS, read_csv
from custbehav.sources.store import EventStore
from tests.fixtures import made, raw_frame

CFG = PipelineConfig()


# CSV with quoted line breaks


@pytest.fixture
def split_size(spark):
    """Sets the size of a split of a file."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}

    def use(size):
        for name, value in zip(names, (size, "0")):
            spark.conf.set(name, value)

    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


def odd_rows(n):
    draw = random.Random(3)
    brands = ["a", "x\ny", "NA", 'q "z"\r\n\nb', "", '",\n"', " c ", "\n\n\n", "z\n" * 400]
    return [made(who=i, product_id=i, brand=draw.choice(brands), category_code=draw.choice(["a.b", "a,\nb"])) for i in range(n)]


def written(path, rows, line_end="\r\n"):
    with open(path, "w", newline="") as file:
        writer = csv.DictWriter(file, RAW.names, lineterminator=line_end)
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


@pytest.mark.parametrize("size, line_end", [("128m", "\r\n"), ("1k", "\n")])
def test_quoted_line_breaks_whatever_the_splits(spark, tmp_path, split_size, size, line_end):
    rows = odd_rows(300)
    folder = tmp_path / "source"
    folder.mkdir()
    written(folder / "a.csv", rows[:200], line_end)
    written(folder / "b.csv", rows[200:], line_end)
    split_size(size)
    found = {r["user_id"]: r for r in read_csv(spark, str(folder)).collect()}
    assert sorted(found) == list(range(300))
    for row in rows:
        wanted = None if row["brand"] in NULL_TOKENS else row["brand"]
        assert (found[row["user_id"]]["brand"], found[row["user_id"]]["category_code"]) == (wanted, row["category_code"])
    for n in (150, 250):
        first = read_csv(spark, str(folder), first=n)
        assert sorted(r["user_id"] for r in first.collect()) == list(range(min(n, 300)))


def test_quoted_breaks_and_failures(spark, tmp_path):
    rows = odd_rows(20)
    path = written(tmp_path / "surplus.csv", rows)
    with open(path, "a") as file:
        file.write('2020-01-01 00:00:00 UTC,view,5,1,"a\nb",b,1.0,2,session-0001,surplus\n')
    with pytest.raises(Exception, match="more fields than its header"):
        read_csv(spark, path).collect()
    path = written(tmp_path / "number.csv", [*rows, made(price="cheap", brand="a\nb")])
    with pytest.raises(Exception, match="cheap"):
        read_csv(spark, path).collect()
    path = written(tmp_path / "open.csv", rows)
    with open(path, "a") as file:
        file.write('2020-01-01 00:00:00 UTC,view,5,1,"a\nb,b,1.0,2,session-0001\n')
    with pytest.raises(Exception, match="never closed"):
        read_csv(spark, path).collect()
    path = written(tmp_path / "short.csv", rows)
    with open(path, "a") as file:
        file.write('\n2020-01-01 00:00:00 UTC,view,777,1,"short\nrow"\n\n')
    assert read_csv(spark, path).filter("product_id = 777 and category_code = 'short\\nrow' and user_id is null").count() == 1


# Logs and loads


def test_writers_that_append_at_the_same_time(spark, tmp_path):
    store = EventStore(spark, str(tmp_path))
    write = lambda i: store.append_row("registry", model_name="m", version=f"{i:02d}", feature_schema_version="2.0")
    with ThreadPool(8) as pool:
        pool.map(inheritable_thread_target(spark)(write), range(16))
    assert store.log("registry").count() == 16
    assert models.load_verdicts(store.log("registry"), ("m", "other"), CFG).select("model_name", "version", "verdict").collect() == [
        ("m", "15", "LOADABLE"), ("other", None, "MISSING")
    ]
    store.append_row("registry", model_name="m", version="99")
    assert models.load_verdicts(store.log("registry"), ("m",), CFG).first()["verdict"] == "STALE"


def test_states_of_loads(spark, tmp_path):
    store = EventStore(spark, str(tmp_path))
    assert store.load_states().collect() == []
    event = {"event_type": "view", "user_id": 1}
    for load_id, n in ((1, 3), (2, 2), (3, 4)):
        rows = spark.range(n).select(*[F.lit(event.get(f.name)).cast(f.dataType).alias(f.name) for f in store.events().schema if f.name != "source_file"])
        rows.write.parquet(store.load_path("a b%.csv", load_id))
        if load_id != 3:
            store.append_row("manifest", source_file="a b%.csv", load_id=load_id, rows_loaded=n)
    states = sorted((r["load_id"], r["rows"], r["state"]) for r in store.load_states().collect())
    assert states == [(1, 3, "SUPERSEDED"), (2, 2, "CURRENT"), (3, 4, "ORPHAN")] and store.events().count() == 2


def test_reading_events_leaves_the_schema_alone(spark, tmp_path):
    fields = list(EVENTS.fields)
    EventStore(spark, str(tmp_path)).events()
    assert EVENTS.fields == fields


def test_loads_judged_in_one_job(spark):
    good = [made(who=i, price=5.0) for i in range(20)]
    cheap = [made(who=i, price=0.005) for i in range(20)]
    mixed = [*good, *[made(what="login") for _ in range(5)]]
    raw = raw_frame(spark, [*good, good[0]], "good").unionByName(raw_frame(spark, cheap, "cheap"))
    raw = raw.unionByName(raw_frame(spark, [made(what="login")], "empty")).unionByName(raw_frame(spark, mixed, "mixed"))
    found = {r["source_file"]: tuple(r)[1:] for r in judge_loads(raw, ["source_file"], CFG).collect()}
    assert found["good"] == (21, 20, "SUCCESS", None) and found["mixed"] == (25, 20, "QUALITY_WARNING", None)
    assert found["cheap"] == (20, 0, "FAILED", "the cleaned rows miss the quality gate")
    assert found["empty"] == (1, 0, "FAILED", "no valid event, the last load stays current")
    assert judge_loads(raw.limit(0), ["source_file"], CFG).collect() == []


def test_reports_come_back_typed(spark, tmp_path):
    store = EventStore(spark, str(tmp_path))
    for number, rows in enumerate(([made()], [made(), made(what="login")], [made(who=None), made(who=None)])):
        persist_reports(store, quality.evaluate(raw_frame(spark, rows), ["source_file"], CFG), F.lit(number))
    rows = quality.report_changes(quality.parsed_details(store.log("quality_log"))).orderBy("id").collect()
    assert [r["valid_event_types_rate"] for r in rows] == [1.0, 0.5, 1.0]
    assert [r["valid_event_types_rate_change"] for r in rows] == [None, -0.5, 0.5]
    assert [r["passed_gate"] for r in rows] == [True, False, False] and [r["gate_turned"] for r in rows] == [None, True, False]
    store.append_row("quality_log", id=9, source_file="x", details="{broken")
    with pytest.raises(Exception, match="(?i)malformed"):
        quality.parsed_details(store.log("quality_log")).collect()


# Snapshots


def test_states_of_days_are_rebuilt(spark, tmp_path):
    root = str(tmp_path / "days")
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int")
    states = {
        "20240101": [("a", 1), ("a", 1), (None, None)], "20240102": [("a", 1), ("b", 2), (None, None), (None, None)],
        "20240103": [], "20240104": [("c", 3)], "20240105": [("c", 3), ("d", 4)],
    }
    assert snapshots.state(spark, root, "20240101") is None
    for day, rows in states.items():
        snapshots.record(frame(rows), root, day, full=day == "20240104")
    for day, rows in states.items():
        assert sorted(map(repr, map(tuple, snapshots.state(spark, root, day).collect()))) == sorted(map(repr, rows))
    assert {tuple(r) for r in snapshots.changes(spark, root, "20240102").collect()} == {("a", 1, -1), ("b", 2, 1), (None, None, 1)}
    assert snapshots.changes(spark, root, "20240105").collect() == [("d", 4, 1)]
    assert snapshots.state(spark, root, "20231231") is None and snapshots.state(spark, root, "20250101").count() == 2
    snapshots.record(frame([("e", 5)]), root, "20240105")  # the last day again
    assert snapshots.state(spark, root, "20240105").collect() == [("e", 5)]
    with pytest.raises(ValueError, match="recorded already"):
        snapshots.record(frame([]), root, "20240102")
    with pytest.raises(ValueError, match="columns differ"):
        snapshots.record(spark.createDataFrame([(1,)], "k int"), root, "20240106")


def test_a_failed_day_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "days")
    snapshots.record(spark.range(3), root, "20240101")
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        snapshots.record(broken, root, "20240102")
    assert list(snapshots.recorded_days(spark, root)) == ["20240101"] and snapshots.state(spark, root, "20240102").count() == 3


# Silhouettes and readiness


def plain_silhouettes(points, labels, power):
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2)) ** power
    out = []
    for i, own in enumerate(labels):
        mates = (labels == own) & (np.arange(len(labels)) != i)
        others = [distance[i, labels == other].mean() for other in set(labels) - {own}]
        if not mates.any() or not others:
            out.append(0.0)
            continue
        inside, nearest = distance[i, mates].mean(), min(others)
        out.append((nearest - inside) / max(inside, nearest) if max(inside, nearest) else 0.0)
    return out


@pytest.mark.parametrize("block", [1_024, 7])
def test_silhouettes_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(silhouette, "BLOCK", block)
    generator = np.random.default_rng(6)
    points = np.concatenate([generator.normal(c, 1.0, (25, 3)) for c in (0, 2, 8)] + [np.full((1, 3), 50.0), np.zeros((3, 3))])
    labels = np.array([0] * 25 + [1] * 25 + [2] * 25 + [3] + [4] * 3)
    rows = [(i, int(label), [float(x) for x in p]) for i, (label, p) in enumerate(zip(labels, points))]
    frame = spark.createDataFrame(rows, "user_id long, cluster int, vector array<double>").repartition(3)
    found = sorted(tuple(r) for r in silhouette.silhouettes(frame, CFG, None).collect())
    for power, place in ((1, 2), (2, 3)):
        assert [r[place] for r in found] == pytest.approx(plain_silhouettes(points, labels, power), abs=1e-9)
    means = {r["cluster"]: r for r in silhouette.silhouette_by_cluster(silhouette.silhouettes(frame, CFG)).collect()}
    assert means[None]["users"] == 79 and means[3]["silhouette_euclidean"] == 0.0
    assert means[None]["silhouette_euclidean"] == pytest.approx(silhouette.mean_silhouettes(frame, CFG)["silhouette_euclidean"])
    sampled = silhouette.silhouettes(frame, CFG, 20).collect()
    assert len(sampled) == 20
    chosen = sorted(r["user_id"] for r in sampled)
    part = plain_silhouettes(points[chosen], labels[chosen], 1)
    assert [r["silhouette_euclidean"] for r in sorted(sampled, key=lambda r: r["user_id"])] == pytest.approx(part, abs=1e-9)


def test_silhouettes_of_one_cluster_equal_points_and_nothing(spark):
    schema = "user_id long, cluster int, vector array<double>"
    one = spark.createDataFrame([(i, 0, [float(i)]) for i in range(5)], schema)
    equal = spark.createDataFrame([(i, i % 2, [1.0]) for i in range(6)], schema)
    for frame in (one, equal):
        assert silhouette.mean_silhouettes(frame, CFG) == {"silhouette_euclidean": 0.0, "silhouette_squared": 0.0}
    assert silhouette.mean_silhouettes(one.limit(0), CFG) == {"silhouette_euclidean": 0.0, "silhouette_squared": 0.0}


def test_readiness_of_cohorts(spark):
    def user(cohort, i, churned, mode="held_out", same=False):
        return cohort, churned, mode, *([1.0] * 5 if same else [float(i)] * 5)

    rows = [user("ready", i, i % 2) for i in range(12)] + [user("small", i, i % 2) for i in range(5)]
    rows += [user("equal", i, i % 2, same=True) for i in range(12)] + [user("one", i, 0) for i in range(12)]
    rows += [user("leak", i, i % 2, "descriptive" if i == 3 else "held_out") for i in range(12)] + [user(None, i, i % 2) for i in range(12)]
    names = "cohort string, churned int, feature_mode string, total_events double, total_spent double, avg_spent double, unique_products double, events_per_day double"
    found = {r["cohort"]: r for r in readiness.training_readiness(spark.createDataFrame(rows, names), "cohort", CFG).collect()}
    refusals = {c: (r["segment_refusal"], r["churn_refusal"]) for c, r in found.items()}
    assert refusals == {
        "ready": (None, None), None: (None, None), "small": (readiness.FEW_USERS, readiness.FEW_TO_LEARN),
        "equal": (readiness.FEW_VECTORS, None), "one": (None, readiness.ONE_CLASS), "leak": (None, readiness.SEES_LABEL),
    }
    assert (found["ready"]["users"], found["ready"]["vectors"], found["equal"]["vectors"]) == (12, 12, 1)
