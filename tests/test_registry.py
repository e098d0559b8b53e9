"""The registry over its event table."""

import pytest
from tabwright.operators import registry as G
from tabwright.streaming.registry_log import follow, watch, write_log


@pytest.fixture
def registry(spark, folder):
    return G.Registry(spark, f"{folder}/events")


@pytest.fixture
def sample(registry):
    return registry.create("test_experiment", "sklearn", {"test_param": "value"})


def test_create(registry):
    made = registry.create("test_exp", "sklearn", {"n_estimators": 100})
    assert made["name"] == "test_exp" and made["model_type"] == "sklearn"
    assert made["status"] == "pending" and made["id"] and made["parameters"] == {"n_estimators": "100"}
    with pytest.raises(ValueError, match="exists"):
        registry.create("test_exp")


def test_get(registry, sample):
    assert registry.get(sample["id"])["name"] == "test_experiment"
    assert registry.get(sample["id"][:8])["id"] == sample["id"]
    assert registry.get("nothing") is None
    assert registry.resolve("test_experiment")["id"] == sample["id"]


def test_list(registry):
    registry.create("exp1", "sklearn")
    second = registry.create("exp2", "xgboost")
    registry.start(second["id"])
    assert [r["name"] for r in registry.list().collect()] == ["exp2", "exp1"]
    assert [r["name"] for r in registry.list("running").collect()] == ["exp2"]


def test_update(registry, sample):
    updated = registry.update(sample["id"], status="running", nonsense=1)
    assert updated["status"] == "running" and updated["updated_at"] >= updated["created_at"]
    assert updated["name"] == "test_experiment"
    assert registry.update("unknown", status="running") is None


def test_delete(registry, sample):
    assert registry.delete(sample["id"]) is True
    assert registry.get(sample["id"]) is None
    assert registry.delete(sample["id"]) is False
    assert registry.update(sample["id"], status="running") is None


def test_start_stop(registry, sample):
    assert registry.start(sample["id"])["status"] == "running"
    assert registry.stop(sample["id"])["status"] == "stopped"


def test_complete(registry, sample):
    done = registry.complete(sample["id"], {"accuracy": 0.95}, "test-run-id")
    assert done["status"] == "completed" and done["metrics"] == {"accuracy": 0.95} and done["run_id"] == "test-run-id"
    assert G.metrics_of(registry.current(), sample["id"]).first()["value"] == 0.95


def test_deploy_and_fail(registry, sample):
    out = registry.deploy(sample["id"], "http://localhost:8080/invocations")
    assert out["status"] == "deployed" and out["deployed_endpoint"] == "http://localhost:8080/invocations"
    failed = registry.fail(sample["id"], "boom")
    assert failed["status"] == "failed" and failed["error"] == "boom"


def test_prefix_must_be_unambiguous(spark):
    rows = [("ab1", "x"), ("ab2", "y"), ("ab", "z")]
    current = spark.createDataFrame(rows, "id string, name string")
    assert G.by_id(current, "ab").first()["name"] == "z"
    assert G.by_id(current.filter("id <> 'ab'"), "ab").count() == 2


def test_documents_round_trip(registry, sample):
    back = G.from_json(G.to_json(registry.current()).select("document")).first()
    assert back["id"] == sample["id"] and back["parameters"] == {"test_param": "value"} and back["status"] == "pending"


def test_log_stream_of_one_experiment(spark, registry, sample, folder):
    other = registry.create("other")
    registry.start(sample["id"])
    registry.start(other["id"])
    registry.complete(sample["id"], {"accuracy": 1.0})
    log = watch(spark, registry.path, sample["id"])
    write_log(log, f"{folder}/log", f"{folder}/state").awaitTermination()
    rows = spark.read.parquet(f"{folder}/log").orderBy("seq").collect()
    assert [r["status"] for r in rows] == ["pending", "running", "completed"]
    assert [r["ended"] for r in rows] == [False, False, True]


def test_same_name_twice_in_one_batch(spark):
    current = spark.createDataFrame([("i0", "taken")], "id string, name string")
    asked = spark.createDataFrame([("i1", "new", 2), ("i2", "new", 1), ("i3", "taken", 3)], "id string, name string, seq long")
    assert [(r["name"], r["id"]) for r in G.create_events(current, asked).collect()] == [("new", "i2")]


def test_update_clears_a_field_and_compacts(spark, registry, sample, folder):
    registry.fail(sample["id"], "boom")
    assert registry.update(sample["id"], error=None, status="running")["error"] is None
    packed = registry.compact(f"{folder}/packed")
    assert packed.get(sample["id"])["status"] == "running" and packed.get(sample["id"])["error"] is None


def test_follow_stops_at_an_end_state(spark, registry, sample, folder):
    registry.complete(sample["id"], {"accuracy": 1.0})
    follow(watch(spark, registry.path, sample["id"]), f"{folder}/log", f"{folder}/state", 0.5)
    assert spark.read.parquet(f"{folder}/log").filter("ended").count() == 1


def test_datasets_by_name(spark, sf_dir, folder):
    from tabwright.sources import catalog as C

    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    C.upload(region, folder, "mine")
    region.write.parquet(f"{folder}/plain.parquet")
    assert C.dataset_names(spark, folder) == ["mine", "plain"]
    assert C.open_dataset(spark, folder, "mine").count() == C.open_dataset(spark, folder, "plain").count() == 5
    with pytest.raises(ValueError):
        C.open_dataset(spark, folder, "other")
    assert {r["dataset"]: r["n_rows"] for r in C.folder_catalog(spark, folder).collect()} == {"mine": 5, "plain": 5}
    assert "lineitem" in C.dataset_names(spark, sf_dir)


def test_tracking_writers(spark, folder):
    from tabwright.operators.runs import Tracking, best_run

    tracking = Tracking(spark, folder)
    first = tracking.start_run("toy", "one")
    tracking.log_params(first, {"depth": 3})
    tracking.log_metrics(first, {"accuracy": 0.5}, step=1)
    tracking.log_metrics(first, {"accuracy": 0.75, "loss": 1.0}, step=2)
    tracking.end_run(first)
    second = tracking.start_run("toy")
    row = {r["run_id"]: r for r in tracking.runs().collect()}
    assert row[first]["status"] == "FINISHED" and row[first]["metrics"] == {"accuracy": 0.75, "loss": 1.0}
    assert row[first]["params"] == {"depth": "3"} and row[first]["end_time"] is not None
    assert row[second]["status"] == "RUNNING" and row[second]["metrics"] is None
    assert best_run(tracking.runs(), "toy").first()["run_id"] == first
    assert [tracking.register_model("m", first, "path"), tracking.register_model("m", second, "path")] == [1, 2]
