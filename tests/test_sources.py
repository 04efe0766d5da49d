import json

import pytest
from pyspark.sql import functions as F

from mobspark.sources import catalog, scenario, store


def touch(path):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("")


def test_latest_iteration_rules(frame):
    runs = frame(
        "case_name string, dir_name string, finished boolean", ("a", "a_iteration_2", True), ("a", "a_iteration_10", True), ("a", "a_iteration_11", False),
        ("b", "b_iteration_", True), ("b", "logs", True), ("c", "abm_init_iteration", True), ("c", "c_iteration_", True), ("d", "d_iteration_1", False))
    got = {r.case_name: (r.iteration, r.dir_name) for r in catalog.latest_iteration(runs).collect()}
    assert got == {"a": (10, "a_iteration_10"), "b": (-1, "b_iteration_"), "c": (0, "abm_init_iteration")}
    assert {r.case_name: r.iteration for r in catalog.latest_iteration(runs, finished_only=False).collect()}["a"] == 11


def test_run_dirs_from_files(spark, tmp_path):
    touch(tmp_path / "gsc_1" / "gsc_1_iteration_3" / "finished")
    touch(tmp_path / "gsc_1" / "gsc_1_iteration_4" / "model_files" / "finished")
    touch(tmp_path / "gsc_1" / "gsc_1_iteration_4" / "other")
    got = {(r.case_name, r.dir_name): r.finished for r in catalog.list_run_dirs(spark, str(tmp_path)).collect()}
    assert got == {("gsc_1", "gsc_1_iteration_3"): True, ("gsc_1", "gsc_1_iteration_4"): False}


def test_parameters_from_json_files(spark, tmp_path):
    def write(case, name, content):
        path = tmp_path / case / "it_1" / "model_files" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2))

    scen = {"Population synthesizer controls": {"traffic_scale_factor": 0.25}, "General simulation controls": {"database_name": "greenville"},
            "Scenario controls": {"rideshare_cost_per_minute": 0.274, "rideshare_cost_per_mile": 1.22, "rideshare_base_fare": 7.27}}
    write("one", "scenario_abm.modified.json", scen)
    write("one", "scenario_abm_trajectories.modified.json", {})
    write("one", "SAEVFleetModel_optimization.json", {"Operator_1": {"Fleet_Base": {"Operator_1_TNC_FLEET_SIZE": 500}, "strategy_name": "X"}, "X": {"assignment_strategy": "auction"}})
    write("one", "PoolingModel.json", '{"TNC_Pooling_Model": {"note": 1, "note": 2, "CU_DEFAULT_POOLING_DISCOUNT": 0.42}}')
    write("two", "scenario_abm_trajectories.modified.json", scen)
    write("two", "SAEVFleetModel_optimization.json", {"Operator_1": {"Fleet_Base": {"TNC_FLEET_SIZE": 7}}, "DRS_Discount_AR": {"repositioning_batched_interval_seconds": 300}})
    names = [*scenario.SCENARIO_FILES, *scenario.FLEET_FILES, scenario.POOLING_FILE]
    files = scenario.read_model_files(spark, str(tmp_path), names)
    params = {r.case_name: r for r in scenario.all_params(files).collect()}
    assert (params["one"].trip_multiplier, params["one"].fleet_size, params["one"].assignment_strategy, params["one"].pooling_discount) == (4.0, 500, "auction", 0.42)
    assert (params["two"].trip_multiplier, params["two"].fleet_size, params["two"].assignment_strategy, params["two"].pooling_discount) == (4.0, 7, "default", None)
    assert params["one"].database_name == "greenville" and params["one"].base_fare == 7.27
    assert {r.case_name: r.interval_s for r in scenario.repositioning_interval(files).collect()} == {"one": 900, "two": 300}
    audit = scenario.config_audit(files, ["Operator_1", "Fleet_Base", "TNC_FLEET_SIZE"], scenario.FLEET_FILES)
    assert {r.case_name: r.value for r in audit.collect()} == {"one": None, "two": "7"}


def test_case_tables_prune_to_the_chosen_folders(spark, frame, tmp_path):
    df = frame("folder string, v bigint", ("a_1", 1), ("b_1", 2), ("7", 3))
    df.write.partitionBy("folder").parquet(str(tmp_path / "trip"))
    read = catalog.read_case_tables(spark, str(tmp_path), ["trip"], folders=["a_1", "7"])["trip"]
    assert sorted((r.folder, r.v) for r in read.collect()) == [("7", 3), ("a_1", 1)]
    assert "PartitionFilters: [" in read._jdf.queryExecution().executedPlan().toString()
    assert catalog.read_case_tables(spark, str(tmp_path), ["trip"])["trip"].count() == 3


def test_missing_and_pending_cases(frame):
    found = frame("case_name string", ("gsc_300_nr",), ("atx_500_0.2",))
    stored = frame("folder string", ("gsc_300_nr_7",))
    assert [r.case_name for r in catalog.missing_cases(found, stored).collect()] == ["atx_500_0.2"]
    assert catalog.pending_cases(stored, stored).count() == 0


def test_zone_lists_per_city(frame):
    zones = {"greenville": frame("zone bigint", (1,), (2,)), "campo": frame("zone bigint", (1,))}
    got = catalog.zone_master_from_lists(zones, {"greenville": "gsc", "campo": "atx"})
    assert sorted(tuple(r) for r in got.collect()) == [("atx", "1"), ("gsc", "1"), ("gsc", "2")]


def test_store_is_incremental(spark, frame, tmp_path):
    reports, calls = store.ReportStore(spark, str(tmp_path)), []

    def compute(todo):
        calls.append(sorted(r.folder for r in todo.collect()))
        return todo.withColumn("v", F.lit(len(calls)))

    assert reports.read_or_none("r") is None
    reports.refresh("r", frame("folder string", ("a",), ("b",)), compute)
    reports.refresh("r", frame("folder string", ("a",), ("b",)), compute)
    got = reports.refresh("r", frame("folder string", ("a",), ("b",), ("c",)), compute)
    assert calls == [["a", "b"], ["c"]] and sorted((r.folder, r.v) for r in got.collect()) == [("a", 1), ("b", 1), ("c", 2)]
    forced = reports.refresh("r", frame("folder string", ("b",)), compute, force=True)
    assert sorted((r.folder, r.v) for r in forced.collect()) == [("a", 1), ("b", 3), ("c", 2)]


def test_csv_round_trip(spark, frame, tmp_path):
    df = frame("folder string, `total fare` double", ("a", 1.5), ("b", None))
    store.write_csv(df, str(tmp_path / "csv"))
    back = store.read_csv(spark, str(tmp_path / "csv"), "folder string, `total fare` double")
    assert sorted(tuple(r) for r in back.collect()) == [("a", 1.5), ("b", None)]


@pytest.mark.parametrize("name", ["parquet", "csv"])
def test_case_tables_formats(spark, frame, tmp_path, name):
    frame("folder string, v bigint", ("a", 1)).write.partitionBy("folder").format(name).option("header", "true").save(str(tmp_path / "zone"))
    got = catalog.read_case_tables(spark, str(tmp_path), ["zone"], {"zone": "v bigint, folder string"}, fmt=name)["zone"]
    assert [(r.folder, r.v) for r in got.collect()] == [("a", 1)]


def test_case_names_stay_text(spark, frame, tmp_path):
    names = ["007", "08", "0.20", "1e5", "2024-01-01"]
    df = frame("folder string, v bigint", *[(n, i) for i, n in enumerate(names)])
    df.write.partitionBy("folder").parquet(str(tmp_path / "trip"))
    read = catalog.read_case_tables(spark, str(tmp_path), ["trip"])["trip"]
    assert sorted(r.folder for r in read.collect()) == sorted(names)
    report = store.ReportStore(spark, str(tmp_path / "store"))
    report.write("r", df)
    assert sorted(r.folder for r in report.read("r").collect()) == sorted(names)
    assert report.refresh("r2", df.select("folder"), lambda todo: df.join(todo, "folder")).count() == len(names)
    assert catalog.pending_cases(df.select("folder"), report.finished("r2")).count() == 0


def test_cases_without_rows_are_computed_once_and_stale_rows_go(spark, frame, tmp_path):
    cases = frame("folder string", ("a",), ("b",))
    calls, data = [], {"a": 1}

    def compute(todo):
        calls.append(sorted(r.folder for r in todo.collect()))
        return frame("folder string, v bigint", *data.items()).join(todo, "folder")

    report = store.ReportStore(spark, str(tmp_path))
    for _ in range(3):
        assert [tuple(r) for r in report.refresh("r", cases, compute).select("folder", "v").collect()] == [("a", 1)]
    assert calls == [["a", "b"]]
    data = {"b": 2}
    assert [tuple(r) for r in report.refresh("r", cases, compute, force=True).select("folder", "v").collect()] == [("b", 2)]
    data = {}
    data["x"] = 0
    assert report.refresh("r", cases, compute, force=True).count() == 0


def test_parameters_of_the_newest_finished_iteration(spark, tmp_path):
    def write(path, content):
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(content))

    for k, (factor, fleet) in enumerate([(0.25, 100), (0.5, 200), (1.0, 900)], 1):
        below = tmp_path / "gsc_1" / f"gsc_1_iteration_{k}"
        write(below / "model_files" / "scenario_abm.modified.json", {"Population synthesizer controls": {"traffic_scale_factor": factor}})
        write(below / "model_files" / "SAEVFleetModel_optimization.json", {"Operator_1": {"Fleet_Base": {"TNC_FLEET_SIZE": fleet}}})
        if k < 3:
            touch(below / "finished")
    write(tmp_path / "gsc_1" / "PoolingModel.json", {"TNC_Pooling_Model": {"CU_DEFAULT_POOLING_DISCOUNT": 0.3}})
    newest = catalog.latest_iteration(catalog.list_run_dirs(spark, str(tmp_path)))
    names = [*scenario.SCENARIO_FILES, *scenario.FLEET_FILES, scenario.POOLING_FILE]
    files = scenario.read_model_files(spark, str(tmp_path), names, newest)
    got = scenario.params_by_folder(scenario.all_params(files), newest).collect()
    assert [(r.folder, r.trip_multiplier, r.fleet_size, r.pooling_discount) for r in got] == [("gsc_1_2", 2.0, 200, 0.3)]


class _Lost(RuntimeError):
    pass


def test_a_run_that_fails_leaves_the_rows_before(spark, frame, tmp_path, monkeypatch):
    report = store.ReportStore(spark, str(tmp_path))
    cases = frame("folder string", ("a",), ("b",))
    report.refresh("r", cases, lambda todo: todo.withColumn("v", F.lit(1)))

    def rows():
        return sorted((r.folder, r.v) for r in store.ReportStore(spark, str(tmp_path)).read("r").collect())

    # in the middle of the write
    broken = lambda todo: todo.withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        report.refresh("r", cases, broken, force=True)
    assert rows() == [("a", 1), ("b", 1)] and report.versions("r") == [1]

    # after the rows, before the commit
    def lose(*a):
        raise _Lost

    with monkeypatch.context() as m:
        m.setattr(report, "_commit", lose)
        with pytest.raises(_Lost):
            report.refresh("r", cases, lambda todo: todo.withColumn("v", F.lit(2)), force=True)
    assert rows() == [("a", 1), ("b", 1)]
    report.refresh("r", cases, lambda todo: todo.withColumn("v", F.lit(3)), force=True)
    assert rows() == [("a", 3), ("b", 3)] and report.versions("r") == [1, 2]
    assert sorted(r.v for r in report.read("r", version=1).collect()) == [1, 1]
    assert report.vacuum("r") >= 2 and rows() == [("a", 3), ("b", 3)] and report.versions("r") == [2]
    assert report.vacuum("r") == 0


def test_two_writers_cannot_commit_the_same_version(spark, frame, tmp_path):
    one, two = (store.ReportStore(spark, str(tmp_path)) for _ in range(2))
    one.write("r", frame("folder string, v int", ("a", 1)))
    known = one.versions("r")
    two.versions = lambda key: known
    one.write("r", frame("folder string, v int", ("a", 2)))
    with pytest.raises(store.CommitConflict):
        two.write("r", frame("folder string, v int", ("a", 3)))
    assert [r.v for r in one.read("r").collect()] == [2]
    assert not [p for p in (tmp_path / "r" / "versions").iterdir() if "draft" in p.name]


def test_a_changed_input_recomputes_only_its_case(spark, frame, tmp_path):
    report, calls = store.ReportStore(spark, str(tmp_path)), []

    def run(trips, zones):
        marks = store.fingerprints({"trip": trips, "zone": zones})
        cases = store.combined(marks, ["trip"])

        def compute(todo):
            calls.append(sorted(r.folder for r in todo.collect()))
            return trips.join(todo, "folder").groupBy("folder").agg(F.sum("v").alias("v"))

        return sorted((r.folder, r.v) for r in report.refresh("r", cases, compute).collect())

    def trips(*rows):
        return frame("folder string, v bigint, m string", *rows)

    zones = frame("folder string, zone int", ("a", 1))
    first = [("a", 1, None), ("a", 2, "x"), ("b", 5, "y")]
    assert run(trips(*first), zones) == [("a", 3), ("b", 5)]
    assert run(trips(*reversed(first)), zones.union(zones)) == [("a", 3), ("b", 5)]  # the order and other tables don't count
    assert run(trips(*first[:2], ("b", 6, "y")), zones) == [("a", 3), ("b", 6)]
    assert run(trips(*first[:2], ("b", 6, "y"), ("b", 6, "y")), zones) == [("a", 3), ("b", 12)]  # repeated rows count
    assert run(trips(*first[:2], ("b", 12, "y"), ("c", 1, "")), zones) == [("a", 3), ("b", 12), ("c", 1)]
    assert calls == [["a", "b"], ["b"], ["b"], ["b", "c"]]


def test_a_bad_case_stops_only_itself(spark, frame, tmp_path):
    report, rejected = store.ReportStore(spark, str(tmp_path)), set()
    cases = frame("folder string", ("a",), ("b",), ("c",))
    values = {"a": 1, "b": 2, "c": 3}

    def compute(todo):
        rows = frame("folder string, v int, _off boolean", *[(k, v, v < 0) for k, v in values.items()])
        return rows.join(todo, "folder")

    report.refresh("r", cases, compute, bad=F.col("_off"), rejected=rejected)
    values |= {"a": 10, "b": -1}
    got = report.refresh("r", cases, compute, True, F.col("_off"), rejected)
    assert rejected == {"b"} and got.columns == ["folder", "v"]
    assert sorted((r.folder, r.v) for r in got.collect()) == [("a", 10), ("b", 2), ("c", 3)]
    values["d"] = -5
    more = cases.union(frame("folder string", ("d",)))
    got = report.refresh("r", more, compute, bad=F.col("_off"), rejected=rejected)
    assert rejected == {"b", "d"} and got.count() == 3
    assert store.pending(more, report.finished("r")).collect()[0].folder == "d"


def test_runs_with_other_columns_and_old_cases(spark, frame, tmp_path):
    report = store.ReportStore(spark, str(tmp_path))
    report.write("r", frame("folder string, v int", ("a", 1), ("b", 1)))
    report.write("r", frame("folder string, v int, w string", ("b", 2, "new")))
    assert sorted((r.folder, r.v, r.w) for r in report.read("r").collect()) == [("a", 1, None), ("b", 2, "new")]
    report.replace("r", frame("v int", (5,)))
    assert [tuple(r) for r in report.read("r").collect()] == [(5,)]
    with pytest.raises(KeyError):
        report.read("none")
    plan = store.ReportStore(spark, str(tmp_path)).read("r", 2)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_tables_of_the_newest_finished_iterations(spark, frame, tmp_path, fmt):
    def write(case, name, table, *values, finished=True):
        below = tmp_path / case / name
        df = frame("v bigint, folder string", *[(v, "of the table") for v in values]).coalesce(1)
        df.write.format(fmt).option("header", "true").save(str(below / f"{table}.{fmt}"))
        if finished:
            touch(below / "finished")

    write("gsc 1+x", "gsc 1+x_iteration_1", "trip", 1)
    write("gsc 1+x", "gsc 1+x_iteration_2", "trip", 2, 3)
    write("gsc 1+x", "gsc 1+x_iteration_3", "trip", 4, finished=False)
    write("atx%20é", "abm_init_iteration", "trip", 5)
    write("atx%20é", "abm_init_iteration", "stop", 6)
    newest = catalog.latest_iteration(catalog.list_run_dirs(spark, str(tmp_path)))
    schemas = {"trip": "v bigint, folder string", "none": "w int"}
    t = catalog.read_iteration_tables(spark, str(tmp_path), ["trip", "stop", "none"], newest, schemas, fmt=fmt)
    assert sorted((r.folder, r.v) for r in t["trip"].collect()) == [("atx%20é_0", 5), ("gsc 1+x_2", 2), ("gsc 1+x_2", 3)]
    assert [(r.folder, int(r.v)) for r in t["stop"].collect()] == [("atx%20é_0", 6)] and t["none"].count() == 0
    labels = {r.folder for r in scenario.case_folders(newest).collect()}
    assert labels == {r.folder for r in t["trip"].collect()}
    assert len(t["trip"].inputFiles()) == 2  # neither the older nor the unfinished iteration

    # files of other cases aren't opened: these can't be read at all
    few = catalog.read_iteration_tables(spark, str(tmp_path), ["trip"], newest, schemas, ["atx%20é_0"], fmt)["trip"]
    assert len(few.inputFiles()) == 1 and few.count() == 1
    for part in (tmp_path / "gsc 1+x" / "gsc 1+x_iteration_2" / f"trip.{fmt}").glob(f"part-*.{fmt}"):
        part.chmod(0o600)
        part.write_bytes(b"\x00\xffno table at all" * 9)
        for crc in part.parent.glob(f".{part.name}.crc"):
            crc.unlink()
    again = catalog.read_iteration_tables(spark, str(tmp_path), ["trip"], newest, schemas, fmt=fmt)["trip"]
    assert [r.v for r in again.where("folder = 'atx%20é_0'").select("v").collect()] == [5]
    if fmt == "parquet":
        with pytest.raises(Exception):  # noqa: B017
            again.select("v").collect()
    with pytest.raises(FileNotFoundError):
        catalog.read_iteration_tables(spark, str(tmp_path), ["nowhere"], newest, fmt=fmt)


def test_paths_in_which_cases_differ(spark, frame):
    files = frame(
        "case_name string, file_name string, content string",
        ("a", "x.json", '{"same": 1, "num": 0.50, "a b": {"list": [1, {"k": "t"}, []], "gone": null}, "text": "{not json"}'),
        ("b", "x.json", '  {"same": 1, "num": 0.5, "a b": {"list": [1, {"k": "u"}], "gone": 3}, "text": "{not json", "\\"q": {}}'),
        ("a", "y.json", "no json"), ("b", "y.json", "no json"), ("c", "z.json", None))
    got = {(r.file_name, r.path): (r.n_cases, r.n_missing, r.n_values, r.first_value, r.last_value) for r in scenario.config_differences(files).collect()}
    assert ("x.json", "$.num") not in got  # one number, written in two ways
    assert got == {
        ("x.json", '$."a b".list[1].k'): (2, 0, 2, "t", "u"), ("x.json", '$."a b".list[2]'): (1, 1, 1, "[]", "[]"),
        ("x.json", '$."a b".gone'): (2, 0, 2, "3", "3"), ("x.json", '$."\\"q"'): (1, 1, 1, "{}", "{}")}
    shallow = scenario.config_differences(files, ["x.json"], depth=1).collect()
    assert '$."a b"' in {r.path for r in shallow}
    assert scenario.config_differences(files.limit(0)).collect() == []
