import json

import pytest
from gazetta.plans import details


def transport():
    import json  # the function travels to workers that do not know this module

    def fetch(key):
        """Ids that end in 7 are missing, those in 3 answer on a second try, those in 9 never, and that named kill ends the run."""
        if key == "kill":
            raise SystemExit("killed")
        if key.endswith("7"):
            return 404, ""
        if key.endswith("9"):
            raise TimeoutError
        return 200, json.dumps({"standard_name": f"place {key}", "gdm": {"type": "point", "coordinates": [[1, 2]]}})

    return fetch


def test_a_run_is_killed_and_resumed(spark, tmp_path):
    folder, fetch = str(tmp_path / "run"), transport()
    ids = spark.createDataFrame([(f"{k:02}",) for k in range(30)], "id string")
    first = details.run_details(spark, folder, fetch, "r1", ids, batch=10, seconds=0.001, sleep=lambda s: None)
    assert first.batches <= 1
    with pytest.raises(Exception):  # noqa: B017
        details.run_details(spark, folder, fetch, "r1", spark.createDataFrame([("kill",)], "id string"), batch=40, sleep=lambda s: None)
    tasks = {r.id: r.status for r in details.read_tasks(spark, folder).collect()}
    assert set(tasks) == {f"{k:02}" for k in range(30)} | {"kill"}

    def second(key):
        return fetch("00") if key == "kill" else fetch(key)

    run = details.run_details(spark, folder, second, "r2", ids, batch=12, attempts=2, most_attempts=2, sleep=lambda s: None)
    state = {r.id: r for r in run.tasks.collect()}
    lost = {k for k in state if k[-1] in "79"}
    assert {k for k, r in state.items() if r.status == "failed"} == lost and {k for k, r in state.items() if r.status == "done"} == set(state) - lost
    assert all(state[k].attempts == 2 and state[k].last_error for k in lost)
    master = {r.id: r for r in run.master.collect()}
    assert set(master) == set(state) - lost and all(json.loads(r.raw_json) for r in master.values())
    again = details.run_details(spark, folder, second, "r3", ids, sleep=lambda s: None)
    assert (again.batches, again.done) == (0, 0) and again.master.count() == len(master)
