from datetime import datetime

from conftest import rows
from tablelift.operators.chunks import chunk_plan
from tablelift.operators.control import (
    CONTROL_SCHEMA,
    FOLD_AT,
    ControlTable,
    current_status,
    folded,
    last_chunk,
    remaining_chunks,
    upsert_control,
)
from tablelift.session import new_folder

EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 1, 2)


def state(chunk, rows_loaded, status, at, table="t", run="r"):
    return (run, "e", table, chunk, 10, rows_loaded, status, at, at)


def frame(spark, *states):
    return spark.createDataFrame(list(states), CONTROL_SCHEMA)


def test_upsert_keeps_created_at_and_table(spark):
    old = frame(spark, state(1, 0, "ERROR", EARLY), state(2, 10, "OK", EARLY))
    new = frame(spark, state(1, 10, "OK", LATE, table="other"), state(3, 4, "OK", LATE))
    got = {r.chunk_number: r for r in upsert_control(old, new).collect()}
    assert (got[1].rows_loaded, got[1].status, got[1].table_name) == (10, "OK", "t")
    assert (got[1].created_at, got[1].updated_at) == (EARLY, LATE)
    assert (got[2].status, got[2].updated_at) == ("OK", EARLY)
    assert got[3].created_at == LATE
    assert rows(current_status(old.unionByName(new))) == rows(upsert_control(old, new))


def test_last_chunk(spark):
    control = frame(spark, state(1, 1, "OK", EARLY), state(7, 1, "ERROR", EARLY), state(3, 1, "OK", EARLY))
    assert last_chunk(control, "e").first()[0] == 3
    assert last_chunk(control, "other").first()[0] == 0
    assert rows(last_chunk(control)) == [("e", 3)]


def test_remaining_fills_gaps(spark):
    plan = chunk_plan(spark.range(45), 10)
    control = frame(spark, state(1, 10, "OK", EARLY), state(2, 0, "ERROR", EARLY), state(4, 10, "OK", EARLY))
    assert sorted(r.chunk_number for r in remaining_chunks(plan, control).collect()) == [2, 3, 5]


def test_stored_states(spark):
    control = ControlTable(spark, new_folder(spark, "control"))
    assert control.last_chunk("e") == 0
    control.save_chunk("r", "e", "t", 1, 10, 0, "ERROR")
    assert control.last_chunk("e") == 0
    control.save_chunk("r", "e", "t", 1, 10, 10)
    control.save_chunk("r", "e", "t", 2, 10, 4)
    assert control.last_chunk("e") == 2
    found = rows(control.of_run("r", "e").select("chunk_number", "rows_loaded", "status"))
    assert found == [(1, 10, "OK"), (2, 4, "OK")]
    times = control.current().filter("chunk_number = 1").first()
    assert times.created_at < times.updated_at
    again = ControlTable(spark, control.path)
    assert again.last_chunk("e") == 2


def test_run_filter_reaches_the_scan(spark):
    control = ControlTable(spark, new_folder(spark, "control"))
    assert "EqualTo(run_id,r)" in control.of_run("r", "e")._jdf.queryExecution().toString()


def test_ranges_of_chunks(spark):
    control = ControlTable(spark, new_folder(spark, "control"))
    control.save_range("r", "e", "t", 1, 3, 10, 25, "STARTED")
    control.save_range("r", "e", "t", 1, 3, 10, 25)
    control.save_range("r", "e", "t", 4, 5, 10, 45, "ERROR")
    found = rows(control.current().select("chunk_number", "chunk_size", "rows_loaded", "status"))
    assert found == [(1, 10, 10, "OK"), (2, 10, 10, "OK"), (3, 10, 5, "OK"), (4, 10, 0, "ERROR"), (5, 10, 0, "ERROR")]
    assert control.history().dtypes == spark.createDataFrame([], CONTROL_SCHEMA).dtypes


def test_ten_thousand_states_leave_few_files(spark):
    control = ControlTable(spark, new_folder(spark, "control"))
    control.begin("r", "e", 10, 10_000)
    for first in range(1, 10_000, 40):
        for status in ("STARTED", "OK" if first % 3 else "ERROR"):
            control.save_range("r", "e", "t", first, first + 39, 10, 100_000, status)
    assert len(control.files.names(control._run("r"))) < 3 * FOLD_AT
    states = {r.chunk_number: r for r in control.of_run("r", "e").collect()}
    assert len(states) == 10_000
    assert all(r.status == ("OK" if ((k - 1) // 40 * 40 + 1) % 3 else "ERROR") and r.created_at < r.updated_at for k, r in states.items())
    started = control.history().filter("status = 'STARTED'").select("chunk_number").distinct().count()
    assert started == 10_000  # reports need when a chunk began
    assert control.latest("e") == {"run_id": "r", "size": 10, "chunks": 10_000, "staged": None, "closed": False}
    control.finish("r")
    assert control.latest("e")["closed"]


def test_closed_runs_are_archived(spark, monkeypatch):
    control = ControlTable(spark, new_folder(spark, "control"))
    monkeypatch.setattr("tablelift.operators.control.ARCHIVE_AT", 5)
    for number in range(7):
        control.begin(f"r{number}", "e", 10, 1)
        control.save_chunk(f"r{number}", "e", "t", 1, 10, number)
        if number != 2:
            control.finish(f"r{number}")
    folders = control.files.names()
    assert sum(name.startswith("run=") for name in folders) < 5
    assert rows(control.current().select("run_id", "rows_loaded")) == [(f"r{k}", k) for k in range(7)]
    assert control.status_of("r0", "e", 1) == control.status_of("r2", "e", 1) == "OK"
    assert control.status_of("r9", "e", 1) is None and control.latest("e")["closed"]
    assert control.last_chunk("e") == 1 and control.latest("other") is None


def test_folding_keeps_what_is_needed():
    def state(at, status, first=1):
        return {"run_id": "r", "extraction_name": "e", "first_chunk": first, "last_chunk": first, "status": status, "at": at}

    told = [state(1, "STARTED"), state(2, "ERROR"), state(3, "STARTED"), state(4, "OK"), state(5, "OK", first=2)]
    assert folded(told[::-1] + told) == [told[0], told[3], told[2], told[4]]
