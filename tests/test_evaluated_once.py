from __future__ import annotations

import gzip
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cashloom.functions.cycles import parse_cycle, steps_upto
from cashloom.operators.intervals import on_levels
from cashloom.operators.lookup import fits_broadcast
from cashloom.operators.schedule import with_event_dates, with_schedule
from cashloom.operators.states import EVENT_TERMS, event_counts, event_rows, flat_events, nested_events
from cashloom.plans import job, registry
from cashloom.plans.pam import evaluate
from cashloom.plans.rows import evaluate_rows
from cashloom.plans.testdata import BEFORE_ALL, MIDWAY, contract_lines, market_table
from cashloom.session import COMPILED_METHOD_BYTES, materialised
from cashloom.sources import sinks
from cashloom.sources.analysis_date import with_analysis_date
from cashloom.sources.contracts import parse_contracts, with_full_terms


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_events_are_scheduled_once(spark, small):
    contracts = parse_contracts(contract_lines(spark, small))
    assert "Generate" not in plan(evaluate_rows(contracts, MIDWAY, market_table(spark, small), hot_rows=30))


@pytest.mark.parametrize("query, writer", [("csv_append_roundtrip", "append_csv"), ("csv_append_once", "append_once")])
def test_what_is_appended_is_evaluated_before(spark, small, monkeypatch, query, writer):
    appended, append = [], getattr(registry, writer)

    def seen(rows, *where):
        appended.append(rows)
        return append(rows, *where)

    monkeypatch.setattr(registry, writer, seen)
    registry.queries()[query](spark, small)
    assert len(appended) > 1 and not any("Generate" in plan(rows) for rows in appended)


def test_curve_rate_is_worked_out_once_a_contract(spark, small):
    contracts = parse_contracts(contract_lines(spark, small))
    evaluated = evaluate(contracts, MIDWAY, market_table(spark, small)).select("reset_rates")
    lines = plan(evaluated)
    assert "__curve_rate" in lines and "__series" in lines


def test_points_go_to_the_levels_of_their_key(spark):
    given = spark.createDataFrame([(1, 0), (1, 0), (2, 5), (3, 0), (3, 7)], "k long, __level int")
    points = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40)], "k long, x long")
    placed = on_levels(points, given, ["k"]).orderBy("k", "__level").collect()
    assert [(r.k, r.x, r["__level"]) for r in placed] == [(1, 10, 0), (2, 20, 5), (3, 30, 0), (3, 30, 7)]


def test_table_that_may_not_be_broadcast_is_not_measured(spark):
    broken = spark.range(1).select(F.raise_error(F.lit("read")).cast("string").alias("code"))
    assert not fits_broadcast(broken, 0)


def test_nested_events_are_listed_once_kind_by_kind(spark, small):
    contracts = parse_contracts(contract_lines(spark, small))
    lines = plan(nested_events(evaluate(contracts, MIDWAY, market_table(spark, small))))
    assert "AS placed" not in lines and "AS owed" not in lines


def test_units_around_the_largest_counted(spark):
    values = "array(0.00005D, 0.00004D, -0.00005D, 12345.67895D, 112589990684.2624D, -112589990684.2623D, 5e11D, double('NaN'), -double('Infinity'), NULL)"
    found = spark.range(1).selectExpr(f"transform({values}, v -> {registry.units('v', 4)}) AS u").first().u
    assert found[:7] == ["1", "0", "0", "123456790", "1125899906842624", "-1125899906842623", "5000000000000000"]
    assert found[7:] == ["NaN", "-Infinity", None]


def lambdas(frame):
    """What is interpreted, with all that it is given: filters of arrays, and other expressions with a lambda."""
    found = plan(frame)
    return [word for word in ("filter(", "transform(", "lambdafunction(") if word in found]


def test_terms_and_schedule_are_generated_code(spark, small):
    contracts = parse_contracts(contract_lines(spark, small))
    assert lambdas(contracts) == []
    assert lambdas(with_schedule(with_analysis_date(with_full_terms(contracts), MIDWAY))) == []


def test_counting_events_needs_no_lambda(spark, small):
    contracts = parse_contracts(contract_lines(spark, small, faults=True))
    assert lambdas(event_counts(evaluate(contracts, BEFORE_ALL), keep=("contract_status",))) == []


@pytest.mark.parametrize("t0", [BEFORE_ALL, "1996-07-01", MIDWAY, "2003-05-05"])
def test_counts_are_those_of_the_rows(spark, small, t0):
    evaluated = evaluate(parse_contracts(contract_lines(spark, small)), t0)
    rows = event_rows(evaluated).groupBy("contract_id").agg(F.count("*").alias("n_rows"))
    compared = event_counts(evaluated).join(rows, "contract_id", "left")
    assert compared.where("n_events <> coalesce(n_rows, 0)").count() == 0


def test_steps_up_to_a_date(spark):
    cases = [
        ("2015-01-31", "1M-", "2015-01-30", 0), ("2015-01-31", "1M-", "2015-01-31", 1), ("2015-01-31", "1M-", "2015-02-27", 1),
        ("2015-01-31", "1M-", "2015-02-28", 2), ("2015-01-31", "1M-", "2015-04-29", 3), ("2015-01-31", "1M-", "2015-04-30", 4),
        ("2015-01-31", "1Q-", "2016-01-30", 4), ("2015-01-31", "10D-", "2015-02-09", 1), ("2015-01-31", "10D-", "2015-02-10", 2),
        ("2015-01-31", "9999Y", "2015-02-10", 1), ("2015-01-31", "200000000M", "9999-12-31", 1), ("2015-01-31", "odd", "2016-01-01", 0),
        ("2015-01-31", "1M-", None, 0), (None, "1M-", "2015-01-31", 0),
    ]
    rows = spark.createDataFrame(cases, "anchor string, cycle string, day string, n int")
    typed = rows.selectExpr("date(anchor) AS anchor", "date(day) AS day", f"{parse_cycle('cycle')} AS step", "n")
    assert [r for r in typed.selectExpr("n", f"{steps_upto('day', 'anchor', 'step')} AS found").collect() if r.n != r.found] == []


def test_files_job_stores_a_row_a_contract(spark, small, monkeypatch):
    stored, drop = [], job.drop_folder
    monkeypatch.setattr(job, "drop_folder", lambda session, path: (stored.append(session.read.parquet(path).count()), drop(session, path)))
    registry.queries()["events_from_faulty_files"](spark, small)
    assert stored == [contract_lines(spark, small).count()]


def test_events_of_files_are_compiled(spark, small, capsys):
    """Code beyond what HotSpot compiles is not used, and then every column is copied for each event."""
    evaluated = evaluate(parse_contracts(contract_lines(spark, small)), MIDWAY, market_table(spark, small))
    kept = materialised(evaluated.select(*EVENT_TERMS))
    events = flat_events(with_event_dates(kept)).withColumnRenamed("contract_id", "id")
    capsys.readouterr()
    job.declared(events, job.EVENT_SCHEMA).explain("codegen")
    sizes = re.findall(r"maxMethodCodeSize:([0-9]+)", capsys.readouterr().out)
    assert sizes and max(map(int, sizes)) < COMPILED_METHOD_BYTES


def text_files(folder):
    return sorted(str(p) for p in Path(folder).rglob("part-*") if not p.name.endswith(".parquet"))


def query_folders(spark, monkeypatch):
    """Labels and paths of the folders that a query asks for from now on."""
    asked, new = {}, registry.new_folder
    monkeypatch.setattr(registry, "new_folder", lambda session, label: asked.setdefault(label, new(session, label)))
    return asked


def test_csv_is_compressed_and_what_it_came_from_dropped(spark, small, monkeypatch):
    asked = query_folders(spark, monkeypatch)
    rows = registry.queries()["csv_append_roundtrip"](spark, small)
    files = text_files(asked["events-csv"])
    assert files and all(f.endswith(".csv.gz") for f in files) and not Path(asked["events"]).exists()
    plain = sum(len(line) + 1 for f in files for line in gzip.open(f, "rt"))
    assert sum(Path(f).stat().st_size for f in files) < plain / 4
    counted = rows.groupBy(*rows.columns).count()
    assert counted.where("count % 2 <> 0").count() == 0 and counted.count() > 0


def test_compressed_files_end_after_so_many_rows(spark, tmp_path):
    sinks.text_writer(spark.range(10, numPartitions=1).selectExpr("cast(id AS string) AS value"), 4).text(str(tmp_path / "t"))
    assert [sum(1 for _ in gzip.open(f)) for f in text_files(tmp_path)] == [4, 4, 2]


def test_batches_are_compressed_and_what_they_came_from_dropped(spark, small, monkeypatch):
    asked = query_folders(spark, monkeypatch)
    rows = registry.queries()["csv_append_once"](spark, small)
    files = text_files(asked["events-batches"])
    assert files and all(f.endswith(".csv.gz") for f in files) and not Path(asked["events"]).exists()
    # the half-written batch holds the events of all currencies, and those published each once
    lines = sum(sum(1 for _ in gzip.open(f)) for f in files)
    assert lines == 2 * rows.count() > 0


def test_text_lines_are_compressed(spark, small, monkeypatch):
    asked = query_folders(spark, monkeypatch)
    rows = registry.queries()["events_text_lines"](spark, small)
    files = text_files(asked["events-text"])
    assert files and all(f.endswith(".txt.gz") for f in files)
    assert sum(sum(1 for _ in gzip.open(f)) for f in files) == contract_lines(spark, small).count() == rows.count()
