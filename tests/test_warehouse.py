"""Runs from warehouse tables and parameter files; the run log; optional tables."""

import uuid

import pytest
from pyspark.sql import functions as F

from offerlens.params import RunParams
from offerlens.plans import pipelines
from offerlens.plans.registry import QUERIES, context
from offerlens.sources.repository import Repository, RunLog
from offerlens.sources.staging import new_stage_path
from offerlens.sources.warehouse import PROFILE_FILE, ParameterFiles, parameter_csv, parameter_lines

RUN = RunParams(36027, 36028)


@pytest.fixture
def repository(spark):
    schema, folder = f"t{uuid.uuid4().hex[:12]}", new_stage_path(spark, "db")
    spark.sql(f"CREATE DATABASE {schema} LOCATION '{folder}'")
    yield Repository(spark, schema, folder)
    spark.sql(f"DROP DATABASE {schema} CASCADE")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_and_country_prune_partitions(spark, sf):
    t = context(spark, sf).warehouse.tables
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for df in (t.sales(36020, 36027), t.status(36020, 36027), t.catalog(36020, 36027)):
        line = next(x for x in _plan(df).split("\n") if "FileScan" in x)
        assert "PartitionFilters: [" in line and "CodPais" in line and "AnioCampana" in line and "200103" in line, line
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_run_from_files_end_to_end(spark, sf, repository):
    """The three steps of a run whose source is the warehouse store what the star run stores."""
    c = context(spark, sf)
    t = c.warehouse.tables
    pipelines.build_scores(t, RUN, repository, RunLog("w", RUN))
    pipelines.apply_gap_engine(t, RUN, repository, RunLog("w", RUN))
    out = pipelines.apply_ranking_rules(t, RUN, repository, RunLog("w", RUN))
    names = [n for n, _ in QUERIES["estimated_totals"].columns()]
    assert sorted(map(str, out.select(*names).collect())) == sorted(map(str, QUERIES["estimated_totals"](c).select(*names).collect()))
    log = repository.spark.table(repository.name("run_log"))
    assert {r.step for r in log.collect()} == {"scores", "gap_engine", "ranking_rules"} and {r.run_id for r in log.collect()} == {"w"}


def write(spark, text):
    path = new_stage_path(spark, "lines")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def test_columns_are_found_by_header_and_bad_lines_kept(spark):
    path = write(spark, "\n".join(["perfil,CODPAIS,extra,ANIOCAMPANAPROCESO,CODEBELISTA", "1,C1,x,200110,s1", " 2 ,C1,,200110,s2",
                                   "two,C1,x,200110,s3", "3,C1,200110,s4", "4,C1,x,200110,s5,more", ",C1,x,200110,s6", "5,C2,x,200110,s7"]))
    rows = parameter_lines(spark, path, PROFILE_FILE).collect()
    assert {r._line: r._reason for r in rows if r._reason} == {
        "two,C1,x,200110,s3": "PERFIL is not int", "3,C1,200110,s4": "wrong number of fields", "4,C1,x,200110,s5,more": "wrong number of fields"}
    good = parameter_csv(spark, path, PROFILE_FILE, "C1")
    assert sorted(((r.CODEBELISTA, r.PERFIL) for r in good.collect()), key=str) == [("s1", 1), ("s2", 2), ("s6", None)]
    files = ParameterFiles(spark, path.rsplit("/", 1)[0], "C1", {"profiles": path.rsplit("/", 1)[1]})
    assert files.rejected("profiles").count() == 3 and files.get("profiles").columns == ["country", "seller_id", "process_cycle", "profile"]
    with pytest.raises(ValueError, match="PERFIL"):
        parameter_lines(spark, write(spark, "CODPAIS,CODEBELISTA,ANIOCAMPANAPROCESO\nC1,s,200110"), PROFILE_FILE)


def test_profiles_of_other_runs_do_not_double_sellers(spark, sf):
    c = context(spark, sf)
    assert c.t.profiles().count() > 2 * c.e.profiles.count() > 0
    assert c.e.profiles.groupBy("seller_id").count().where("count > 1").isEmpty()
    assert c.e.base_all.groupBy("seller_id").count().where("count > 1").isEmpty()
    assert c.e.run_variables.count() == c.e.variables.count()


def test_run_log_is_idempotent_by_run_and_step(repository):
    def stored():
        return sorted((r.run_id, r.step, r.message) for r in repository.spark.table(repository.name("log")).collect())

    log = RunLog("r1", RUN, "a")
    log.ok("one")
    log.flush(repository, "log")
    log.error("two")
    log.flush(repository, "log")
    assert stored() == [("r1", "a", "one"), ("r1", "a", "two")]
    RunLog("r1", RUN, "b").flush(repository, "log")              # nothing to say
    for message in ("first", "again"):
        retry = RunLog("r1", RUN, "b")
        retry.ok(message)
        retry.flush(repository, "log")
    assert stored() == [("r1", "a", "one"), ("r1", "a", "two"), ("r1", "b", "again")]
    files = repository.spark.table(repository.name("log")).inputFiles()
    assert len(files) == 2


def test_drifted_table_reads_under_the_declared_schema(spark, repository):
    repository.save(spark.createDataFrame([("7", 1.5, "x"), ("seven", None, "y")], "A string, extra double, C string"), "t")
    df = repository.read("t", "c string, a bigint, b date")
    assert df.columns == ["c", "a", "b"] and dict(df.dtypes) == {"c": "string", "a": "bigint", "b": "date"}
    assert sorted(map(tuple, df.collect())) == [("x", 7, None), ("y", None, None)]
    assert repository.read("t2", "a int").isEmpty()


def test_forced_slots_come_from_the_parts(spark, sf):
    c = context(spark, sf)
    brands = {r.p_brand for r in c.t.raw("part").select("p_brand").distinct().collect()}
    rows = c.e.forced.collect()
    assert rows and {r.brand for r in rows} <= brands and {r.forced_kind for r in rows} == {0, 1}
    assert {int(r.brand[6:]) % 6 for r in rows if r.forced_kind == 1} == {0}


def test_tables_and_files_are_written_when_they_are_read(spark, sf):
    """A parameter file or the geography needs no sales: the lines are not touched for them."""
    c = context(spark, sf, fresh=True)
    t = c.warehouse.tables
    for name in ("parameter_offers", "parameter_forced_slots_estimation", "warehouse_geography"):
        assert not QUERIES[name](c).isEmpty()
    assert t.written == {"DWH_DGEOGRAFIACAMPANA"} and set(t.files._open) == {"offers", "forced_slots_estimation"}
    assert QUERIES["parameter_profiles"](c).count() == c.e.profiles.count()
    assert t.written == {"DWH_DGEOGRAFIACAMPANA", "DWH_DEBELISTA"} and "facts" not in c.t.__dict__
