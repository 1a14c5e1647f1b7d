import duckdb
import pytest

from metalake import fixtures
from metalake import queries as Q
from metalake.engine import Engine
from metalake.model import AlreadyExists, ColumnMeta, InvalidInput, NotFound, NotImplementedInCatalog, TableMeta, UnsupportedFormat
from metalake.plans.ddl import CLASSES
from metalake.sources.metastore import MemoryMetastore

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine(spark):
    return fixtures.lake(spark, SF)


def rows(frame):
    clean = lambda v: None if v != v else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(repr([None if v is None else clean(v) for v in r]) for r in frame)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_queries(spark, name):
    con = duckdb.connect()
    for t in fixtures.SOURCES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(Q.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = Q.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert rows(got.select(*[f"`{n}`" for n in names]).collect()) == rows(want.fetchall())


def test_pushdown_and_pruning(engine):
    fixtures.ensure(engine, "lineitem_part")
    plan = engine.sql("select l_orderkey from hms.lake.lineitem_part where l_returnflag = 'R' and l_quantity > 40")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(l_returnflag" in plan and "PushedFilters: [IsNotNull(l_quantity)" in plan and "l_tax" not in plan


def test_statements(engine):
    for text in ("insert into hms.sf.nation values (1)", "drop table hms.sf.nation", "update hms.sf.nation set x = 1", "delete from hms.sf.nation", "create view hms.sf.v as select 1", "create schema hms.s", "alter table hms.sf.nation add column x int", "create index i on hms.sf.nation (x)", "create or replace table hms.sf.q (a int)", "create table hms.sf.q as select 1"):
        with pytest.raises(NotImplementedInCatalog):
            engine.sql(text)
    for text in ("load httpfs", "begin", "commit", "call hms_clear_cache()", "set unsafe_enable_version_guessing = true"):
        assert engine.sql(text).collect()[0][0] is True
    with pytest.raises(NotFound):
        engine.sql("select * from hms.sf.nothing")
    engine.sql("use hms.sf")
    assert engine.sql("select count(*) from nation").first()[0] == 25
    engine.current = None
    engine.sql("create secret s (type s3, key_id 'k', secret 'x', endpoint 'h:9000', url_style 'path', scope 's3://b')")
    conf = engine.spark._jsc.hadoopConfiguration()
    assert conf.get("fs.s3a.bucket.b.access.key") == "k" and conf.get("fs.s3a.bucket.b.path.style.access") == "true"


def test_names(engine, spark):
    """What WITH binds hides tables, where it does; views last no longer than a query's analysis."""
    engine.current = ("hms", "sf")
    try:
        one = lambda text: [tuple(r) for r in engine.sql(text).collect()]
        assert one("with nation as (select 1 a) select * from nation") == [(1,)]
        assert one("with x as (select count(*) n from nation), nation as (select n + 1 n from x) select nation.n, x.n from nation, x") == [(26, 25)]
        assert one("select * from (with nation as (select 1 a) select * from nation) t, (select count(*) from nation) u") == [(1, 25)]
        assert one("select count(*) from nation where n_regionkey in (with nation as (select 1 a) select a from nation)") == [(5,)]
        assert one("with recursive nation(a) as (select 1 union all select a + 1 from nation where a < 3) select max(a) from nation") == [(3,)]
        assert one("select 'hms.sf.\"x\" -- no comment' from HMS.SF.nation limit 1") == [('hms.sf."x" -- no comment',)]
        assert one("select sf.nation.n_name, hms.sf.nation.* from nation where sf.nation.n_nationkey = 3")[0][1] == 3
    finally:
        engine.current = None
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("_metalake_")]
    with pytest.raises(NotFound):
        engine.sql("select 1 where exists (select 1 from HMS.sf.nothing)")


def test_range_join(spark):
    from metalake.operators.joins import range_join

    spans = [(0, 0.0, 1e9), (1, 5.0, 5.5), (2, 5.5, 5.0), (3, -100.0, 7.0), (4, None, 3.0), (5, 1e6, 1e6 + 1e-3), (6, 7.0, 7.0)]
    points = [(i, float(p)) for i, p in enumerate([-101, -100, 0, 5, 5.25, 5.5, 6.99, 7, 1e6, 1e6 + 1e-3, 1e9])] + [(99, None)]
    got = range_join(spark.createDataFrame(points, "p int, x double"), spark.createDataFrame(spans, "s int, lo double, hi double"), "x", "lo", "hi")
    assert sorted((r["p"], r["s"]) for r in got.collect()) == sorted((p, s) for p, x in points for s, lo, hi in spans if None not in (x, lo) and lo <= x < hi)


def test_attach(spark):
    e = Engine(spark)
    e.sql("attach 'thrift://127.0.0.1:1' as far (type hive_metastore, default_schema 'x', READ_ONLY)")  # no connection yet
    assert e.catalogs["far"].read_only and e.catalogs["far"].default_schema == "x"
    with pytest.raises(AlreadyExists):
        e.attach("h:1", "far")
    with pytest.raises(InvalidInput):
        e.sql("attach 'h:1' as o (type hive_metastore, wrong 1)")
    with pytest.raises(InvalidInput):
        e.sql("create table far.x.t (a int) with (location '/tmp/t')")
    e.sql("detach far")


def test_cache_and_isolation(spark):
    store = MemoryMetastore(["d"])
    e = Engine(spark)
    c = e.attach("h:1", "m", "d", store=store, ttl_s=60)
    store.create_table(TableMeta("good", "d", f"{SF}/nation.parquet", *CLASSES["parquet"]))
    store.create_table(TableMeta("bad", "d", "/nowhere", *CLASSES["csv"], columns=(ColumnMeta("x", "interval"),)))
    assert c.tables("d") == ["bad", "good"]
    assert {r["table_name"] for r in e.columns().collect()} == {"good"}
    store.drop_table("d", "bad")
    assert c.tables("d") == ["bad", "good"]
    c.ttl_s = 0
    assert c.tables("d") == ["good"]
    store.create_table(TableMeta("odd", "d", "/x", "a", "b", "c"))
    with pytest.raises(UnsupportedFormat):
        e.table("m.d.odd")
    assert e.table("M.D.GOOD".replace("M", "m")).count() == 25


def test_stream(engine, spark, tmp_path):
    from metalake.streaming.tables import table_stream

    fixtures.ensure(engine, "lineitem_part")
    q = table_stream(engine, "hms.lake.lineitem_part").groupBy("l_returnflag").count().writeStream.format("memory").queryName("s").outputMode("complete").option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sum(r["count"] for r in spark.table("s").collect()) == engine.table("hms.sf.lineitem").count()


def test_avro_is_written_where_its_rows_are(spark, tmp_path, monkeypatch):
    """the lake's Avro table comes from the tasks that have its rows, and none of them comes to the driver."""
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(fixtures, "_built", {})
    engine = fixtures.lake(spark, SF)
    engine.root = str(tmp_path / "a lake")
    with monkeypatch.context() as m:
        for name in ("collect", "toPandas", "toArrow", "toLocalIterator"):
            m.setattr(DataFrame, name, lambda *a, **k: pytest.fail("rows come to the driver"))
        fixtures.ensure(engine, "events_avro")
    assert engine.sql("select * from hms.lake.events_avro").count() == engine.table("hms.sf.events").count()
    kind = {"type": "record", "name": "r", "fields": [{"name": "id", "type": "long"}, {"name": "t", "type": ["null", "string"]}]}
    df = spark.range(0, 25_000, 1, 3).selectExpr("id", "case when id % 5 > 0 then concat('\u00e9', id) end as t")
    fixtures.write_avro(df, kind, str(tmp_path / "in parts"))
    fixtures.write_avro(df.where("false"), kind, str(tmp_path / "empty"))
    files = sorted((tmp_path / "in parts").glob("[!._]*"))
    assert [f.name for f in files] == [f"part-{i:05d}.avro" for i in range(3)]
    assert sorted((r["id"], r["t"]) for f in files for r in fixtures.avro.read_container(f.read_bytes())) == sorted(map(tuple, df.collect()))
    read = lambda name: fixtures.avro.scan(spark, str(tmp_path / name), df.schema)
    assert sorted(map(tuple, read("in parts").collect())) == sorted(map(tuple, df.collect())) and read("empty").count() == 0


def test_date_from_epoch_needs_no_rows_in_the_driver(spark, tmp_path, monkeypatch):
    """from the plain tables to the written result, no row comes to the driver; dates before 1970 and missing ones are the SQL's."""
    from pyspark.sql.classic.dataframe import DataFrame

    for t in fixtures.SOURCES:
        if t != "events":
            (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    con = duckdb.connect()
    con.execute(f"create view given as select * from '{SF}/events.parquet'")
    odd = "case event_id % 5 when 0 then null when 1 then ts - interval 20000 day when 2 then timestamp '1969-12-31 23:59:59.999999' else ts end"
    con.execute(f"copy (select event_id, {odd} as ts, user_id, event_type, value, props from given) to '{tmp_path}/events.parquet' (format parquet)")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    monkeypatch.setattr(fixtures, "_built", {})
    with monkeypatch.context() as m:
        for name in ("collect", "toPandas", "toArrow", "toLocalIterator"):
            m.setattr(DataFrame, name, lambda *a, **k: pytest.fail("rows come to the driver"))
        Q.queries()["date_from_epoch"](spark, str(tmp_path)).write.parquet(f"{tmp_path}/out")
    want = con.execute(Q.oracle_sql()["date_from_epoch"]).fetchall()
    got = con.execute(f"select event_id, d, next_week from '{tmp_path}/out/*.parquet'").fetchall()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and any(r[1] is None for r in got) and any(r[1] == "1969-12-31" for r in got)
