"""Queries for every operator, each reading through the engine, and the same rows in SQL over the plain tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import ensure, lake
from .functions import formats, paths, types
from .model import ColumnMeta, Format, NotImplementedInCatalog, TableMeta
from .operators.joins import asof_join, range_join
from .plans.ddl import CLASSES, create_table
from .sources.metastore import parse_endpoint
from .streaming.tables import table_stream

Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _both(name: str, text: str, oracle: str | None = None, *tables: str) -> None:
    """A query as text for the engine; tables are names in the lake that it needs. The oracle is the text over the plain tables if not given."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        engine = lake(spark, sf_dir)
        for t in tables:
            ensure(engine, t)
        return engine.sql(text)

    _Q[name] = run
    _SQL[name] = oracle or text.replace("hms.sf.", "")


# ---------------------------------------------------------------- scans
_both("scan_parquet_flat", "select * from hms.sf.nation")
_both("scan_parquet_file_location", "select count(*) n, cast(sum(l_linenumber) as bigint) s from hms.sf.lineitem")
_both("scan_default_schema", "select n_name, n_regionkey from hms.nation where n_regionkey >= 2", "select n_name, n_regionkey from nation where n_regionkey >= 2")
_both("scan_parquet_partitioned", "select l_linenumber, count(*) n from hms.lake.lineitem_part where l_returnflag = 'R' and l_linestatus = 'F' group by l_linenumber", "select l_linenumber, count(*) n from lineitem where l_returnflag = 'R' and l_linestatus = 'F' group by l_linenumber", "lineitem_part")
_both("scan_parquet_decimal_partition", "select cast(bucket as string) bucket, typeof(bucket) kind, count(*) n from hms.lake.orders_decimal where bucket > 2.50 group by bucket", "select ((o_orderkey % 7) + 0.5)::decimal(10,2)::varchar bucket, 'decimal(10,2)' kind, count(*) n from orders where (o_orderkey % 7) + 0.5 > 2.50 group by 1", "orders_decimal")
_both("scan_parquet_multi_partition", "select year, month, status, count(*) n, round(sum(o_totalprice), 2) s from hms.lake.orders_multi group by year, month, status", "select year(o_orderdate)::int as year, month(o_orderdate)::int as month, o_orderstatus status, count(*) n, round(sum(o_totalprice), 2) s from orders group by 1, 2, 3", "orders_multi")
_both("scan_csv_hive_strict", "select * from hms.lake.customer_text", "select * from customer", "customer_text")
_both("scan_csv_spark_header", "select * from hms.lake.part_csv", "select * from part", "part_csv")
_both("scan_csv_tolerant", "select * from hms.lake.supplier_tolerant", "select s_suppkey, case when s_suppkey % 10 <> 7 then s_name end s_name, case when s_suppkey % 10 <> 7 then s_nationkey end s_nationkey, case when s_suppkey % 10 <> 7 then s_acctbal end s_acctbal from supplier where s_suppkey % 10 not in (3, 5)", "supplier_tolerant")
_both("scan_avro_date_as_int", "select event_id, ts, user_id, event_type, value, day from hms.lake.events_avro", "select event_id, epoch_us(ts) ts, user_id, event_type, value, (ts::date - date '1970-01-01')::int as day from events", "events_avro")
_DELTA = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders where o_orderkey % 3 <> 0 or o_orderkey % 6 = 0"
_both("scan_delta_log_replay", "select * from hms.lake.orders_delta", _DELTA, "orders_delta")
_both("scan_delta_checkpoint", "select * from hms.lake.orders_delta_checkpoint", _DELTA, "orders_delta_checkpoint")
_both("scan_iceberg_snapshot", "select * from hms.lake.part_iceberg", "select * from part", "part_iceberg")
_both("scan_iceberg_renamed", "select * from hms.lake.part_renamed", "select p_partkey, p_name title, p_brand, p_type p_name, p_size, p_retailprice from part", "part_renamed")
_both("scan_orc", "select * from hms.lake.supplier_orc", "select * from supplier", "supplier_orc")
_both("type_mapping_nested", "select event_id, s.user_id uid, cast(s.value as string) v, a[0] first, cast(m[a[0]] as string) mv from hms.lake.nested", "select event_id, user_id uid, value::decimal(12,2)::varchar v, event_type as first, value::decimal(10,2)::varchar mv from events", "nested")
_both("spark_schema_multipart", "select * from hms.lake.customer_recorded", "select * from customer", "customer_recorded")
_both("type_mapping_primitives", "select l_orderkey, cast(l_linenumber as tinyint) t, cast(l_linenumber as smallint) s, cast(l_partkey as int) i, cast(cast(l_quantity as decimal(10,2)) as string) d, l_quantity > 20 b, cast(cast(l_shipdate as date) as string) day_ from hms.sf.lineitem", "select l_orderkey, l_linenumber::tinyint t, l_linenumber::smallint s, l_partkey::int i, l_quantity::decimal(10,2)::varchar d, l_quantity > 20 b, l_shipdate::date::varchar as day_ from lineitem")

# ---------------------------------------------------------------- relational surface
_both("project_star_filter", "select *, c_acctbal * 2 twice from hms.sf.customer where c_mktsegment = 'BUILDING'")
_both("filter_range", "select o_orderkey, o_totalprice from hms.sf.orders where o_totalprice > 1000 and o_totalprice <= 90000 and o_orderkey >= 10 and o_orderkey < 5000")
_both("filter_in_between", "select o_orderkey, o_orderpriority from hms.sf.orders where o_orderstatus in ('F', 'O') and o_totalprice between 2000 and 60000")
_both("filter_bool_null", "select o_orderkey, o_orderstatus <> 'F' open from hms.sf.orders where o_custkey is not null and (o_orderstatus = 'P' or not o_totalprice > 50000)")
_both("filter_timestamp", "select o_orderkey, o_orderdate from hms.sf.orders where o_orderdate >= timestamp_ntz '1996-01-01 00:00:00'", "select o_orderkey, o_orderdate from orders where o_orderdate >= timestamp '1996-01-01 00:00:00'")
_both("join_inner_cross_format", "select n_name, count(*) n, round(sum(o_totalprice), 2) s from hms.lake.orders_delta o join hms.lake.customer_text c on o.o_custkey = c.c_custkey join hms.sf.nation on c_nationkey = n_nationkey group by n_name", f"select n_name, count(*) n, round(sum(o_totalprice), 2) s from ({_DELTA}) o join customer c on o.o_custkey = c.c_custkey join nation on c_nationkey = n_nationkey group by n_name", "orders_delta", "customer_text")
_both("join_left_groupby", "select c_mktsegment, count(*) n, count(o_orderkey) orders from hms.sf.customer c left join hms.sf.orders o on c.c_custkey = o.o_custkey group by c_mktsegment")
_both("join_right_full", "select coalesce(s_suppkey, -1) s, coalesce(c_custkey, -1) c from hms.sf.supplier full join hms.sf.customer on s_suppkey = c_custkey + 50")
_both("join_self_theta", "select a.n_nationkey x, b.n_nationkey y from hms.sf.nation a join hms.sf.nation b on a.n_regionkey = b.n_regionkey and a.n_name != b.n_name")
_both("join_semi_anti", "select c_custkey, 'has' kind from hms.sf.customer where exists (select 1 from hms.sf.orders where o_custkey = c_custkey) union all select c_custkey, 'none' from hms.sf.customer where not exists (select 1 from hms.sf.orders where o_custkey = c_custkey)")
_both("join_cross_small", "select r_name, n_name from hms.sf.region cross join hms.sf.nation")
_both("join_local_mixed", "select p_partkey, p_retailprice * (1 - d.pct / 100) price from hms.sf.part join (values (1, 10.0D), (2, 15.0D), (3, 5.0D)) d(id, pct) on p_partkey = d.id", "select p_partkey, p_retailprice * (1 - d.pct / 100) price from part join (values (1, 10.0::double), (2, 15.0::double), (3, 5.0::double)) d(id, pct) on p_partkey = d.id")
_both("agg_global", "select count(*) n, round(sum(l_quantity), 2) s, round(avg(l_extendedprice), 4) a, min(l_discount) lo, max(l_tax) hi from hms.sf.lineitem")
_both("agg_count_distinct", "select l_returnflag, count(distinct l_suppkey) s, count(distinct l_partkey) p from hms.sf.lineitem group by l_returnflag")
_both("agg_having", "select o_custkey, count(*) n from hms.sf.orders group by o_custkey having count(*) > 12")
_both("agg_rollup", "select l_returnflag f, l_linestatus s, count(*) n from hms.sf.lineitem group by rollup(l_returnflag, l_linestatus)")
_both("agg_cube", "select o_orderstatus s, o_orderpriority p, count(*) n from hms.sf.orders group by cube(o_orderstatus, o_orderpriority)")
_both("agg_grouping_sets", "select o_orderstatus s, o_orderpriority p, count(*) n from hms.sf.orders group by grouping sets ((o_orderstatus), (o_orderpriority), ())")
_both("distinct_multi", "select distinct l_returnflag, l_linestatus, l_linenumber from hms.sf.lineitem")
_both("subquery_derived", "select kind, count(*) n from (select case when o_totalprice > 100000 then 'big' else 'small' end kind from hms.sf.orders) t group by kind")
_both("subquery_correlated", "select c_custkey, (select max(o_totalprice) from hms.sf.orders where o_custkey = c_custkey) top from hms.sf.customer where c_acctbal > (select avg(c_acctbal) from hms.sf.customer)")
_both("cte", "with big as (select o_custkey, sum(o_totalprice) s from hms.sf.orders group by o_custkey) select count(*) n, round(max(s), 2) m from big where s > 100000")
_both("topk_order_limit", "select o_orderkey, o_totalprice from hms.sf.orders order by o_totalprice desc, o_orderkey limit 20")
_both("set_union", "select n_regionkey k from hms.sf.nation union select r_regionkey from hms.sf.region")
_both("set_intersect", "select c_nationkey k from hms.sf.customer intersect select s_nationkey from hms.sf.supplier")
_both("set_except", "select n_nationkey k from hms.sf.nation except select s_nationkey from hms.sf.supplier where s_suppkey < 20")
_both("window_rank", "select o_orderkey, row_number() over w r, rank() over w k, dense_rank() over w d, ntile(4) over w q from hms.sf.orders window w as (partition by o_custkey order by o_totalprice desc, o_orderkey)", "select o_orderkey, row_number() over w r, rank() over w k, dense_rank() over w d, ntile(4) over w q from orders window w as (partition by o_custkey order by o_totalprice desc, o_orderkey)")
_both("window_frame", "select o_orderkey, round(sum(o_totalprice) over (partition by o_custkey order by o_orderkey rows between 2 preceding and current row), 2) s, lag(o_orderkey) over (partition by o_custkey order by o_orderkey) prev from hms.sf.orders")
_both("arith_discount", "select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) charge from hms.sf.lineitem")
_both("typeof_map", "select distinct typeof(o_orderkey) k, typeof(o_totalprice) p, typeof(o_orderstatus) s from hms.sf.orders", "select distinct 'bigint' k, 'double' p, 'string' s from orders")
_both("date_from_epoch", "select event_id, cast(date_from_unix_date(day) as string) d, cast(date_add(date_from_unix_date(day), 7) as string) next_week from hms.lake.events_avro", "select event_id, ts::date::varchar d, (ts::date + interval 7 day)::date::varchar next_week from events", "events_avro")
_both("flagship_revenue", "select n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) revenue from hms.sf.lineitem join hms.sf.orders on l_orderkey = o_orderkey join hms.sf.customer on o_custkey = c_custkey join hms.sf.nation on c_nationkey = n_nationkey group by n_name")

# ---------------------------------------------------------------- names, scalar functions, further clauses
_both("filter_boolean_column", "select l_orderkey, l_linenumber from (select l_orderkey, l_linenumber, l_quantity > 25 as big from hms.sf.lineitem) t where big and not (l_linenumber = 1)")
_both("join_right", "select n_name, count(s_suppkey) n from hms.sf.supplier right join hms.sf.nation on s_nationkey = n_nationkey and s_acctbal > 0 group by n_name")
_both("set_intersect_all", "select c_nationkey k from hms.sf.customer intersect all select s_nationkey from hms.sf.supplier")
_both("set_except_all", "select c_nationkey k from hms.sf.customer except all select s_nationkey from hms.sf.supplier")
_both("set_union_all", "select n_regionkey k from hms.sf.nation union all select r_regionkey from hms.sf.region")
_both("window_values", "select o_orderkey, lead(o_orderkey) over w nxt, first_value(o_orderkey) over w f, last_value(o_orderkey) over (partition by o_custkey order by o_orderkey rows between unbounded preceding and unbounded following) l, nth_value(o_orderkey, 2) over w s, round(percent_rank() over w, 6) pr, round(cume_dist() over w, 6) cd from hms.sf.orders window w as (partition by o_custkey order by o_orderkey)",
      "select o_orderkey, lead(o_orderkey) over w nxt, first_value(o_orderkey) over w f, last_value(o_orderkey) over (partition by o_custkey order by o_orderkey rows between unbounded preceding and unbounded following) l, nth_value(o_orderkey, 2) over w s, round(percent_rank() over w, 6) pr, round(cume_dist() over w, 6) cd from orders window w as (partition by o_custkey order by o_orderkey)")
_both("window_range_frame", "select s_suppkey, count(*) over (order by s_suppkey range between 5 preceding and 5 following) n from hms.sf.supplier")
_both("scalar_strings", "select c_custkey, upper(c_name) u, substring(c_name, 1, 4) h, length(c_name) n, concat(c_mktsegment, '-', cast(c_nationkey as string)) j, replace(c_name, '#', '_') r, trim(concat('  ', c_mktsegment, ' ')) t, lpad(cast(c_nationkey as string), 4, '0') p from hms.sf.customer where c_name like '%1%'",
      "select c_custkey, upper(c_name) u, substring(c_name, 1, 4) h, length(c_name)::int n, c_mktsegment || '-' || c_nationkey::varchar j, replace(c_name, '#', '_') r, trim('  ' || c_mktsegment || ' ') t, lpad(c_nationkey::varchar, 4, '0') p from customer where c_name like '%1%'")
_both("scalar_arrays", "select n_nationkey, size(a) n, a[1] second, array_contains(a, 'x') has, array_join(a, '+') j from (select n_nationkey, split(concat(n_name, ',x,', cast(n_regionkey as string)), ',') a from hms.sf.nation) t",
      "select n_nationkey, len(a)::int n, a[2] as second, list_contains(a, 'x') has, array_to_string(a, '+') j from (select n_nationkey, string_split(n_name || ',x,' || n_regionkey::varchar, ',') a from nation) t")
_both("scalar_maps", "select n_nationkey, m['k'] k, m['none'] none, cardinality(m) n from (select n_nationkey, map('k', n_name, 'r', cast(n_regionkey as string)) m from hms.sf.nation) t",
      "select n_nationkey, m['k'] k, m['none'] as none, cardinality(m)::int n from (select n_nationkey, map {'k': n_name, 'r': n_regionkey::varchar} m from nation) t")
_both("scalar_json", "select n_nationkey, get_json_object(j, '$.name') n, cast(get_json_object(j, '$.at.region') as bigint) r from (select n_nationkey, to_json(named_struct('name', n_name, 'at', named_struct('region', n_regionkey))) j from hms.sf.nation) t",
      "select n_nationkey, n_name n, n_regionkey::bigint r from nation")
_both("date_interval", "select o_orderkey, cast(o_orderdate + interval 1 month as string) a, cast(cast(o_orderdate as date) - interval 10 day as string) b, date_trunc('month', o_orderdate) m from hms.sf.orders",
      "select o_orderkey, (o_orderdate + interval 1 month)::varchar a, ((o_orderdate::date - interval 10 day)::date)::varchar b, date_trunc('month', o_orderdate)::timestamp m from orders")
_both("agg_conditional", "select o_orderpriority, count(*) filter (where o_totalprice > 100000) big, cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as bigint) f, min_by(o_orderkey, o_orderkey) least from hms.sf.orders group by o_orderpriority", "select o_orderpriority, count(*) filter (where o_totalprice > 100000) big, sum(case when o_orderstatus = 'F' then 1 else 0 end)::bigint f, min(o_orderkey) least from orders group by o_orderpriority")
_both("agg_approximate", "select abs(approx_count_distinct(o_custkey) - count(distinct o_custkey)) <= 0.1 * count(distinct o_custkey) close, abs(percentile_approx(o_orderkey, 0.5, 10000) - percentile(o_orderkey, 0.5)) <= 0.01 * max(o_orderkey) middle from hms.sf.orders", "select true as close, true as middle")
_both("join_hints", "select /*+ MERGE(n), BROADCAST(r) */ r_name, count(*) n from hms.sf.nation n join hms.sf.region r on n.n_regionkey = r.r_regionkey join hms.sf.supplier s on s.s_nationkey = n.n_nationkey group by r_name", "select r_name, count(*) n from nation join region on n_regionkey = r_regionkey join supplier on s_nationkey = n_nationkey group by r_name")
_both("cte_shadows_table", "with nation as (select 1 a union all select 2), r as (select count(*) n from hms.sf.nation) select nation.a, r.n, (select count(*) from nation) k from nation cross join r", "with local_nation as (select 1 a union all select 2), r as (select count(*) n from nation) select local_nation.a, r.n, (select count(*) from local_nation) k from local_nation cross join r")
_both("names_any_case", "-- catalogs, schemas and tables\nselect HMS.SF.Nation.n_name, sf.nation.n_regionkey from Hms.\"sf\".NATION /* quoted */ where hms.sf.nation.n_nationkey > 3", "select n_name, n_regionkey from nation where n_nationkey > 3")


# ---------------------------------------------------------------- metadata and operators
def _query(oracle: str | None = None):
    def keep(f: Query) -> Query:
        _Q[f.__name__] = f
        if oracle:
            _SQL[f.__name__] = oracle
        return f

    return keep


@_query("select * from (values ('hms', 'default'), ('hms', 'lake'), ('hms', 'sf')) t(catalog_name, schema_name)")
def catalog_list_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).sql("select * from information_schema.schemata")


@_query("select * from (values ('customer'), ('events'), ('lineitem'), ('nation'), ('orders'), ('part'), ('region'), ('supplier')) t(name)")
def catalog_list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).sql("show tables from hms.sf")


@_query("select * from (values ('hms'), ('memory')) t(database_name)")
def catalog_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).sql("show databases")


@_query("select * from (values ('o_orderkey', 'BIGINT'), ('o_totalprice', 'DOUBLE'), ('month', 'INTEGER'), ('status', 'VARCHAR'), ('year', 'INTEGER')) t(column_name, column_type)")
def describe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensure(lake(spark, sf_dir), "orders_multi").sql("describe hms.lake.orders_multi").select("column_name", "column_type")


@_query("select 'hms.sf.orders' qualified_name, 'EXTERNAL_TABLE' table_type, 'hms_scan##hms.sf.orders' scan_name")
def lineage_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = lake(spark, sf_dir).lineage("hms.sf.orders")
    return spark.createDataFrame([(x.qualified_name, x.table_type, x.scan_name)], "qualified_name string, table_type string, scan_name string")


@_query("select * from (values ('id', 'int', 'parquet'), ('name', 'string', 'parquet'), ('day', 'date', 'parquet')) t(name, type, kind)")
def create_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = lake(spark, sf_dir)
    catalog = engine.catalogs["hms"]
    if not catalog.exists("lake", "made"):
        create_table(catalog, "lake", "made", types.parse_columns("id int, name varchar, day date"), {"location": f"{engine.root}/made"}, ["day"])
    m = catalog.store.table("lake", "made")
    return spark.createDataFrame([(c.name, c.type, formats.detect(m).value) for c in [*m.columns, *m.partition_keys]], "name string, type string, kind string")


@_query("select * from (values (1, 'delta'), (2, 'iceberg'), (3, 'delta'), (4, 'iceberg'), (5, 'delta'), (6, 'parquet'), (7, 'avro'), (8, 'csv'), (9, 'csv'), (10, 'orc'), (11, 'unknown')) t(id, format)")
def format_detection_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = [({"spark.sql.sources.provider": "DELTA"}, "", ""), ({"table_type": "iceberg"}, "", ""), ({"table_type": "Delta"}, "x.Parquet", ""), ({}, "x.HiveIcebergInputFormat", "Parquet"), ({}, "", "x.DeltaSerDe"), ({}, "x.MapredParquetInputFormat", ""), ({}, "", "AvroSerDe"), ({}, "TextInputFormat", ""), ({}, "SequenceFileInputFormat", "LazySimpleSerDe"), ({}, "OrcInputFormat", ""), ({}, "x", "y")]
    return spark.createDataFrame([(i + 1, formats.detect(TableMeta("t", "d", parameters=p, input_format=f, serde=s)).value) for i, (p, f, s) in enumerate(cases)], "id int, format string")


@_query("select * from (values (1, 's3a://b/k'), (2, 's3a://b/k'), (3, 's3a://b/k/t'), (4, 'https://h/b/k'), (5, '/d/x'), (6, '/d/x/'), (7, '/w/t'), (8, '/new')) t(id, path)")
def path_normalization_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = lambda loc, **p: TableMeta("t", "d", loc, parameters=p)
    got = [
        paths.normalise(m("s3://b/k"), Format.PARQUET), paths.normalise(m("s3n://b/k/"), Format.CSV), paths.normalise(m("http://h:9000/b/k/t"), Format.PARQUET), paths.normalise(m("https://h/b/k"), Format.PARQUET),
        paths.normalise(m("/d/x-__PLACEHOLDER__/y"), Format.PARQUET), paths.normalise(m("/d/x"), Format.DELTA), paths.normalise(m("/old", metadata_location="/w/t/metadata/v1.json"), Format.ICEBERG), paths.normalise(m("/x", path="/new"), Format.DELTA).rstrip("/"),
    ]
    return spark.createDataFrame([(i + 1, p) for i, p in enumerate(got)], "id int, path string")


@_query("select * from (values ('thrift://h:1', 'h', 1), ('h', 'h', 9083), ('h:70', 'h', 70)) t(uri, host, port)")
def endpoint_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(u, *parse_endpoint(u)) for u in ("thrift://h:1", "h", "h:70")], "uri string, host string, port int")


@_query("select o.o_orderkey, (select max_by(e.event_id, (e.ts, e.event_id)) from events e where e.user_id = o.o_custkey and e.ts <= o.o_orderdate) event_id from orders o")
def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = lake(spark, sf_dir)
    orders = engine.table("hms.sf.orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), "o_orderdate")
    return asof_join(orders, engine.table("hms.sf.events").select("user_id", "ts", "event_id"), "user_id", "o_orderdate", "ts", ["event_id"]).select("o_orderkey", "event_id")


@_query("select band, count(*) n from orders join (select p_partkey band, p_partkey * 500.0 lo, p_partkey * 500.0 + 700.0 hi from part) b on lo <= o_totalprice and o_totalprice < hi group by band")
def join_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = lake(spark, sf_dir)
    bands = engine.table("hms.sf.part").select(F.col("p_partkey").alias("band"), (F.col("p_partkey") * 500.0).alias("lo"), (F.col("p_partkey") * 500.0 + 700.0).alias("hi"))
    return range_join(engine.table("hms.sf.orders"), bands, "o_totalprice", "lo", "hi").groupBy("band").agg(F.count("*").alias("n"))


@_query("select distinct column_name, ordinal_position::int ordinal_position, data_type from information_schema.columns where table_name = 'nation'")
def information_schema_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake(spark, sf_dir).sql("select column_name, ordinal_position, data_type from information_schema.columns where table_catalog = 'hms' and table_schema = 'sf' and table_name = 'nation'")


@_query("select p_partkey, p_retailprice * (1 - pct / 100) price from part join (values (1, 10.0::double), (2, 15.0::double), (3, 5.0::double)) d(id, pct) on p_partkey = d.id")
def join_local_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A local table created, filled and joined with a catalogued one."""
    engine, name = lake(spark, sf_dir), f"local_{uuid.uuid4().hex}"
    engine.sql(f"create table {name} (id int, pct double) using parquet")
    engine.sql(f"insert into {name} values (1, 10.0), (2, 15.0), (3, 5.0)")
    rows = engine.sql(f"select p_partkey, p_retailprice * (1 - d.pct / 100) price from hms.sf.part join {name} d on p_partkey = d.id").collect()
    engine.sql(f"drop table {name}")
    return spark.createDataFrame(rows, "p_partkey bigint, price double")


@_query("select * from (values ('made_by_statement', 'a', 'int'), ('made_by_statement', 'b', 'string'), ('made_by_statement', 'day', 'date')) t(name, column_name, type)")
def create_table_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = lake(spark, sf_dir)
    catalog = engine.catalogs["hms"]
    if not catalog.exists("lake", "made_by_statement"):
        engine.sql(f"create table hms.lake.made_by_statement (a integer, b varchar, day date) partitioned by (day) with (location '{engine.root}/made_by_statement')")
    m = catalog.store.table("lake", "made_by_statement")
    return spark.createDataFrame([(m.name, c.name, c.type) for c in [*m.columns, *m.partition_keys]], "name string, column_name string, type string")


_REFUSED = {
    "insert": "insert into hms.sf.nation values (1, 'x', 1)", "update": "update hms.sf.nation set n_name = 'x'", "delete": "/* all */ delete from hms.sf.nation", "drop": "-- gone\ndrop table hms.sf.nation",
    "alter": "alter table hms.sf.nation add column x int", "create view": "create view hms.sf.v as select 1", "create schema": "create schema hms.s", "create index": "create index i on hms.sf.nation (n_name)",
    "create function": "create function hms.sf.f as 'x'", "create as": "create table hms.sf.t as select 1 a", "create or replace": "create or replace table hms.sf.t (a int)", "merge": "merge into hms.sf.nation using x on true when matched then delete",
    "create table function": "create table function hms.sf.f as select 1", "create collation": "create collation hms.sf.c",
}


@_query(f"select * from (values {', '.join(f'({k!r})' for k in _REFUSED)}) t(statement)")
def statements_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of attached catalogs that are refused by name."""
    engine, refused = lake(spark, sf_dir), []
    for kind, text in _REFUSED.items():
        try:
            engine.sql(text)
        except NotImplementedInCatalog:
            refused.append((kind,))
    return spark.createDataFrame(refused, "statement string")


@_query("select count(*)::bigint before, count(*)::bigint + 1 as after from region")
def refresh_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose files change shows them after a refresh."""
    engine, name = lake(spark, sf_dir), f"changing_{uuid.uuid4().hex}"
    at = f"{engine.root}/{name}"
    regions = engine.table("hms.sf.region")
    regions.write.parquet(at)
    engine.store.create_table(TableMeta(name, "lake", at, *CLASSES["parquet"], columns=(ColumnMeta("r_regionkey", "bigint"), ColumnMeta("r_name", "string"))))
    before = engine.table(f"hms.lake.{name}").count()
    regions.limit(1).write.mode("append").parquet(at)
    after = engine.catalogs["hms"].refresh("lake", name).df().count()
    engine.store.drop_table("lake", name)
    return spark.createDataFrame([(before, after)], "before bigint, after bigint")


@_query("select l_returnflag, count(*) n from lineitem group by l_returnflag")
def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogued table read as a stream, aggregated, and its last state as a table."""
    engine, name = ensure(lake(spark, sf_dir), "lineitem_part"), f"stream_{uuid.uuid4().hex}"
    counts = table_stream(engine, "hms.lake.lineitem_part").groupBy("l_returnflag").agg(F.count("*").alias("n"))
    counts.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{engine.root}/{name}").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
