"""The reference's relational and statistical operators as queries over the test tables, each with its SQL.

Values are rounded half to even on both sides where sums of floating-point numbers depend on their order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litholake.functions import fits, geometry, robust, strings
from litholake.operators import catalogue, fingers, graph, greedy, joins, rollup, sequence
from litholake.session import materialise, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r6(c):
    return F.bround(c, 6)


def r4(c):
    return F.bround(c, 4)


DEDUPED = "(select distinct on (component_id) * from defect_components order by component_id, ingested_at)"


def components(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Components, each id once."""
    return table(spark, sf_dir, "defect_components", "component_id", *cols).dropDuplicates(["component_id"])


@query("""
with m as (select l_returnflag, median(l_extendedprice) c from lineitem group by 1),
d as (select l.l_returnflag, c, abs(l_extendedprice - c) a from lineitem l join m using (l_returnflag)),
s as (select l_returnflag, any_value(c) c, greatest(1.4826 * median(a), 1e-9) s from d group by 1)
select l_returnflag, count(*) as n, round_even(any_value(c), 4) as center, round_even(any_value(s), 4) as spread,
  count(*) filter (where abs((l_extendedprice - c) / s) > 2.5) as outliers
from lineitem join s using (l_returnflag) group by 1""")
def q01_robust_z_outliers(spark, sf_dir):
    """A1, A2"""
    li = table(spark, sf_dir, "lineitem", "l_returnflag", "l_extendedprice")
    s = materialise(robust.center_spread(li, ["l_returnflag"], "l_extendedprice", 1e-9), "spread")  # a row for each group
    z = robust.robust_z(li, ["l_returnflag"], "l_extendedprice", stats=s)
    n = z.groupBy("l_returnflag").agg(F.count_if(F.abs("z") > 2.5).alias("outliers"))
    return s.join(n, "l_returnflag").select("l_returnflag", "n", r4("center").alias("center"), r4("spread").alias("spread"), "outliers")


@query("""
with p as (select o_orderpriority, quantile_cont(o_totalprice, 0.1::double) lo, quantile_cont(o_totalprice, 0.9::double) hi from orders group by 1)
select o_orderpriority, round_even(median(o_totalprice), 4) as trimmed_median, count(*) as kept
from orders join p using (o_orderpriority) where o_totalprice between lo and hi group by 1""")
def q02_trimmed_median(spark, sf_dir):
    """A3"""
    o = table(spark, sf_dir, "orders", "o_orderpriority", "o_totalprice")
    return robust.trimmed_median(o, ["o_orderpriority"], "o_totalprice").withColumn("trimmed_median", r4("trimmed_median"))


@query("""
with c as (select p_brand, p_size, count(*) n, min(p_partkey) seen from part group by 1, 2)
select p_brand, arg_max(p_size, n * 1000000000 - seen) as mode, max(n) as mode_count from c group by 1""")
def q03_modal_size(spark, sf_dir):
    """A4"""
    return robust.mode_first(table(spark, sf_dir, "part", "p_brand", "p_size", "p_partkey"), ["p_brand"], "p_size", "p_partkey")


@query("""
with g as (select user_id, event_id, epoch_us(ts) t, case when epoch_us(ts) - lag(epoch_us(ts)) over w > 86400000000 then 1 else 0 end f
  from events window w as (partition by user_id order by ts, event_id)),
s as (select user_id, t, sum(f) over (partition by user_id order by t, event_id rows unbounded preceding) island from g)
select user_id, island::bigint as island, count(*) as events, max(t) - min(t) as span_us from s group by 1, 2""")
def q04_gap_islands(spark, sf_dir):
    """W2, W17"""
    e = table(spark, sf_dir, "events", "user_id", "event_id", "ts").withColumn("t", F.unix_micros("ts"))
    s = sequence.islands(e, ["user_id"], "t", 86_400_000_000, ties=["event_id"])
    return s.groupBy("user_id", F.col("island").cast("long").alias("island")).agg(F.count("*").alias("events"), (F.max("t") - F.min("t")).alias("span_us"))


@query("""
with recursive v as (select col_global k, bbox_um.x0 x, row_number() over (partition by cell_col order by bbox_um.x0, cell_row) i, cell_col from cells),
f as (select cell_col, i, x as s, 1 as n, 0 as c from v where i = 1
 union all
 select v.cell_col, v.i, case when abs(v.x - f.s / f.n) <= 5000 then f.s + v.x else v.x end,
  case when abs(v.x - f.s / f.n) <= 5000 then f.n + 1 else 1 end,
  case when abs(v.x - f.s / f.n) <= 5000 then f.c else f.c + 1 end
 from f join v on v.cell_col = f.cell_col and v.i = f.i + 1)
select cell_col, c::bigint as cluster_no, max(n)::bigint as n, round_even(arg_max(s, n) / max(n), 6) as center from f group by 1, 2""")
def q05_cluster_1d(spark, sf_dir):
    """W1"""
    c = table(spark, sf_dir, "cells").select("cell_col", F.col("bbox_um.x0").alias("x"))
    return sequence.running_mean_clusters(c, ["cell_col"], "x", 5000.0).withColumn("center", r6("center"))


DAILY = "d as (select event_type, date_trunc('day', ts) as d, count(*) as n, round_even(sum(value), 4) as v from events group by 1, 2)"


def daily(spark, sf_dir):
    e = table(spark, sf_dir, "events", "event_type", "ts", "value")
    return e.groupBy("event_type", F.date_trunc("day", "ts").alias("d")).agg(F.count("*").alias("n"), F.bround(F.sum("value"), 4).alias("v"))


def day_text(df):
    return df.withColumn("d", F.date_format("d", "yyyy-MM-dd"))


@query(f"""
with {DAILY}
select event_type, strftime(d, '%Y-%m-%d') as d, round_even(sum(n) over (partition by event_type order by d rows between 3 preceding and 3 following) / 7.0::double, 6) as smooth from d""")
def q06_moving_mean(spark, sf_dir):
    """W4"""
    return day_text(sequence.moving_mean_same(daily(spark, sf_dir), ["event_type"], "d", "n", 3).select("event_type", "d", r6("smooth").alias("smooth")))


@query(f"""
with {DAILY}
select event_type, strftime(d, '%Y-%m-%d') as d, round_even(coalesce(greatest(avg(n) over (partition by event_type order by d rows between 1 following and 3 following)
 - avg(n) over (partition by event_type order by d rows between 3 preceding and 1 preceding), 0), 0), 6) as step from d
 """.replace("coalesce(greatest(", "(case when avg(n) over (partition by event_type order by d rows between 1 following and 3 following) is null or avg(n) over (partition by event_type order by d rows between 3 preceding and 1 preceding) is null then 0 else greatest(").replace(", 0), 0), 6)", ", 0) end), 6)"))
def q07_directional_transition(spark, sf_dir):
    """W5"""
    return day_text(sequence.directional_transition(daily(spark, sf_dir), ["event_type"], "d", "n", 3).select("event_type", "d", r6("step").alias("step")))


@query(f"""
with {DAILY}, n as (select *, lag(n) over w p, lead(n) over w q from d window w as (partition by event_type order by d))
select event_type, strftime(d, '%Y-%m-%d') as d, n from n where (p is null or n > p) and (q is null or n >= q)""")
def q08_local_maxima(spark, sf_dir):
    """W8"""
    return day_text(sequence.local_maxima(daily(spark, sf_dir), ["event_type"], "d", "n").select("event_type", "d", "n"))


@query(f"""
with {DAILY}, c as (select event_type, row_number() over (partition by event_type order by d) i, n - avg(n) over (partition by event_type) x from d),
s as (select a.event_type, k, sum(a.x * b.x) s from c a cross join range(2, 10) t(k) join c b on b.event_type = a.event_type and b.i = a.i + k group by 1, 2)
select event_type, arg_max(k, round_even(s, 6) * 1e6 - k)::int as lag, round_even(max(s), 4) as strength from s group by 1""")
def q09_autocorrelation(spark, sf_dir):
    """W13"""
    return sequence.autocorrelation(daily(spark, sf_dir), ["event_type"], "d", "n", 2, 10).select("event_type", F.col("lag").cast("int").alias("lag"), r4("strength").alias("strength"))


@query(f"""
with {DAILY}, a as (select event_type, d, n, list_filter([lag(n, 7) over w, lead(n, 7) over w, lag(n, 14) over w, lead(n, 14) over w, lag(n, 21) over w, lead(n, 21) over w], lambda x: x is not null) l
 from d window w as (partition by event_type order by d))
select event_type, strftime(d, '%Y-%m-%d') as d, round_even(list_median(list_transform(l, lambda x: x::double)), 6) as expected from a""")
def q10_periodic_neighbours(spark, sf_dir):
    """W11"""
    return day_text(sequence.periodic_neighbours(daily(spark, sf_dir), ["event_type"], "d", "n", 7).select("event_type", "d", r6("expected").alias("expected")))


@query("""
with b as (select l_returnflag g, l_suppkey % 20 as x, month(l_shipdate) as y, l_quantity v from lineitem),
gl as (select g, median(v) gm from b group by 1),
c as (select b.g, x, case when count(*) >= 8 then median(v) else any_value(gm) end cm from b join gl using (g) group by 1, 2),
r as (select b.g, y, median(v - cm) rm from b join c using (g, x) group by 1, 2)
select b.g, b.x, b.y, count(*) as n, round_even(any_value(cm + rm), 6) as expected from b join c using (g, x) join r using (g, y) group by 1, 2, 3""")
def q11_column_row_model(spark, sf_dir):
    """W9, W10"""
    b = table(spark, sf_dir, "lineitem", "l_returnflag", "l_suppkey", "l_shipdate", "l_quantity").select(F.col("l_returnflag").alias("g"), (F.col("l_suppkey") % 20).alias("x"), F.month("l_shipdate").alias("y"), F.col("l_quantity").alias("v"))
    e = sequence.column_row_expected(b, ["g"], "x", "y", "v")
    return e.groupBy("g", "x", "y").agg(F.count("*").alias("n"), r6(F.first("expected")).alias("expected"))


WINDOWS = "w as (select k as window_id, k * 900.0::double as lo, k * 900.0::double + (case when k % 3 = 0 then 1000 else 900 end) as hi from range(0, 500) t(k))"


def windows(spark):
    return spark.range(500).select(F.col("id").alias("window_id"), (F.col("id") * 900.0).alias("lo"), (F.col("id") * 900.0 + F.when(F.col("id") % 3 == 0, 1000.0).otherwise(900.0)).alias("hi"))


@query(f"""
with {WINDOWS}, m as (select o_orderkey, count(window_id) n, min(window_id) w from orders left join w on o_totalprice >= lo and o_totalprice < hi group by 1)
select n::bigint as matches, case when n = 1 then w end as window_id, count(*) as orders from m group by 1, 2""")
def q12_exactly_one_window(spark, sf_dir):
    """J7"""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    return joins.exactly_one_window(o, "o_orderkey", "o_totalprice", windows(spark), "window_id", "lo", "hi", 1000.0).groupBy(F.col("matches").cast("long").alias("matches"), "window_id").agg(F.count("*").alias("orders"))


@query(f"""
with {WINDOWS}, b as (select c_custkey, c_acctbal as lo2, c_acctbal + 500 as hi2 from customer)
select window_id, count(*) as customers, round_even(sum(least(hi, hi2) - greatest(lo, lo2)), 2) as shared from b join w on greatest(lo, lo2) < least(hi, hi2) group by 1""")
def q13_interval_overlap(spark, sf_dir):
    """J8"""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal").select("c_custkey", F.col("c_acctbal").alias("lo2"), (F.col("c_acctbal") + 500).alias("hi2"))
    m = joins.overlapping(windows(spark), "lo", "hi", c, "lo2", "hi2", 1000.0)
    return m.groupBy("window_id").agg(F.count("*").alias("customers"), F.bround(F.sum(F.least("hi", "hi2") - F.greatest("lo", "lo2")), 2).alias("shared"))


@query("""
with m as (select s_suppkey, c_custkey, abs(s_acctbal - c_acctbal) d from supplier join customer on s_nationkey = c_nationkey where abs(s_acctbal - c_acctbal) <= 400),
r as (select *, row_number() over (partition by s_suppkey order by d, c_custkey) k from m)
select s_suppkey, c_custkey, round_even(d, 4) as distance from r where k = 1""")
def q14_nearest_constrained(spark, sf_dir):
    """J9, J14, J15"""
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal", "s_nationkey").withColumnRenamed("s_nationkey", "n")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_nationkey").withColumnRenamed("c_nationkey", "n")
    return joins.nearest(s, "s_suppkey", "s_acctbal", c, "c_custkey", "c_acctbal", 400.0, ["n"]).withColumn("distance", r4("distance"))


STEM = r"lower(regexp_extract(trim({0}), '([^/\\]*?)(\.[^./\\]*)?$', 1))"


@query(f"""
with c as (select distinct on (record_id) record_id, cell_stem, annotation_name, image_path from cell_records),
e as (select distinct on (entry_id) entry_id, image_path from device_entries),
r as (select {STEM.format("image_path")} k, min(entry_id) entry_id from e where image_path is not null group by 1),
t as (select record_id, p, k from (select record_id, 0 p, {STEM.format("cell_stem")} k from c union all select record_id, 1, {STEM.format("annotation_name")} from c union all select record_id, 2, {STEM.format("image_path")} from c) where k is not null),
m as (select record_id, p, entry_id, row_number() over (partition by record_id order by p) n from t join r using (k))
select c.record_id, m.p::int as priority, m.entry_id from c left join m on m.record_id = c.record_id and n = 1""")
def q15_alias_precedence(spark, sf_dir):
    """J5, J6, S13"""
    c = table(spark, sf_dir, "cell_records", "record_id", "cell_stem", "annotation_name", "image_path").dropDuplicates(["record_id"])
    e = table(spark, sf_dir, "device_entries", "entry_id", "image_path").filter("image_path is not null").dropDuplicates(["entry_id"]).withColumn("k", strings.device_key(F.col("image_path")))
    keys = [strings.device_key(F.col(x)) for x in ("cell_stem", "annotation_name", "image_path")]
    return joins.join_by_precedence(c, "record_id", keys, e, "k", ["entry_id"], "entry_id").select("record_id", F.col("priority").cast("int").alias("priority"), "entry_id")


@query(f"""
select distinct {STEM.format("image_path")} as device_key from device_entries d where image_path is not null
and not exists (select 1 from cell_records c where {STEM.format("c.cell_stem")} = {STEM.format("d.image_path")})""")
def q16_unmatched_devices(spark, sf_dir):
    """J4"""
    d = table(spark, sf_dir, "device_entries", "image_path").filter("image_path is not null").select(strings.device_key(F.col("image_path")).alias("device_key")).distinct()
    c = table(spark, sf_dir, "cell_records", "cell_stem").select(strings.device_key(F.col("cell_stem")).alias("device_key")).filter("device_key is not null").distinct()
    return d.join(c, "device_key", "left_anti")


@query("""
select wafer_id, source_group from wafers where regexp_replace(lower(trim(wafer_id)), '^wafer_', '') in ('refgrid', 'nothing') or lower(trim(wafer_id)) in ('refgrid', 'nothing') or lower(trim(source_group)) in ('refgrid', 'nothing', 'padset')""".replace("('refgrid', 'nothing')", "('refgrid', 'nothing', 'padset')"))
def q17_selectors(spark, sf_dir):
    """J1"""
    w = table(spark, sf_dir, "wafers", "wafer_id", "source_group")
    hit, _ = joins.select_by_alias(w, [F.col("wafer_id"), strings.wafer_key(F.col("wafer_id")), F.col("source_group")], ["Refgrid", "padset", "nothing"])
    return hit


@query("""
with l as (select s_suppkey a, s_acctbal x, s_nationkey % 5 k from supplier where s_nationkey < 12), r as (select s_suppkey b, s_acctbal y, s_nationkey % 5 k from supplier where s_nationkey >= 12),
m as (select a, b, x, y from l join r using (k) where abs(x - y) <= 900)
select a, arg_max(b, -round_even(abs(x - y), 4) * 1000000 - b) as b from m group by 1""")
def q18_pair_consistency(spark, sf_dir):
    """J12"""
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal", "s_nationkey")
    le = s.filter("s_nationkey < 12").select(F.col("s_suppkey").alias("a"), F.col("s_acctbal").alias("x"), F.col("s_nationkey").alias("ln"))
    ri = s.filter("s_nationkey >= 12").select(F.col("s_suppkey").alias("b"), F.col("s_acctbal").alias("y"), F.col("s_nationkey").alias("rn"))
    d = F.abs(F.col("x") - F.col("y"))
    return joins.consistent_pairs(le, ri, F.col("ln") % 5, F.col("rn") % 5, d <= 900, -r4(d) * 1000000 - F.col("b"), "a").select("a", "b")


BOXES = f"""b as (select component_id, wafer_id, scan_no, cell_row, cell_col, bbox_px[1] x0, bbox_px[2] y0, bbox_px[1] + bbox_px[3] x1, bbox_px[2] + bbox_px[4] y1, score, area_px from {DEDUPED} where wafer_id is not null and bbox_px is not null and len(bbox_px) = 4)"""


def boxes(spark, sf_dir):
    c = components(spark, sf_dir, "wafer_id", "scan_no", "cell_row", "cell_col", "bbox_px", "score", "area_px").filter("wafer_id is not null and size(bbox_px) = 4")
    b = lambda i: F.get("bbox_px", F.lit(i))
    return c.select("component_id", "wafer_id", "scan_no", "cell_row", "cell_col", b(0).alias("x0"), b(1).alias("y0"), (b(0) + b(2)).alias("x1"), (b(1) + b(3)).alias("y1"), "score", "area_px")


@query(f"""
with recursive {BOXES},
t as (select a.component_id a, c.component_id z from b a join b c on a.wafer_id = c.wafer_id and a.scan_no = c.scan_no and a.cell_row = c.cell_row and a.cell_col = c.cell_col
 and a.component_id <> c.component_id and a.x0 <= c.x1 and c.x0 <= a.x1 and a.y0 <= c.y1 and c.y0 <= a.y1),
reach as (select component_id id, component_id root from b union select t.z, reach.root from reach join t on t.a = reach.id),
comp as (select id, min(root) component from reach group by 1)
select component, count(*) as members, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from b join comp on id = component_id group by 1""")
def q19_touching_components(spark, sf_dir):
    """Components of touching boxes of one crop, their size and bounds."""
    b = boxes(spark, sf_dir)
    e = graph.touching_boxes(b, "component_id", 256.0, ["wafer_id", "scan_no", "cell_row", "cell_col"])
    c = graph.connected_components(b, e, "component_id", "a", "b")
    return b.join(c, "component_id").groupBy("component").agg(F.count("*").alias("members"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


@query("""
with f as (select r_name, n_name, l_returnflag, sum(l_extendedprice) o, sum(case when l_returnflag = 'R' then l_extendedprice * l_discount else l_extendedprice * l_tax end) r
 from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2, 3),
p as (select *, case when o > 1e-12 then 100 * r / o end as p from f)
select (case when grouping(l_returnflag) = 0 then 3 when grouping(n_name) = 0 then 2 when grouping(r_name) = 0 then 1 else 0 end)::int as depth, r_name, n_name, l_returnflag,
 round_even(sum(o), 4) as original, round_even(sum(r), 4) as removed, round_even(sum(o) - sum(r), 4) as remaining, round_even(100 * sum(r) / sum(o), 6) as weighted_pct, round_even(avg(p), 6) as mean_pct
from p group by grouping sets ((r_name, n_name, l_returnflag), (r_name, n_name), (r_name), ())""")
def q20_hierarchical_loss(spark, sf_dir):
    """Loss by region, nation and flag; the dimension tables are joined first, so the large table is shuffled once."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_extendedprice", "l_discount", "l_tax")
    o, c = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n, r = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey"), table(spark, sf_dir, "region", "r_regionkey", "r_name")
    places = n.join(r, n.n_regionkey == r.r_regionkey)
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(places, c.c_nationkey == places.n_nationkey)
    gone = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice") * F.col("l_discount")).otherwise(F.col("l_extendedprice") * F.col("l_tax"))
    out = rollup.hierarchical_loss(j.withColumn("gone", gone), ["r_name", "n_name", "l_returnflag"], "l_extendedprice", "gone")
    return out.select("depth", "r_name", "n_name", "l_returnflag", *[r4(x).alias(x) for x in ("original", "removed", "remaining")], *[r6(x).alias(x) for x in ("weighted_pct", "mean_pct")])


def _trim_sql(rounds: int) -> str:
    parts = ["d0 as (select l_returnflag g, l_quantity x, l_extendedprice y from lineitem)"]
    for k in range(rounds):
        parts += [
            f"f{k} as (select g, (count(*) * sum(x * y) - sum(x) * sum(y)) / (count(*) * sum(x * x) - sum(x) * sum(x)) s, sum(x) sx, sum(y) sy, count(*) n from d{k} group by 1)",
            f"r{k} as (select d.g, x, y, y - s * x - (sy - s * sx) / n r from d{k} d join f{k} using (g))",
            f"m{k} as (select g, median(r) m from r{k} group by 1)",
            f"a{k} as (select r.g, x, y, abs(r - m) a from r{k} r join m{k} using (g))",
            f"l{k} as (select g, greatest(median(a) * (2.8::double * 1.4826::double), 1.5) lim from a{k} group by 1)",
            f"o{k} as (select a.g, x, y, a.a <= lim ok from a{k} a join l{k} using (g))",
            f"e{k} as (select g, count(*) filter (where ok) >= 8 en from o{k} group by 1)",
            f"d{k + 1} as (select o.g, x, y from o{k} o join e{k} using (g) where ok or not en)",
        ]
    return "with " + ",\n".join(parts) + f" select g as l_returnflag, count(*) as n, round_even((count(*) * sum(x * y) - sum(x) * sum(y)) / (count(*) * sum(x * x) - sum(x) * sum(x)), 4) as slope from d{rounds} group by 1"


@query(_trim_sql(3))
def q21_trimmed_line(spark, sf_dir):
    """A11, I5"""
    li = table(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice")
    return fits.trimmed_line_fit(li, ["l_returnflag"], "l_quantity", "l_extendedprice", rounds=3).select("l_returnflag", "n", r4("slope").alias("slope"))


def emb(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(4)])


EMB = "e as (select vec_id, label, embedding[1]::double e0, embedding[2]::double e1, embedding[3]::double e2, embedding[4]::double e3 from embeddings)"


@query(f"""
with {EMB}, m as (select label, avg(e0) mx, avg(e1) my from e group by 1), c as (select label, mx, my, e0 - mx u, e1 - my v from e join m using (label)),
s as (select label, any_value(mx) mx, any_value(my) my, count(*) n, sum(u*u) uu, sum(u*v) uv, sum(v*v) vv, sum(u*(u*u+v*v)) uz, sum(v*(u*u+v*v)) vz, sum(u*u+v*v) z from c group by 1),
t as (select *, (uz*vv - vz*uv) / (uu*vv - uv*uv) / 2 a, (uu*vz - uv*uz) / (uu*vv - uv*uv) / 2 b from s)
select label, n, round_even(mx + a, 6) as xc, round_even(my + b, 6) as yc, round_even(sqrt(a*a + b*b + z / n), 6) as radius from t""")
def q22_circle_fit(spark, sf_dir):
    """A10"""
    return fits.circle_fit(emb(spark, sf_dir), ["label"], "e0", "e1").select("label", "n", *[r6(c).alias(c) for c in ("xc", "yc", "radius")])


@query(f"""
with {EMB}, m as (select label, avg(e0) mx, avg(e1) my, avg(e2) mu, avg(e3) mv from e group by 1), c as (select label, e0 - mx x, e1 - my y, e2 - mu u, e3 - mv v from e join m using (label)),
s as (select label, count(*) n, sum(x*u + y*v) d, sum(x*v - y*u) k, sum(x*x + y*y) ss, sum(u*u + v*v) tt from c group by 1)
select label, n, round_even(sqrt(d*d + k*k) / ss, 6) as scale, round_even(atan2(k, d), 6) as angle, round_even(sqrt(greatest(tt - (d*d + k*k) / ss, 0) / n), 6) as rmsd from s""")
def q23_similarity_fit(spark, sf_dir):
    """A13"""
    return fits.similarity_fit(emb(spark, sf_dir), ["label"], "e0", "e1", "e2", "e3").select("label", "n", *[r6(c).alias(c) for c in ("scale", "angle", "rmsd")])


@query(f"""
with {EMB}, s as (select label, count(*) n, covar_pop(e0, e0) xx, covar_pop(e0, e1) xy, covar_pop(e1, e1) yy, covar_pop(e0, e2) xu, covar_pop(e1, e2) yu, covar_pop(e0, e3) xv, covar_pop(e1, e3) yv from e group by 1)
select label, n, round_even((xu*yy - yu*xy) / (xx*yy - xy*xy), 6) as a, round_even((xx*yu - xy*xu) / (xx*yy - xy*xy), 6) as b, round_even((xv*yy - yv*xy) / (xx*yy - xy*xy), 6) as d, round_even((xx*yv - xy*xv) / (xx*yy - xy*xy), 6) as e from s""")
def q24_affine_fit(spark, sf_dir):
    """A12"""
    return fits.affine_fit(emb(spark, sf_dir), ["label"], "e0", "e1", "e2", "e3").select("label", "n", *[r6(c).alias(c) for c in ("a", "b", "d", "e")])


@query(f"""
with {EMB}, s as (select label, count(*) n, degrees(0.5::double * atan2(2 * covar_samp(e0, e1), var_samp(e0) - var_samp(e1))) + 180 o from e group by 1)
select label, n, round_even(o - 180 * floor(o / 180), 6) as orientation_deg from s""")
def q25_pca_orientation(spark, sf_dir):
    """A15"""
    return fits.pca_orientation(emb(spark, sf_dir), ["label"], "e0", "e1").select("label", "n", r6("orientation_deg").alias("orientation_deg"))


BOUND = "b as (select distinct on (element_index) element_index, layer, datatype, points from boundaries order by element_index)"


def bound(spark, sf_dir):
    return table(spark, sf_dir, "boundaries", "element_index", "layer", "datatype", "points").dropDuplicates(["element_index"])


@query(f"""
with {BOUND}, s as (select element_index, layer, points p, len(points) n from b),
a as (select element_index, layer, case when n >= 3 then list_sum(list_transform(range(1, n + 1), lambda i: p[i].x::double * p[i % n + 1].y::double - p[i].y::double * p[i % n + 1].x::double)) / 2 else 0 end a, n,
 list_min(list_transform(p, lambda q: q.x)) x0, list_max(list_transform(p, lambda q: q.x)) x1, list_min(list_transform(p, lambda q: q.y)) y0, list_max(list_transform(p, lambda q: q.y)) y1 from s where p is not null)
select layer, count(*) as polygons, round_even(sum(abs(a)), 2) as area, count(*) filter (where n < 3 or abs(a) < 1e-9) as degenerate,
 count(*) filter (where abs(a) >= 1e-9 and abs(a) / ((x1 - x0)::double * (y1 - y0)) >= 0.97) as rectangles from a group by 1""")
def q26_polygon_area(spark, sf_dir):
    """A16, P8, P10"""
    b = bound(spark, sf_dir).filter("points is not null")
    p = F.col("points")
    d = b.select("layer", geometry.signed_area(p).alias("a"), geometry.is_degenerate(p).alias("deg"), geometry.rectangularity(p).alias("q"))
    return d.groupBy("layer").agg(F.count("*").alias("polygons"), F.bround(F.sum(F.abs("a")), 2).alias("area"), F.count_if("deg").alias("degenerate"), F.count_if((F.abs("a") >= 1e-9) & (F.col("q") >= 0.97)).alias("rectangles"))


@query("""
with p as (select cell_row, cell_col, [{'x': bbox_um.x0, 'y': bbox_um.y0}, {'x': bbox_um.x1, 'y': bbox_um.y0}, {'x': center_um.x, 'y': bbox_um.y1}] t, bbox_um.x0 x0, bbox_um.x1 x1, bbox_um.y0 y0, bbox_um.y1 y1, center_um.x cx from cells),
q as (select component_id, cell_row, cell_col, bbox_um.x0 + (component_id % 97) * (bbox_um.x1 - bbox_um.x0) / 96 x, bbox_um.y0 + (component_id % 89) * (bbox_um.y1 - bbox_um.y0) / 88 y from """ + DEDUPED + """ join cells using (cell_row, cell_col))
select cell_row, cell_col, count(*) as points, count(*) filter (where (x1 - x0) * (y - y0) >= -1e-9 and (cx - x1) * (y - y0) - (y1 - y0) * (x - x1) >= -1e-9 and (x0 - cx) * (y - y1) - (y0 - y1) * (x - cx) >= -1e-9) as inside
from q join p using (cell_row, cell_col) group by 1, 2""")
def q27_point_in_polygon(spark, sf_dir):
    """A triangle in each cell, tested with the crossing number."""
    cells = table(spark, sf_dir, "cells", "cell_row", "cell_col", "bbox_um", "center_um")
    pt = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    j = components(spark, sf_dir, "cell_row", "cell_col").join(cells, ["cell_row", "cell_col"])
    x = F.col("bbox_um.x0") + (F.col("component_id") % 97) * (F.col("bbox_um.x1") - F.col("bbox_um.x0")) / 96
    y = F.col("bbox_um.y0") + (F.col("component_id") % 89) * (F.col("bbox_um.y1") - F.col("bbox_um.y0")) / 88
    tri = F.array(pt("bbox_um.x0", "bbox_um.y0"), pt("bbox_um.x1", "bbox_um.y0"), pt("center_um.x", "bbox_um.y1"))
    return j.groupBy("cell_row", "cell_col").agg(F.count("*").alias("points"), F.count_if(geometry.contains(tri, x, y)).alias("inside"))


@query("""
with r as (select strftime(ts, '%Y-%m-%d') d, event_type, event_id, value, row_number() over (partition by strftime(ts, '%Y-%m-%d'), event_type order by value desc, event_id) k from events)
select d, event_type, event_id, k::int as rank_no from r where k <= 3""")
def q28_stratified_topk(spark, sf_dir):
    """The native part, best of each tile"""
    e = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value").withColumn("d", F.date_format("ts", "yyyy-MM-dd"))
    w = Window.partitionBy("d", "event_type").orderBy(F.col("value").desc(), "event_id")
    return rollup.capped(e, ["d", "event_type"], [F.col("value").desc(), F.col("event_id")], 3).withColumn("rank_no", F.row_number().over(w)).select("d", "event_type", "event_id", "rank_no")


@query("""
with h as (select o_orderpriority k, least(greatest(floor((o_totalprice - 0) / (500000.0::double / 256)), 0), 255)::int b, count(*) n from orders group by 1, 2),
c as (select *, sum(n) over w w0, sum(n * b) over w s0, sum(n) over (partition by k) wt, sum(n * b) over (partition by k) st from h window w as (partition by k order by b rows unbounded preceding)),
v as (select k, b, round_even(case when wt > w0 then w0::double * (wt - w0) * (s0::double / w0 - (st - s0)::double / (wt - w0)) * (s0::double / w0 - (st - s0)::double / (wt - w0)) else -1 end, 6) v from c),
r as (select *, row_number() over (partition by k order by v desc, b) i from v)
select k as o_orderpriority, b as threshold_bin from r where i = 1""")
def q29_otsu_threshold(spark, sf_dir):
    """A22"""
    return rollup.otsu_threshold(table(spark, sf_dir, "orders", "o_orderpriority", "o_totalprice"), ["o_orderpriority"], "o_totalprice", 0.0, 500000.0)


@query("""
with b as (select distinct on (record_id) record_id, wafer_id, scan_no, cell_row, cell_col, recorded_at from cell_records where wafer_id is not null),
u as (select wafer_id, cell_row, cell_col, scan_no, record_id, 0 f, recorded_at from b where scan_no = 1 union all select wafer_id, cell_row, cell_col, scan_no, record_id, 1, recorded_at from b where scan_no > 1),
r as (select *, row_number() over (partition by wafer_id, cell_row, cell_col order by f desc, recorded_at desc, record_id) k from u)
select wafer_id, cell_row, cell_col, scan_no, record_id from r where k = 1""")
def q30_upsert(spark, sf_dir):
    """Later scans replace the cells of the first"""
    c = table(spark, sf_dir, "cell_records", "record_id", "wafer_id", "scan_no", "cell_row", "cell_col", "recorded_at").filter("wafer_id is not null").dropDuplicates(["record_id"])
    return joins.latest_upsert(c.filter("scan_no = 1"), c.filter("scan_no > 1"), ["wafer_id", "cell_row", "cell_col"], [F.col("recorded_at").desc(), F.col("record_id")]).select("wafer_id", "cell_row", "cell_col", "scan_no", "record_id")


@query("""
with k as (select round_even(p_retailprice, -1) k, p_partkey from part) select min(p_partkey) as first_key, max(p_partkey) as last_key from k group by k""")
def q31_rounded_dedupe(spark, sf_dir):
    """Cells keep the last row of a rounded key, markers the first"""
    p = table(spark, sf_dir, "part", "p_partkey", "p_retailprice")
    first = joins.dedupe_rounded(p, ["p_retailprice"], -1, ["p_partkey"], "first").select(F.bround("p_retailprice", -1).alias("k"), F.col("p_partkey").alias("first_key"))
    last = joins.dedupe_rounded(p, ["p_retailprice"], -1, ["p_partkey"], "last").select(F.bround("p_retailprice", -1).alias("k"), F.col("p_partkey").alias("last_key"))
    return first.join(last, "k").select("first_key", "last_key")


@query("""select event_type, (props::json->>'k')::int as k, count(*) as n, round_even(sum(value), 4) as v from events group by 1, 2""")
def q32_json_extract(spark, sf_dir):
    """S12, F8"""
    e = table(spark, sf_dir, "events", "event_type", "props", "value")
    return e.groupBy("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"), r4(F.sum("value")).alias("v"))


@query(r"""
with s as (select distinct on (record_id) record_id, trim(cell_stem) s from cell_records),
m as (select nullif(regexp_extract(s, '^(.*?)(?:^|_)cell_(\d+)-(\d+)$', 1), '') w, regexp_extract(s, '^(.*?)(?:^|_)cell_(\d+)-(\d+)$', 2) r, regexp_extract(s, '^(.*?)(?:^|_)cell_(\d+)-(\d+)$', 3) c from s where s is not null)
select w as wafer, nullif(r, '')::int as cell_row, nullif(c, '')::int as cell_col, count(*) as n from m group by 1, 2, 3""")
def q33_regex_device(spark, sf_dir):
    """F2, P14, S3"""
    c = table(spark, sf_dir, "cell_records", "record_id", "cell_stem").filter("cell_stem is not null").dropDuplicates(["record_id"])
    w, row, col = strings.cell_of(F.concat(F.trim("cell_stem"), F.lit(".x")))
    return c.groupBy(w.alias("wafer"), row.alias("cell_row"), col.alias("cell_col")).agg(F.count("*").alias("n"))


@query("""
with e as (select distinct on (entry_id) entry_id, defects from device_entries), d as (select unnest(defects) d from e)
select case when contains(lower(coalesce(d.source, '')), 'manual') then 'manual' when contains(lower(coalesce(d.source, '')), 'algorithmic') or contains(lower(coalesce(d.source, '')), 'automatic') or contains(lower(coalesce(d.source, '')), 'detector') then 'automatic' else 'manual' end as kind,
 d.defect_type as defect_type, count(*) as n, round_even(avg(d.area_px), 6) as mean_area from d where d is not null group by 1, 2""")
def q34_source_kind(spark, sf_dir):
    """F12"""
    e = table(spark, sf_dir, "device_entries", "entry_id", "defects").select("entry_id", F.transform("defects", lambda d: F.struct(d["source"].alias("source"), d["defect_type"].alias("defect_type"), d["area_px"].alias("area_px"), d.isNull().alias("gone"))).alias("defects")).dropDuplicates(["entry_id"])
    d = e.select(F.explode("defects").alias("d")).filter("not d.gone")
    return d.groupBy(strings.source_kind(F.col("d.source")).alias("kind"), F.col("d.defect_type").alias("defect_type")).agg(F.count("*").alias("n"), r6(F.avg("d.area_px")).alias("mean_area"))


@query(f"""
with c as (select * from {DEDUPED}), r as (select list_filter([case when area_px is null or area_px < 18 then 'small' end, case when score is null or isnan(score) or score < 8.8 then 'weak' end,
 case when bbox_px is null or len(bbox_px) < 4 then 'no_box' when bbox_px[3] > 6 * bbox_px[4] or bbox_px[4] > 6 * bbox_px[3] then 'line' end, case when seam_overlap_frac > 0.5 then 'seam' end], lambda x: x is not null) l from c)
select array_to_string(l, '+') as reasons, count(*) as n from r group by 1""")
def q35_rejection_reasons(spark, sf_dir):
    """P3, P7, P13"""
    c = components(spark, sf_dir, "area_px", "score", "bbox_px", "seam_overlap_frac")
    w, h = F.get("bbox_px", F.lit(2)), F.get("bbox_px", F.lit(3))
    no_box = F.col("bbox_px").isNull() | (F.size("bbox_px") < 4)
    l_ = rollup.reasons(("small", F.col("area_px").isNull() | (F.col("area_px") < 18)), ("weak", F.col("score").isNull() | F.isnan("score") | (F.col("score") < 8.8)), ("no_box", no_box), ("line", ~no_box & ((w > 6 * h) | (h > 6 * w))), ("seam", F.col("seam_overlap_frac") > 0.5))
    return c.groupBy(F.concat_ws("+", l_).alias("reasons")).agg(F.count("*").alias("n"))


@query("""
with e as (select distinct on (entry_id) entry_id, image_w, image_h, gds_w_um, gds_h_um from device_entries),
s as (select entry_id, case when image_w > 0 and gds_w_um > 0 then gds_w_um / image_w else 1 end sx, case when image_h > 0 and gds_h_um > 0 then gds_h_um / image_h else 1 end sy from e)
select entry_id, round_even(sqrt((2 * sx) * (2 * sx) + (2 * sy) * (2 * sy)) + 45000 * sin(radians(0.001::double)) + 0.5::double, 6) as margin from s""")
def q36_margin(spark, sf_dir):
    """A21"""
    e = table(spark, sf_dir, "device_entries", "entry_id", "image_w", "image_h", "gds_w_um", "gds_h_um").dropDuplicates(["entry_id"])
    sx, sy = geometry.um_per_px(F.col("gds_w_um"), F.col("gds_h_um"), F.col("image_w"), F.col("image_h"))
    return e.select("entry_id", r6(geometry.alignment_margin(F.lit(2.0), F.lit(2.0), sx, sy, F.lit(45000.0), F.lit(0.001), F.lit(0.5))).alias("margin"))


@query("""
with e as (select distinct on (entry_id) entry_id, wafer_id, cell_row, cell_col, coalesce(len(defects), 0) n from device_entries)
select cell_row, cell_col, count(*) as crops, sum(n)::bigint as defects, count(distinct case when n > 0 then wafer_id end) as wafers_with_defects from e group by 1, 2""")
def q37_device_grid(spark, sf_dir):
    """A6, A26"""
    e = table(spark, sf_dir, "device_entries", "entry_id", "wafer_id", "cell_row", "cell_col", "defects").dropDuplicates(["entry_id"])
    return rollup.device_grid(e)[0]


@query()
def q38_overlap_suppression(spark, sf_dir):
    """Boxes of a crop, duplicates of better ones dropped. Tested against brute force."""
    b = boxes(spark, sf_dir).filter("score is not null and not isnan(score)").withColumn("area", F.col("area_px").cast("double"))
    return greedy.suppress_duplicates(b, ["wafer_id", "scan_no", "cell_row", "cell_col"], "score", "area", "component_id").select("component_id")


@query()
def q39_nms_peaks(spark, sf_dir):
    """Tile-wise best peaks of a crop, then suppression over the crop. Tested against brute force."""
    b = boxes(spark, sf_dir).filter("score is not null and not isnan(score)").select("component_id", "wafer_id", "scan_no", "cell_row", "cell_col", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"), "score")
    return greedy.stratified_peaks(b, ["wafer_id", "scan_no", "cell_row", "cell_col"], "x", "y", "score", "component_id", 512.0, 12, 24.0, 400).select("component_id")


@query()
def q40_greedy_matching(spark, sf_dir):
    """Components of consecutive scans of one crop, matched one to one within 25 px. Tested against brute force."""
    b = boxes(spark, sf_dir).select("component_id", "wafer_id", "scan_no", "cell_row", "cell_col", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    left = b.withColumnRenamed("component_id", "left_id")
    right = b.withColumn("scan_no", F.col("scan_no") - 1).withColumnRenamed("component_id", "right_id")
    return greedy.greedy_match(left, right, ["wafer_id", "scan_no", "cell_row", "cell_col"], "left_id", "right_id", 25.0).select("left_id", "right_id", r6("distance").alias("distance"))


@query("""select count(*) as points, 0::bigint as off from """ + DEDUPED)
def q41_frame_round_trip(spark, sf_dir):
    """canvas to design and back"""
    f = geometry.WaferFrame(xc=20000.0, yc=18000.0, angle=0.021, sx=2.8, sy=2.81, shear=0.0004, ox=3.0, oy=-5.0, gds_xc=10.0, gds_yc=20.0)
    c = components(spark, sf_dir).select((F.col("component_id") % 40000).cast("double").alias("x"), (F.col("component_id") % 36007).cast("double").alias("y"))
    gx, gy = f.to_gds(F.col("x"), F.col("y"))
    bx, by = f.to_canvas(gx, gy)
    return c.agg(F.count("*").alias("points"), F.count_if((F.abs(bx - F.col("x")) > 1e-6) | (F.abs(by - F.col("y")) > 1e-6)).alias("off"))


@query("""
with g as (select event_type, user_id, ts, case when epoch_us(ts) - lag(epoch_us(ts)) over (partition by event_type, user_id order by ts) >= 3600000000 then 1 else 0 end f from events),
s as (select event_type, user_id, ts, sum(f) over (partition by event_type, user_id order by ts rows unbounded preceding) k from g)
select event_type, user_id, epoch_us(min(ts)) as start_us, epoch_us(max(ts)) as last_us, count(*) as n from s group by event_type, user_id, k""")
def q42_sessions(spark, sf_dir):
    """The batch form of the streaming extension: session windows of an hour"""
    e = table(spark, sf_dir, "events", "event_type", "user_id", "ts")
    s = e.groupBy("event_type", "user_id", F.session_window("ts", "1 hour").alias("w")).agg(F.max("ts").alias("last"), F.count("*").alias("n"))
    return s.select("event_type", "user_id", F.unix_micros("w.start").alias("start_us"), F.unix_micros("last").alias("last_us"), "n")


@query("""
select source_kind, case when lower(trim(source_group)) in ('', 'none', 'null', 'nan', 'n/a') then null else source_group end as source_group, count(*) as n,
 count(*) filter (where before_folder is null or lower(trim(before_folder)) in ('', 'none', 'null', 'nan', 'n/a')) as without_before from wafers group by 1, 2""")
def q43_wafer_counts(spark, sf_dir):
    """Spellings of no value"""
    w = table(spark, sf_dir, "wafers", "source_kind", "source_group", "before_folder")
    return w.groupBy("source_kind", strings.no_value(F.col("source_group")).alias("source_group")).agg(F.count("*").alias("n"), F.count_if(strings.no_value(F.col("before_folder")).isNull()).alias("without_before"))


@query("""
with d as (select wafer_id, 0 p from (select distinct wafer_id from cell_records where wafer_id is not null) union all select wafer_id, 1 from wafers),
r as (select *, row_number() over (partition by lower(wafer_id) order by p, wafer_id) k from d)
select wafer_id from r where k = 1""")
def q44_declared_or_found(spark, sf_dir):
    """J17"""
    found = table(spark, sf_dir, "cell_records", "wafer_id").filter("wafer_id is not null").distinct()
    return joins.union_first([found, table(spark, sf_dir, "wafers", "wafer_id")], F.lower("wafer_id"), ["wafer_id"]).select("wafer_id")


@query("""
with t as (select distinct cell_row r, cell_col c from cells)
select a.r as cell_row, a.c as cell_col, l.c is not null as has_left, x.c is not null as has_right, u.r is not null as has_top, d.r is not null as has_bottom
from t a left join t l on l.r = a.r and l.c = a.c - 1 left join t x on x.r = a.r and x.c = a.c + 1 left join t u on u.c = a.c and u.r = a.r - 1 left join t d on d.c = a.c and d.r = a.r + 1""")
def q45_neighbour_tiles(spark, sf_dir):
    """J16"""
    return joins.neighbour_flags(table(spark, sf_dir, "cells", "cell_row", "cell_col"), [], "cell_col", "cell_row")


@query("""
with v as (select distinct layer, list_min(list_transform(points, lambda p: p.x)) x from boundaries where layer is not null and len(points) > 0), g as (select layer, x, x - lag(x) over (partition by layer order by x) d from v)
select layer, median(case when d > 0 then d end)::double as pitch, count(*) as distinct_values from g group by 1""")
def q46_gap_pitch(spark, sf_dir):
    """A5"""
    b = table(spark, sf_dir, "boundaries", "layer", "points").filter("layer is not null and size(points) > 0").select("layer", F.array_min(F.transform("points", lambda p: p["x"])).alias("x"))
    return robust.gap_pitch(b, ["layer"], "x").withColumn("pitch", F.col("pitch").cast("double"))


@query("""
with c as (select cell_row * 0 as k, cell_row, cell_col, center_um.x x, center_um.y y from cells),
r as (select *, dense_rank() over (order by y desc) nr from c), s as (select *, row_number() over (partition by nr order by x) nc from r)
select cell_row, cell_col, nr::int as row_no, nc::int as col_no from s""")
def q47_cell_numbering(spark, sf_dir):
    """Rows numbered from the top, columns from the left"""
    c = table(spark, sf_dir, "cells").select(F.lit(0).alias("k"), F.col("cell_row").alias("r0"), F.col("cell_col").alias("c0"), F.col("center_um.x").alias("x"), F.col("center_um.y").alias("y"))
    return sequence.number_cells(c, ["k"], "y", "x").select(F.col("r0").alias("cell_row"), F.col("c0").alias("cell_col"), F.col("cell_row").alias("row_no"), F.col("cell_col").alias("col_no"))


@query("""
with w as (select wafer_id, row_number() over (order by lower(wafer_id), wafer_id) - 1 i, count(*) over () n from wafers)
select a.wafer_id, b.wafer_id as target from w a join w b on b.i = (a.i + 1) % a.n""")
def q48_circular_step(spark, sf_dir):
    """W21"""
    w = table(spark, sf_dir, "wafers", "wafer_id").select(F.lit(0).alias("s"), "wafer_id", F.lower("wafer_id").alias("k"))
    return sequence.circular_step(w, ["s"], ["k", "wafer_id"], "wafer_id", 1).select("wafer_id", "target")


@query("""
with v as (select l_returnflag, l_extendedprice v, row_number() over (partition by l_returnflag order by l_extendedprice) k, count(*) over (partition by l_returnflag) n from lineitem)
select l_returnflag, n, v as value from v where k = greatest(ceil(n * 0.9::double), 1)""")
def q49_quantile_by_bisection(spark, sf_dir):
    """A3: exact ranks of groups of any size"""
    return robust.quantiles_by_bisection(table(spark, sf_dir, "lineitem", "l_returnflag", "l_extendedprice"), "l_returnflag", "l_extendedprice", 0.9, small=256)


@query("""
with v as (select wafer_id w, doc_id, n_chars, lag(n_chars) over (partition by wafer_id order by doc_id) p, row_number() over (partition by wafer_id order by doc_id) k from documents where wafer_id is not null)
select w as wafer_id, count(*) as runs from v where k = 1 or n_chars is distinct from p group by 1""")
def q50_consecutive_duplicates(spark, sf_dir):
    """W18"""
    d = table(spark, sf_dir, "documents", "wafer_id", "doc_id", "n_chars").filter("wafer_id is not null")
    return sequence.drop_consecutive_duplicates(d, ["wafer_id"], "doc_id", ["n_chars"]).groupBy("wafer_id").agg(F.count("*").alias("runs"))


@query(f"""
with c as (select distinct on (record_id) record_id, cell_stem, annotation_name from cell_records),
e as (select distinct on (entry_id) entry_id, image_path from device_entries),
a as (select distinct record_id, k from (select record_id, {STEM.format("cell_stem")} k from c union all select record_id, {STEM.format("annotation_name")} from c) where k is not null),
j as (select distinct record_id, entry_id from a join (select entry_id, {STEM.format("image_path")} k from e where image_path is not null) using (k))
select record_id, count(*) as entries from j group by 1""")
def q58_alias_sets(spark, sf_dir):
    """J3"""
    c = table(spark, sf_dir, "cell_records", "record_id", "cell_stem", "annotation_name").dropDuplicates(["record_id"])
    e = table(spark, sf_dir, "device_entries", "entry_id", "image_path").filter("image_path is not null").dropDuplicates(["entry_id"])
    j = joins.join_on_aliases(c, "record_id", [strings.device_key(F.col(x)) for x in ("cell_stem", "annotation_name")], e, "entry_id", strings.device_key(F.col("image_path")))
    return j.groupBy("record_id").agg(F.count("*").alias("entries"))


@query(f"""
with v as (select component_id, wafer_id, score from {DEDUPED} where wafer_id is not null and score is not null and not isnan(score)),
m as (select wafer_id, count(*) n, median(score) c from v group by 1),
d as (select wafer_id, any_value(n) n, any_value(c) c, greatest(1.4826 * median(abs(score - c)), 1e-9) s from v join m using (wafer_id) group by 1)
select wafer_id, count(*) as components, count(*) filter (where n >= 8 and (score - c) / s > 3) as outliers from v join d using (wafer_id) group by 1""")
def q59_guarded_outliers(spark, sf_dir):
    """W10, A2"""
    c = components(spark, sf_dir, "wafer_id", "score").filter("wafer_id is not null and score is not null and not isnan(score)")
    z = sequence.guarded_z(c, ["wafer_id"], "score", 8)
    return z.groupBy("wafer_id").agg(F.count("*").alias("components"), F.count_if(F.col("z") > 3).alias("outliers"))


@query("""
with e as (select distinct on (entry_id) entry_id, wafer_id, cell_row, cell_col, scan_no, defects from device_entries),
a as (select lower(trim(concat(wafer_id, '_', scan_no, '_', cell_row, '-', cell_col))) k, len(arg_max(case when defects is null then [] else defects end, entry_id)) n from e where wafer_id is not null and scan_no is not null and cell_row is not null and cell_col is not null group by 1),
c as (select distinct on (record_id) record_id, wafer_id, cell_row, cell_col, lower(trim(concat(wafer_id, '_', scan_no, '_', cell_row, '-', cell_col))) k, (wafer_id is null or scan_no is null or cell_row is null or cell_col is null) lost from cell_records),
j as (select record_id, wafer_id, cell_row, cell_col, coalesce(a.n, 0) n from c left join a on a.k = c.k and not lost)
select record_id, wafer_id, (row_number() over (partition by wafer_id order by cell_row nulls last, cell_col nulls last, record_id))::int as place, n::int as defects from j""")
def q60_device_catalogue(spark, sf_dir):
    """Crops with the number of their annotated defects, in device order within each wafer"""
    key = F.concat("wafer_id", F.lit("_"), "scan_no", F.lit("_"), "cell_row", F.lit("-"), "cell_col").alias("key")
    images = table(spark, sf_dir, "cell_records", "record_id", "wafer_id", "scan_no", "cell_row", "cell_col").dropDuplicates(["record_id"]).select("record_id", "wafer_id", "cell_row", "cell_col", key)
    notes = table(spark, sf_dir, "device_entries", "entry_id", "wafer_id", "scan_no", "cell_row", "cell_col", "defects").dropDuplicates(["entry_id"]).select("entry_id", key, F.coalesce(F.transform("defects", lambda d: d["defect_type"]), F.array().cast("array<string>")).alias("defects"))
    j = catalogue.with_annotations(images, "key", notes, "defects", "entry_id")
    w = Window.partitionBy("wafer_id").orderBy(*catalogue.device_order(key="record_id"))
    return j.select("record_id", "wafer_id", F.row_number().over(w).alias("place"), F.size("defects").alias("defects"))


@query("""
with w as (select wafer_id, row_number() over (order by registered_at nulls last, wafer_id) - 1 p from (select distinct on (wafer_id) wafer_id, registered_at from wafers where wafer_id is not null order by wafer_id, registered_at nulls last)),
d as (select lower(trim(wafer_id)) n, min(p) p from w where p < 20 group by 1)
select c.wafer_id, d.p::int as position, count(*) as crops from (select distinct on (record_id) record_id, wafer_id from cell_records where wafer_id is not null) c left join d on d.n = lower(trim(c.wafer_id)) group by 1, 2""")
def q61_declared_order(spark, sf_dir):
    """O3: crops per wafer, with the wafer's place in a declared list (the first twenty that were registered)"""
    once = table(spark, sf_dir, "wafers", "wafer_id", "registered_at").filter("wafer_id is not null").groupBy("wafer_id").agg(F.min("registered_at").alias("r"))
    declared = [r[0] for r in once.orderBy(F.col("r").asc_nulls_last(), "wafer_id").limit(20).collect()]
    c = table(spark, sf_dir, "cell_records", "record_id", "wafer_id").filter("wafer_id is not null").dropDuplicates(["record_id"])
    return catalogue.in_declared_order(c, "wafer_id", declared).groupBy("wafer_id", "position").agg(F.count("*").alias("crops"))


@query("""
select lower(trim(wafer_id)) as wafer, count(*) as files, sum(size_bytes)::bigint as bytes,
 case when sum(size_bytes) is null then '--:--' when sum(size_bytes) // 1000000 < 3600 then concat(sum(size_bytes) // 1000000 // 60, ':', lpad((sum(size_bytes) // 1000000 % 60)::varchar, 2, '0'))
 else concat(sum(size_bytes) // 1000000 // 3600, ':', lpad((sum(size_bytes) // 1000000 // 60 % 60)::varchar, 2, '0'), ':', lpad((sum(size_bytes) // 1000000 % 60)::varchar, 2, '0')) end as eta
from (select distinct on (file_id) * from crop_files) where wafer_id is not null group by 1""")
def q62_formatted_time(spark, sf_dir):
    """time to copy each wafer's files at a megabyte a second"""
    f = table(spark, sf_dir, "crop_files", "file_id", "wafer_id", "size_bytes").filter("wafer_id is not null").dropDuplicates(["file_id"])
    g = f.groupBy(F.lower(F.trim("wafer_id")).alias("wafer")).agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"))
    return g.withColumn("eta", strings.minutes_text(F.floor(F.col("bytes") / 1000000)))


@query("""
with o as (select distinct on (element_index) element_index, layer, list_filter(points, lambda p: p is not null) p from boundaries where layer is not null and len(points) >= 3 order by element_index),
x as (select element_index, layer, list_max(list_transform(p, lambda q: q.x)) - list_min(list_transform(p, lambda q: q.x)) w, list_max(list_transform(p, lambda q: q.y)) - list_min(list_transform(p, lambda q: q.y)) h from o where len(p) > 0),
m as (select layer, median(w) u from x group by 1)
select layer, case when w < 1.5 * u and h > w then 'finger' else 'border' end as kind, count(*) as boundaries from x join m using (layer) group by 1, 2""")
def q63_fingers_and_borders(spark, sf_dir):
    """P9"""
    b = table(spark, sf_dir, "boundaries", "element_index", "layer", "points").filter("layer is not null and size(points) >= 3").dropDuplicates(["element_index"])
    box = geometry.bounds(F.filter("points", lambda p: p.isNotNull()))
    d = b.withColumn("b", box).select("element_index", "layer", "b.x0", "b.y0", "b.x1", "b.y1").filter("x0 is not null")
    return fingers.finger_or_border(d, ["layer"]).groupBy("layer", "kind").agg(F.count("*").alias("boundaries"))
