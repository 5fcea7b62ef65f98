"""Registered serving and data-quality queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pricecube.constants import MART_TABLE, STG_TABLE
from pricecube.operators import annual, incremental, publish, quality, serving, versions
from pricecube.operators.staging import staging
from pricecube.plans import fixtures as fx
from pricecube.plans.oracle_sql import with_ctes
from pricecube.plans.registry import MART_COLS, mart, register, stg, stg_dirty
from pricecube.session import scratch_path

ORDER = "order by country_code, consumer_type, year"

# --- stored tables -------------------------------------------------------------


def stored(spark, sf_dir):
    """Staging and mart as files, the mart computed from the stored staging, for the
    report, whose sections read both several times."""
    root = scratch_path(spark, "stored")
    stg(spark, sf_dir).write.parquet(f"{root}/{STG_TABLE}")
    s = spark.read.parquet(f"{root}/{STG_TABLE}")
    annual.mart(s).write.parquet(f"{root}/{MART_TABLE}")
    return s, spark.read.parquet(f"{root}/{MART_TABLE}")


@register("mart_table", with_ctes("mart") + f"select {MART_COLS} from mart {ORDER}")
def q_mart_table(spark, sf_dir):
    """The mart as a managed catalog table, read back through the catalog."""
    name = f"pricecube_{uuid.uuid4().hex}.{MART_TABLE}"
    return serving.prices(publish.materialize_table(spark, mart(spark, sf_dir), name))


@register("stg_view", with_ctes("stg") + "select country_code, period, price_category, count(*) as n from stg group by all")
def q_stg_view(spark, sf_dir):
    """The staging model as a view, asked by name."""
    name = f"stg_{uuid.uuid4().hex}"
    publish.materialize_view(stg(spark, sf_dir), name)
    return spark.sql(f"select country_code, period, price_category, count(*) as n from {name} group by all")


#: Arguments of the price query, of which only exact consumer types are accepted.
_ASKED = ["household", "industry", "Household", "other", ""]


@register(
    "prices_argument",
    with_ctes("mart")
    + "\nunion all\n".join(
        f"select '{a}' as consumer_type, {a in ('household', 'industry', '')} as accepted,"
        f" count(*) filter (where {'true' if not a else 'consumer_type = ' + repr(a)}) as rows from mart"
        for a in _ASKED
    ),
)
def q_prices_argument(spark, sf_dir):
    """Each argument, whether the price query accepts it, and the rows it then gives; a
    rejected one gives none."""
    m, out = mart(spark, sf_dir), None
    for asked in _ASKED:
        try:
            rows, accepted = serving.prices_count(m, consumer_type=asked), True
        except ValueError:
            rows, accepted = m.limit(0).agg(F.count(F.lit(1)).alias("count")), False
        part = rows.select(F.lit(asked).alias("consumer_type"), F.lit(accepted).alias("accepted"), F.col("count").alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


# --- serving ------------------------------------------------------------------


@register(
    "prices_filtered",
    with_ctes("mart")
    + f"select {MART_COLS} from mart where country_code = upper('n03') and year = 1998"
    f" and consumer_type = 'household' {ORDER}",
)
def q_prices_filtered(spark, sf_dir):
    return serving.prices(mart(spark, sf_dir), country="n03", year=1998, consumer_type="household")


@register("prices_unfiltered", with_ctes("mart") + f"select {MART_COLS} from mart {ORDER}")
def q_prices_unfiltered(spark, sf_dir):
    return serving.prices(mart(spark, sf_dir), country="", year=0, consumer_type=None)


@register(
    "prices_count",
    with_ctes("mart") + "select count(*) as count from mart where year = 1998 and consumer_type = 'industry'",
)
def q_prices_count(spark, sf_dir):
    return serving.prices_count(mart(spark, sf_dir), year=1998, consumer_type="industry")


@register(
    "prices_summary",
    with_ctes("mart")
    + """select country_code, country_name, year, consumer_type, avg_price_eur_per_kwh, price_category_mode
from mart where year = (select max(year) from mart)
order by country_code, consumer_type""",
)
def q_prices_summary(spark, sf_dir):
    return serving.prices_summary(mart(spark, sf_dir))


@register(
    "prices_yoy",
    with_ctes("mart")
    + """select country_code, country_name, year, consumer_type, avg_price_eur_per_kwh,
       prior_year_avg_price, yoy_change_pct
from mart where yoy_change_pct is not null
order by yoy_change_pct desc, country_code, consumer_type, year""",
)
def q_prices_yoy(spark, sf_dir):
    return serving.prices_yoy(mart(spark, sf_dir))


@register(
    "prices_summary_count",
    with_ctes("mart") + "select max(year) as year, (select count(*) from mart m where m.year = (select max(year) from mart)) as count from mart",
)
def q_prices_summary_count(spark, sf_dir):
    return serving.prices_summary_count(mart(spark, sf_dir))


@register("prices_yoy_count", with_ctes("mart") + "select count(*) as count from mart where yoy_change_pct is not null")
def q_prices_yoy_count(spark, sf_dir):
    return serving.prices_yoy_count(mart(spark, sf_dir))


@register(
    "yoy_top",
    with_ctes("mart")
    + """select country_code, consumer_type, year, yoy_change_pct from mart
where yoy_change_pct is not null
order by yoy_change_pct desc, country_code, consumer_type, year limit 3""",
)
def q_yoy_top(spark, sf_dir):
    return serving.yoy_extremes(mart(spark, sf_dir), 3, increases=True)


@register(
    "yoy_bottom",
    with_ctes("mart")
    + """select country_code, consumer_type, year, yoy_change_pct from mart
where yoy_change_pct is not null
order by yoy_change_pct asc, country_code, consumer_type, year limit 3""",
)
def q_yoy_bottom(spark, sf_dir):
    return serving.yoy_extremes(mart(spark, sf_dir), 3, increases=False)


@register(
    "health",
    with_ctes("mart")
    + """select 'ok' as status, (select count(*) from stg) as stg_rows, (select count(*) from mart) as mart_rows,
       (select max(period) from stg) as latest_period""",
)
def q_health(spark, sf_dir):
    s = stg(spark, sf_dir)
    return serving.health(s, annual.mart(s))


@register(
    "latest_period",
    with_ctes("stg")
    + """select max(period) as latest_period, case when max(period) is null then 'WARN' else 'OK' end as status
from stg""",
)
def q_latest_period(spark, sf_dir):
    return serving.latest_period(stg(spark, sf_dir))


@register(
    "rows_per_country",
    with_ctes("mart")
    + "select country_code, country_name, count(*) as rows from mart group by country_code, country_name"
    " order by country_code",
)
def q_rows_per_country(spark, sf_dir):
    return serving.rows_per_country(mart(spark, sf_dir))


# --- data quality -------------------------------------------------------------


def _dirty(spark, sf_dir):
    s = stg_dirty(spark, sf_dir)
    return s, annual.mart(s)


@register(
    "dq_row_counts",
    with_ctes("mart")
    + f"""select '{STG_TABLE}' as table_name, count(*) as rows, case when count(*) = 0 then 'WARN' else 'OK' end as status
from stg
union all
select '{MART_TABLE}', count(*), case when count(*) = 0 then 'WARN' else 'OK' end from mart""",
)
def q_dq_row_counts(spark, sf_dir):
    s = stg(spark, sf_dir)
    return quality.row_counts(s, annual.mart(s))


def _null_sql(table: str, src: str, col: str) -> str:
    return (
        f"select '{table}' as table_name, '{col}' as column_name, count(*) filter (where {col} is null) as nulls"
        f" from {src}"
    )


def _null_counts_body(stg_src: str, mart_src: str) -> str:
    parts = [
        _null_sql(STG_TABLE if t == "stg" else MART_TABLE, stg_src if t == "stg" else mart_src, c)
        for t, c in quality.NULL_CHECKS
    ]
    return (
        "select *, case when nulls > 0 then 'FAIL' else 'OK' end as status from (\n"
        + "\nunion all\n".join(parts)
        + "\n) t"
    )


_NULL_COUNTS_SQL = with_ctes("mart_dirty") + _null_counts_body("stg_dirty", "mart_dirty")


@register("dq_null_counts", _NULL_COUNTS_SQL)
def q_dq_null_counts(spark, sf_dir):
    s, m = _dirty(spark, sf_dir)
    return quality.null_counts(s, m)


@register(
    "price_anomalies",
    with_ctes("mart")
    + """select country_code, consumer_type, year, avg_price_eur_per_kwh from mart
where avg_price_eur_per_kwh < 0.20 or avg_price_eur_per_kwh > 0.30
order by country_code, consumer_type, year""",
)
def q_price_anomalies(spark, sf_dir):
    return quality.price_anomalies(mart(spark, sf_dir), 0.20, 0.30)


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _rule_sql(table: str, src: str, rule: quality.Rule) -> str:
    if rule.test == "not_null":
        cond = f"{rule.column} is null"
    elif rule.test == "accepted_values":
        cond = f"{rule.column} is not null and {rule.column} not in ({_in_list(rule.values)})"
    else:
        return (
            f"select '{table}' as table_name, 'unique' as test, '{rule.column}' as column_name,"
            f" (select count(*) from (select {rule.column} from {src} where {rule.column} is not null"
            f" group by {rule.column} having count(*) > 1)) as failures"
        )
    return (
        f"select '{table}' as table_name, '{rule.test}' as test, '{rule.column}' as column_name,"
        f" count(*) filter (where {cond}) as failures from {src}"
    )


def _suite_sql(parts, src_ctes) -> str:
    body = "\nunion all\n".join(_rule_sql(t, s, r) for t, s, r in parts)
    return (
        with_ctes(*src_ctes)
        + "select *, case when failures > 0 then 'FAIL' else 'PASS' end as status from (\n"
        + body
        + "\n) t"
    )


def _suite_parts(test: str | None):
    parts = [(STG_TABLE, "stg_dirty", r) for r in quality.STG_RULES] + [
        (MART_TABLE, "mart_dirty", r) for r in quality.MART_RULES
    ]
    return [p for p in parts if test is None or p[2].test == test]


def _suite(spark, sf_dir, test: str | None):
    s, m = _dirty(spark, sf_dir)
    stg_rules = [r for r in quality.STG_RULES if test is None or r.test == test]
    mart_rules = [r for r in quality.MART_RULES if test is None or r.test == test]
    return quality.suite([(STG_TABLE, s, stg_rules), (MART_TABLE, m, mart_rules)])


@register("dq_not_null", _suite_sql(_suite_parts("not_null"), ["mart_dirty"]))
def q_dq_not_null(spark, sf_dir):
    return _suite(spark, sf_dir, "not_null")


@register("dq_accepted_values", _suite_sql(_suite_parts("accepted_values"), ["mart_dirty"]))
def q_dq_accepted_values(spark, sf_dir):
    return _suite(spark, sf_dir, "accepted_values")


@register("dq_suite", _suite_sql(_suite_parts(None), ["mart_dirty"]))
def q_dq_suite(spark, sf_dir):
    return _suite(spark, sf_dir, None)


_GRAIN_SQL = "concat_ws('|', country_code, consumer_type, cast(year as varchar))"


@register(
    "dq_unique",
    with_ctes("mart_dirty")
    + ", mart_keyed as (select *, "
    + _GRAIN_SQL
    + " as grain from mart_dirty)\n"
    + "select *, case when failures > 0 then 'FAIL' else 'PASS' end as status from (\n"
    + _rule_sql(MART_TABLE, "mart_keyed", quality.unique("grain"))
    + "\nunion all\n"
    + _rule_sql(STG_TABLE, "stg_dirty", quality.unique("period"))
    + "\n) t",
)
def q_dq_unique(spark, sf_dir):
    s, m = _dirty(spark, sf_dir)
    keyed = m.withColumn("grain", F.concat_ws("|", "country_code", "consumer_type", F.col("year").cast("string")))
    return quality.suite(
        [(MART_TABLE, keyed, [quality.unique("grain")]), (STG_TABLE, s, [quality.unique("period")])]
    )


#: Columns of about as many values as rows, and one with repeats all over.
_MANY = ["obs_id", "obs_key", "order_id"]
_OBS_TABLE = "observations"


@register(
    "dq_unique_many",
    with_ctes("obs")
    + """, keyed as (
  select obs_id, concat_ws('|', geo, time, nrg_cons, cast(obs_id as varchar)) as obs_key, obs_id // 10 as order_id from obs
)
select *, case when failures > 0 then 'FAIL' else 'PASS' end as status from (
"""
    + "\nunion all\n".join(_rule_sql(_OBS_TABLE, "keyed", quality.unique(c)) for c in _MANY)
    + "\n) t",
)
def q_dq_unique_many(spark, sf_dir):
    keyed = fx.obs(spark, sf_dir).selectExpr(
        "obs_id", "concat_ws('|', geo, time, nrg_cons, cast(obs_id as string)) as obs_key", "obs_id div 10 as order_id"
    )
    return quality.suite([(_OBS_TABLE, keyed, [quality.unique(c, many=True) for c in _MANY])])


def _report_sql() -> str:
    lo, hi = 0.20, 0.30
    return (
        with_ctes("mart")
        + f"""
, counts as (
  select '{STG_TABLE}' as t, count(*) as n from stg union all select '{MART_TABLE}', count(*) from mart)
, nulls as ({_null_counts_body('stg', 'mart')})
select 1 as section, t as item, format('{{:,}}', n) as value, case when n = 0 then 'WARN' else 'OK' end as status
from counts
union all
select 2, 'latest_period', coalesce(max(period), 'no data found'),
       case when max(period) is null then 'WARN' else 'OK' end from stg
union all
select 3, concat_ws(' ', country_code, country_name), format('{{:,}}', count(*)), 'OK'
from mart group by country_code, country_name
union all
select 3, 'rows', '0', 'WARN' from mart having count(*) = 0
union all
select 4, concat(table_name, '.', column_name), cast(nulls as varchar), status from nulls
union all
select 5, concat_ws(' ', country_code, consumer_type, cast(year as varchar)), printf('%.4f', avg_price_eur_per_kwh),
       'WARN'
from mart where avg_price_eur_per_kwh < {lo} or avg_price_eur_per_kwh > {hi}
union all
select 5, 'anomalies', n::varchar, if(n = 0, 'OK', 'WARN')
from (select count(*) as n from mart where avg_price_eur_per_kwh not between {lo} and {hi})
union all
select * from (select 6, concat_ws(' ', 'increase', country_code, consumer_type, cast(year as varchar)),
       concat('+', printf('%.2f', yoy_change_pct), '%'), ''
from mart where yoy_change_pct is not null
order by yoy_change_pct desc, country_code, consumer_type, year limit 3)
union all
select * from (select 6, concat_ws(' ', 'decrease', country_code, consumer_type, cast(year as varchar)),
       concat(printf('%.2f', yoy_change_pct), '%'), ''
from mart where yoy_change_pct is not null
order by yoy_change_pct asc, country_code, consumer_type, year limit 3)
"""
    )


@register("dq_report", _report_sql())
def q_dq_report(spark, sf_dir):
    return quality.report(*stored(spark, sf_dir), 0.20, 0.30)


@register("gated_publish", with_ctes("mart") + "select * from mart")
def q_gated_publish(spark, sf_dir):
    root, database = scratch_path(spark, "gated"), f"pricecube_{uuid.uuid4().hex}"
    s, m = stg(spark, sf_dir), mart(spark, sf_dir)
    publish.gated_publish(
        spark,
        [
            (STG_TABLE, s, quality.STG_RULES, f"{database}.{STG_TABLE}"),
            (MART_TABLE, m, quality.MART_RULES, f"{database}.{MART_TABLE}"),
        ],
        staging_root=root,
    )
    return spark.table(f"{database}.{MART_TABLE}")


@register(
    "publish_versions",
    with_ctes("mart")
    + f"""select 1 as number, '{STG_TABLE}' as table_name, count(*) as rows, max(period) as latest from stg where period < '1996'
union all
select 2, '{STG_TABLE}', count(*), max(period) from stg
union all
select 1, '{MART_TABLE}', count(*), max(year)::varchar from mart where year < 1996
union all
select 2, '{MART_TABLE}', count(*), max(year)::varchar from mart""",
)
def q_publish_versions(spark, sf_dir):
    """Two versions of both tables; what a reader of each sees, and a writer that comes
    too late for the first."""
    root, s = scratch_path(spark, "versions"), stg(spark, sf_dir)
    rules = {STG_TABLE: quality.STG_RULES, MART_TABLE: quality.MART_RULES}
    early = s.where(F.col("period") < "1996")
    versions.publish(spark, root, {STG_TABLE: early, MART_TABLE: annual.mart(early)}, rules)
    reader = versions.Snapshot(spark, root)
    late = versions.stage(spark, root, {STG_TABLE: s})
    try:
        versions.commit(spark, late, 1)
    except versions.LostRaceError:
        versions.discard(spark, late)
    versions.publish(spark, root, {STG_TABLE: s, MART_TABLE: annual.mart(s)}, rules)
    out = None
    for snapshot in (reader, versions.Snapshot(spark, root)):
        for name, column in ((STG_TABLE, F.col("period")), (MART_TABLE, F.col("year").cast("string"))):
            part = snapshot.table(name).agg(F.count(F.lit(1)).alias("rows"), F.max(column).alias("latest"))
            part = part.select(F.lit(snapshot.number).cast("int").alias("number"), F.lit(name).alias("table_name"), "rows", "latest")
            out = part if out is None else out.unionByName(part)
    return out


# --- increments -----------------------------------------------------------------


def landed_loads(spark, sf_dir, source=fx.raw):
    """The raw rows of three loads, each in its own folder: odd years, even years, and
    rows of all years that came late.  Gives a reader of one load's staging rows.

    Writing by load sorts a task's rows by load, so they are dealt to tasks of one size."""
    path, year = scratch_path(spark, "loads"), F.left("time", F.lit(4)).cast("int")
    late = F.pmod(F.xxhash64("geo", "time", "value_eur_per_kwh"), F.lit(10)) == 0
    load = F.when(late, 3).otherwise(F.pmod(year, F.lit(2)) + 1)
    dealt = source(spark, sf_dir).withColumn("load", load).hint("rebalance", "geo", "time", "value_eur_per_kwh")
    dealt.write.partitionBy("load").parquet(path)
    return lambda k: staging(spark.read.parquet(f"{path}/load={k}"))


@register("mart_incremental", with_ctes("mart") + f"select {MART_COLS} from mart")
def q_mart_incremental(spark, sf_dir):
    new, root = landed_loads(spark, sf_dir), scratch_path(spark, "mart")
    for k in (1, 2, 3):
        seen = incremental.refresh_mart(spark, root, str(k), new(k))
    return seen.table(incremental.MART)


@register("dq_suite_incremental", _suite_sql([p for p in _suite_parts(None) if p[0] == STG_TABLE] + [(STG_TABLE, "stg_dirty", quality.unique("period"))], ["mart_dirty"]))
def q_dq_suite_incremental(spark, sf_dir):
    new, root = landed_loads(spark, sf_dir, fx.raw_dirty), scratch_path(spark, "checks")
    for k in (1, 2, 3):
        found = incremental.check_load(spark, root, str(k), [(STG_TABLE, new(k), [*quality.STG_RULES, quality.unique("period")])])
    return found
