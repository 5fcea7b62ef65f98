"""DuckDB oracle SQL for every registered query.

The input views are the FIXTURES.md §2 texts.  Staging, the yearly table and
the mart are written from SURVEY's rules with DuckDB's own round, cast and avg,
so the comparison checks our Spark expressions against those semantics.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2025-01-01 00:00:00'"

_CTES: dict[str, tuple[list[str], str]] = {}


def _cte(name: str, deps: list[str], body: str) -> None:
    _CTES[name] = (deps, body)


_cte(
    "obs",
    [],
    """
select case when c_mktsegment = 'HOUSEHOLD' then 'household' else 'industry' end as consumer_type,
       concat('N', lpad(cast(n_nationkey as string), 2, '0')) as geo,
       n_name as country_name,
       concat(cast(year(o_orderdate) as string),
              case when month(o_orderdate) <= 6 then '-S1' else '-S2' end) as time,
       'S' as freq, 'Half-yearly' as freq_label, 'E7000' as siec, 'Electricity' as siec_label,
       case l_returnflag when 'A' then 'TOT_KWH' when 'N' then 'KWH1000-2499' else 'KWH2500-4999' end as nrg_cons,
       case l_returnflag when 'A' then 'All bands' when 'N' then 'Small' else 'Medium' end as nrg_cons_label,
       'KWH' as unit, 'Kilowatt-hour' as unit_label,
       case l_linestatus when 'F' then 'I_TAX' else 'X_TAX' end as tax,
       case l_linestatus when 'F' then 'Taxes included' else 'Taxes excluded' end as tax_label,
       case when l_linenumber <= 5 then 'EUR' when l_linenumber = 6 then 'NAC' else 'PPS' end as currency,
       case when l_linenumber <= 5 then 'Euro' when l_linenumber = 6 then 'National' else 'Parity' end as currency_label,
       n_name as geo_label,
       concat(cast(year(o_orderdate) as string),
              case when month(o_orderdate) <= 6 then ' first half' else ' second half' end) as time_label,
       cast(floor(o_totalprice / 100) as double) / 10000 as value_eur_per_kwh,
       l_orderkey * 10 + l_linenumber as obs_id,
       l_quantity as qty
from lineitem
join orders   on l_orderkey  = o_orderkey
join customer on o_custkey   = c_custkey
join nation   on c_nationkey = n_nationkey""",
)

RAW_COLUMNS_SQL = """consumer_type, geo, country_name, time, freq, freq_label, siec, siec_label,
       nrg_cons, nrg_cons_label, unit, unit_label, tax, tax_label, currency, currency_label,
       geo_label, time_label, value_eur_per_kwh"""

_cte("raw", ["obs"], f"select {RAW_COLUMNS_SQL}, {AS_OF_SQL} as loaded_at from obs")

_cte(
    "obs_half",
    ["obs"],
    """
select geo, country_name, consumer_type, time, min_by(value_eur_per_kwh, obs_id) as value_eur_per_kwh
from obs
where currency = 'EUR' and tax = 'I_TAX' and nrg_cons = 'TOT_KWH'
group by geo, country_name, consumer_type, time""",
)

_cte(
    "raw_half",
    ["obs_half"],
    f"""
select consumer_type, geo, country_name, time, 'TOT_KWH' as nrg_cons, 'All bands' as nrg_cons_label,
       'I_TAX' as tax, 'Taxes included' as tax_label, 'EUR' as currency, value_eur_per_kwh,
       {AS_OF_SQL} as loaded_at
from obs_half""",
)

_cte(
    "raw_dirty",
    ["obs"],
    f"""
select case when qty = 49 then 'other' else consumer_type end as consumer_type,
       geo,
       case when geo < 'N06' then country_name end as country_name,
       time, nrg_cons, nrg_cons_label, tax, tax_label, currency,
       case when qty = 50 then null else value_eur_per_kwh end as value_eur_per_kwh,
       {AS_OF_SQL} as loaded_at
from obs""",
)

_STG_BODY = """
select consumer_type, geo as country_code, country_name, time as period, nrg_cons, nrg_cons_label, tax_label,
       value_eur_per_kwh::decimal(10, 4) as price_eur_per_kwh,
       if(value_eur_per_kwh >= 0.15, if(value_eur_per_kwh > 0.25, 'High', 'Medium'), 'Low') as price_category,
       loaded_at
from {src}
where (currency, tax) = ('EUR', 'I_TAX')"""

# One row per (country, type, year) with its statistics and a count for each tier.
_YEARLY_BODY = """
select country_code, country_name, consumer_type, period[1:4]::int as year,
       round(avg(price_eur_per_kwh), 4) as mean, min(price_eur_per_kwh) as lowest, max(price_eur_per_kwh) as highest,
       count(*) filter (where price_category = 'High') as high,
       count(*) filter (where price_category = 'Medium') as medium,
       count(*) filter (where price_category = 'Low') as low
from {stg}
where nrg_cons = 'TOT_KWH'
group by all"""

_MART_BODY = """
select country_code, country_name, year, consumer_type, mean as avg_price_eur_per_kwh,
       lowest as min_price, highest as max_price,
       if(high >= greatest(medium, low), 'High', if(medium >= low, 'Medium', 'Low')) as price_category_mode,
       lag(mean) over series as prior_year_avg_price,
       round((mean - lag(mean) over series) / nullif(lag(mean) over series, 0) * 100, 2) as yoy_change_pct
from {yearly}
window series as (partition by country_code, consumer_type order by year)"""

for _suffix, _src in (("", "raw"), ("_half", "raw_half"), ("_dirty", "raw_dirty")):
    _cte(f"stg{_suffix}", [_src], _STG_BODY.format(src=_src))
    _cte(f"yearly{_suffix}", [f"stg{_suffix}"], _YEARLY_BODY.format(stg=f"stg{_suffix}"))
    _cte(f"mart{_suffix}", [f"yearly{_suffix}"], _MART_BODY.format(yearly=f"yearly{_suffix}"))


def with_ctes(*names: str) -> str:
    """``with a as (...), b as (...)`` for ``names`` and everything they use."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "with " + ",\n".join(f"{n} as ({_CTES[n][1]}\n)" for n in order) + "\n"


def cte_body(name: str) -> str:
    return _CTES[name][1]
