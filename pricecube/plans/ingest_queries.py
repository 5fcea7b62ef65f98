"""Registered ingestion and IO queries: cube decoding, dataset assembly,
CSV landing, raw load, catalog listing and export."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricecube.constants import MART_TABLE, STG_TABLE
from pricecube.operators import publish
from pricecube.plans import fixtures as fx
from pricecube.plans.oracle_sql import AS_OF_SQL, with_ctes
from pricecube.plans.registry import mart, register, stg
from pricecube.schemas import RAW
from pricecube.session import scratch_path
from pricecube.sources import catalog, clustered, cube, datasets, detect, documents, files, split

# --- hypercube documents --------------------------------------------------------

CELL_DIMS = cube.CUBE_DIMS
CELL_LABELS = {d: f"{d}_label" for d in CELL_DIMS}


def cells(spark, sf_dir):
    """Observed cells: one value per (type, geo, time, band, tax, currency)."""
    o = fx.obs(spark, sf_dir)
    keys = ["consumer_type", *CELL_DIMS, *CELL_LABELS.values()]
    return o.groupBy(*keys).agg(F.min_by("value_eur_per_kwh", "obs_id").alias("value_eur_per_kwh"))


def cube_docs(spark, sf_dir):
    """Land one document per (dataset, country), like per-country downloads."""
    c = cells(spark, sf_dir).withColumn("dataset", cube.dataset_code(F.col("consumer_type")))
    return cube.encode(c, ["dataset", "geo"], CELL_DIMS, "value_eur_per_kwh", CELL_LABELS).withColumnRenamed(
        "geo", "doc_geo"
    )


def landed_docs(spark, sf_dir):
    """Documents written as JSON lines under dataset=<code>/ and read back."""
    path = scratch_path(spark, "cubes")
    cube_docs(spark, sf_dir).select("dataset", "doc.*").write.partitionBy("dataset").json(path)
    return cube.read_cube_json(spark, path)


_CELLS_SQL = """
cells as (
  select consumer_type, freq, siec, nrg_cons, unit, tax, currency, geo, time,
         freq_label, siec_label, nrg_cons_label, unit_label, tax_label, currency_label, geo_label, time_label,
         min_by(value_eur_per_kwh, obs_id) as value_eur_per_kwh
  from obs
  group by all)
"""


@register(
    "cube_decode",
    with_ctes("obs")
    + ","
    + _CELLS_SQL
    + """select consumer_type, freq, freq_label, siec, siec_label, nrg_cons, nrg_cons_label, unit, unit_label,
       tax, tax_label, currency, currency_label, geo, geo_label, time, time_label, value_eur_per_kwh from cells""",
)
def q_cube_decode(spark, sf_dir):
    docs = landed_docs(spark, sf_dir)
    dec = cube.decode(docs, carry=["dataset"], value_col="value_eur_per_kwh")
    return dec.select(
        cube.dataset_label(F.col("dataset")).alias("consumer_type"),
        *[c for d in CELL_DIMS for c in (d, f"{d}_label")],
        "value_eur_per_kwh",
    )


def _dim_sql(ordinal: int, d: str) -> str:
    return f"""select distinct consumer_type, geo as doc_geo, {ordinal} as ordinal, '{d}' as dimension,
       {d} as code, {d}_label as label from cells"""


@register(
    "cube_dimensions",
    with_ctes("obs")
    + ","
    + _CELLS_SQL
    + ", cats as (\n"
    + "\nunion all\n".join(_dim_sql(i + 1, d) for i, d in enumerate(CELL_DIMS))
    + """)
select consumer_type, doc_geo, ordinal, dimension,
       cast(dense_rank() over (partition by consumer_type, doc_geo, dimension order by code) - 1 as integer)
         as position,
       code, label
from cats""",
)
def q_cube_dimensions(spark, sf_dir):
    docs = cube_docs(spark, sf_dir)
    dims = cube.dimensions(docs, carry=["dataset", "doc_geo"])
    return dims.select(
        cube.dataset_label(F.col("dataset")).alias("consumer_type"),
        "doc_geo",
        F.col("ordinal").cast("int").alias("ordinal"),
        "dimension",
        "position",
        "code",
        "label",
    )


@register(
    "cube_strides",
    with_ctes("obs")
    + ","
    + _CELLS_SQL
    + ", sizes as (\n"
    + "\nunion all\n".join(
        f"select consumer_type, geo as doc_geo, {i + 1} as ordinal, '{d}' as dimension,"
        f" count(distinct {d}) as size from cells group by consumer_type, geo"
        for i, d in enumerate(CELL_DIMS)
    )
    + """)
select consumer_type, doc_geo, ordinal, dimension, cast(size as integer) as size,
       cast(coalesce(product(size) over (partition by consumer_type, doc_geo order by ordinal
                                         rows between 1 following and unbounded following), 1) as bigint) as stride
from sizes""",
)
def q_cube_strides(spark, sf_dir):
    docs = cube_docs(spark, sf_dir)
    st = cube.stride_table(docs, carry=["dataset", "doc_geo"])
    return st.select(
        cube.dataset_label(F.col("dataset")).alias("consumer_type"),
        "doc_geo",
        F.col("ordinal").cast("int").alias("ordinal"),
        "dimension",
        "size",
        "stride",
    )


#: How the documents of some countries are damaged before they land.
_DAMAGE_SQL = """case when geo = 'N03' then 'not one JSON object' when geo = 'N05' then 'no dimension ids'
            when geo = 'N07' then 'cells that are not numbers' when geo = 'N09' then 'not one JSON object' end"""


@register(
    "cube_quarantine",
    with_ctes("obs")
    + ","
    + _CELLS_SQL
    + f"""select consumer_type, geo as doc_geo, {_DAMAGE_SQL} as reason, case when {_DAMAGE_SQL} is null then count(*) else 0 end as cells
from cells group by consumer_type, geo""",
)
def q_cube_quarantine(spark, sf_dir):
    """A file for each document: some cut off (N03), without ids (N05), with a text
    for a number (N07) or followed by more (N09), others pretty-printed (N11)."""
    geo, doc = F.col("doc_geo"), F.col("doc")
    text = F.to_json(doc)
    text = (
        F.when(geo == "N03", F.left(text, F.char_length(text) - 100))
        .when(geo == "N05", F.to_json(F.struct("doc.size", "doc.dimension", "doc.value")))
        .when(geo == "N07", F.regexp_replace(text, r'("value":\{"\d+":)', '$1"n/a","0":'))
        .when(geo == "N09", F.concat(text, F.lit("}")))
        .when(geo == "N11", F.to_json(doc, {"pretty": "true"}))
        .otherwise(text)
    )
    landing = scratch_path(spark, "damaged")
    cube_docs(spark, sf_dir).select("dataset", "doc_geo", text.alias("value")).write.partitionBy("dataset", "doc_geo").text(landing)
    whole, broken = documents.store_documents(documents.read_documents(spark, landing), scratch_path(spark, "documents"))
    rows = cube.decode(whole, CELL_DIMS, carry=["dataset", "doc_geo"])
    counted = rows.groupBy("dataset", "doc_geo").agg(F.count(F.lit(1)).alias("cells"))
    found = counted.select("*", F.lit(None).cast("string").alias("reason")).unionByName(
        broken.select("dataset", "doc_geo", F.lit(0).cast("bigint").alias("cells"), "reason")
    )
    return found.select(cube.dataset_label(F.col("dataset")).alias("consumer_type"), "doc_geo", "reason", "cells")


#: Digits of ``obs_id`` to the base 100, from the highest down: the dimensions of one large document.
DIGITS = [f"d{k}" for k in range(5)]


def large_documents(spark, sf_dir):
    """All of ``obs`` as one document for each dataset, a cell a line: the flat index is
    ``obs_id``, whose digits are the positions.  A document is written in parts, each a
    range of the cells, by as many tasks."""
    o = fx.obs(spark, sf_dir).groupBy(cube.dataset_code(F.col("consumer_type")).alias("dataset"), "obs_id")
    stored = scratch_path(spark, "cells")
    (o := o.agg(F.min("value_eur_per_kwh").alias("v"))).write.parquet(stored)
    o = spark.read.schema(o.schema).parquet(stored)
    ranges = datasets.sort_ranges(spark, o.count())
    codes = F.map_from_entries(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.struct(F.format_string("c%02d", i), i)))
    category = F.struct(codes.alias("index"), F.transform_values(codes, lambda c, _: F.upper(c)).alias("label"))
    dims = F.create_map(*[x for d in DIGITS for x in (F.lit(d), F.struct(category.alias("category")))])
    head = F.to_json(F.struct(F.array(*map(F.lit, DIGITS)).alias("id"), F.array(*[F.lit(100)] * len(DIGITS)).alias("size"), dims.alias("dimension")))
    ends = o.groupBy("dataset").agg(F.min("obs_id").alias("first"), F.max("obs_id").alias("last"))
    at = F.col("obs_id")
    line = F.concat(
        F.when(at == F.col("first"), F.concat(F.left(head, F.char_length(head) - 1), F.lit(', "value": {\n'))).otherwise(""),
        F.concat(F.lit('"'), at, F.lit('": '), F.col("v")),
        F.when(at == F.col("last"), '\n}, "source": "one, {large} document"}').otherwise(","),
    )
    path = scratch_path(spark, "large")
    ordered = o.join(F.broadcast(ends), "dataset").select("dataset", at, line.alias("value"))  # ends: a row a dataset
    ordered = ordered.repartitionByRange(*([ranges] if ranges else []), "dataset", "obs_id").sortWithinPartitions("dataset", "obs_id")
    ordered.select("dataset", "value").write.partitionBy("dataset").text(path)
    return path


@register(
    "cube_split_decode",
    with_ctes("obs")
    + "select consumer_type, "
    + ", ".join(
        f"printf('c%02d', obs_id // {100 ** (4 - k)} % 100) as {d}, printf('C%02d', obs_id // {100 ** (4 - k)} % 100) as {d}_label"
        for k, d in enumerate(DIGITS)
    )
    + ", min(value_eur_per_kwh) as value_eur_per_kwh from obs group by consumer_type, obs_id",
)
def q_cube_split_decode(spark, sf_dir):
    rows = split.split_decode(spark, large_documents(spark, sf_dir), value_col="value_eur_per_kwh", parts=True)
    return rows.withColumn("consumer_type", cube.dataset_label(F.col("dataset"))).drop("dataset")


# --- dataset assembly -------------------------------------------------------------


def _split(spark, sf_dir):
    """The two datasets of ``obs``: household lacks ``unit_label``."""
    o = fx.obs(spark, sf_dir)
    house = o.where(F.col("consumer_type") == "household").drop("unit_label")
    ind = o.where(F.col("consumer_type") == "industry")
    return house, ind


@register(
    "multi_dataset_union",
    with_ctes("obs")
    + """, u as (
  select * exclude (unit_label), null as unit_label from obs where consumer_type = 'household'
  union all by name
  select * from obs where consumer_type = 'industry')
select consumer_type, unit_label, geo, count(*) as n, count(value_eur_per_kwh) as n_values
from u group by consumer_type, unit_label, geo""",
)
def q_multi_dataset_union(spark, sf_dir):
    house, ind = _split(spark, sf_dir)
    u = datasets.union_datasets([house, ind])
    return u.groupBy("consumer_type", "unit_label", "geo").agg(
        F.count(F.lit(1)).alias("n"), F.count("value_eur_per_kwh").alias("n_values")
    )


GEO_SUBSET = ["N00", "N01", "N02", "N03", "N04", "N05"]


@register(
    "filter_geo_in",
    with_ctes("obs")
    + "select geo, count(*) as n from obs where geo in ('N00', 'N01', 'N02', 'N03', 'N04', 'N05') group by geo",
)
def q_filter_geo_in(spark, sf_dir):
    return datasets.filter_geo_in(fx.obs(spark, sf_dir), GEO_SUBSET).groupBy("geo").agg(F.count(F.lit(1)).alias("n"))


@register(
    "filter_year_range",
    with_ctes("obs")
    + """select cast(left(time, 4) as integer) as year, count(*) as n from obs
where cast(left(time, 4) as integer) between 1996 and 2000 group by 1""",
)
def q_filter_year_range(spark, sf_dir):
    f = datasets.filter_year_range(fx.obs(spark, sf_dir), 1996, 2000)
    return f.groupBy(F.left("time", F.lit(4)).cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"))


_DICT_SQL = (
    "(values ('N00', 'ALGERIA'), ('N01', 'ARGENTINA'), ('N02', 'BRAZIL'), ('N03', 'CANADA'),"
    " ('N04', 'EGYPT'), ('N05', 'ETHIOPIA')) as d(geo, name)"
)


@register(
    "country_lookup",
    with_ctes("obs")
    + f"""select o.geo, d.name as country_name, count(*) as n
from obs o left join {_DICT_SQL} on o.geo = d.geo group by o.geo, d.name""",
)
def q_country_lookup(spark, sf_dir):
    o = fx.obs(spark, sf_dir).select("geo")
    looked = datasets.lookup_country(o, fx.countries(spark))
    return looked.groupBy("geo", "country_name").agg(F.count(F.lit(1)).alias("n"))


@register(
    "raw_tidy",
    with_ctes("obs")
    + f"""select o.consumer_type, o.geo, d.name as country_name, o.time,
       o.freq, o.freq_label, o.siec, o.siec_label, o.nrg_cons, o.nrg_cons_label, o.unit, o.unit_label,
       o.tax, o.tax_label, o.currency, o.currency_label, o.geo_label, o.time_label, o.value_eur_per_kwh
from obs o left join {_DICT_SQL} on o.geo = d.geo
order by o.consumer_type, o.geo, o.time, o.nrg_cons, o.tax, o.currency""",
)
def q_raw_tidy(spark, sf_dir):
    house, ind = _split(spark, sf_dir)
    house = house.withColumn("unit_label", F.lit("Kilowatt-hour"))
    frames = [f.select(*[c for c in fx.RAW_COLUMNS if c != "country_name"]) for f in (house, ind)]
    return datasets.tidy(frames, names=fx.COUNTRY_DICT, stored=True)


# --- landing and loading -----------------------------------------------------------


_AWKWARD = {1: "", 2: "  spaces at the ends ", 3: 'a "quoted" word, a comma', 4: "backslash at the end\\", 5: "two\nlines", 6: '"', 7: " "}
_AWKWARD_SQL = "case qty " + " ".join(f"when {q} then '{t}'" for q, t in _AWKWARD.items()) + " else nrg_cons_label end"


@register(
    "csv_roundtrip",
    with_ctes("obs")
    + f"""select consumer_type, geo, country_name, time, freq, freq_label, siec, siec_label,
       nrg_cons, nullif({_AWKWARD_SQL}, '') as nrg_cons_label,
       unit, unit_label, tax, tax_label, currency, currency_label, geo_label, time_label, value_eur_per_kwh
from obs""",
)
def q_csv_roundtrip(spark, sf_dir):
    label = F.col("nrg_cons_label")
    for qty, text in _AWKWARD.items():
        label = F.when(F.col("qty") == qty, F.lit(text)).otherwise(label)
    path = scratch_path(spark, "csv")
    files.write_csv(fx.obs(spark, sf_dir).withColumn("nrg_cons_label", label).select(*fx.RAW_COLUMNS), path)
    return files.read_csv(spark, path, RAW)


#: Texts of many kinds, made of ``obs`` alike by both engines; of ``rare`` only one row is no number.
_KINDS = {
    "obs_id": "cast(obs_id as string)",
    "geo": "geo",
    "time": "time",
    "year": "left(time, 4)",
    "half": "cast(time like '%S1' as string)",
    "price": "cast(value_eur_per_kwh as string)",
    "gaps": "case when qty < 25 then cast(cast(qty as int) as string) else '' end",
    "blank": "''",
    "day": "concat(left(time, 4), '-0', cast(obs_id % 9 + 1 as string), '-1', cast(obs_id % 10 as string))",
    "moment": "concat(left(time, 4), '-01-02 03:0', cast(obs_id % 10 as string), ':00')",
    "zoned": "concat(left(time, 4), '-01-02T03:0', cast(obs_id % 10 as string), ':00Z')",
    "no_day": "concat(left(time, 4), '-02-', case when obs_id % 1000 = 2 then '30' else '11' end)",
    "rare": "case when obs_id = (select max(obs_id) from obs) then 'n/a' else cast(obs_id as string) end",
    "wide": "case when obs_id = (select max(obs_id) from obs) then '0.5' else cast(obs_id as string) end",
}
#: What a cast alone would round or cut, DuckDB is asked about as well.
_FITS = {"BIGINT": ("bigint", "not bool_or({0} like '%.%')"), "DOUBLE": ("double", "true"), "BOOLEAN": ("boolean", "true"), "DATE": ("date", "max(length({0})) <= 10")}


@register(
    "csv_detect",
    with_ctes("obs")
    + ", t as (select "
    + ", ".join(f"nullif({text}, '') as {name}" for name, text in _KINDS.items())
    + " from obs)\nselect * from (\n"
    + "\nunion all\n".join(
        f"select {i} as ordinal_position, '{name}' as column_name, case when count({name}) = 0 then 'VARCHAR' "
        + " ".join(f"when count({name}) = count(try_cast({name} as {kind})) and {also.format(name)} then '{said}'" for said, (kind, also) in _FITS.items())
        + f" when count({name}) = count(try_cast({name} as timestamp)) then if(bool_or({name} like '%Z'), 'TIMESTAMP WITH TIME ZONE', 'TIMESTAMP')"
        + " else 'VARCHAR' end as data_type from t"
        for i, name in enumerate(_KINDS, 1)
    )
    + ")",
)
def q_csv_detect(spark, sf_dir):
    """The types of a CSV of texts, from all its rows."""
    o, path = fx.obs(spark, sf_dir), scratch_path(spark, "kinds")
    last = o.agg(F.max("obs_id").alias("last")).first()["last"]
    texts = [F.expr(t.replace("(select max(obs_id) from obs)", str(last))).alias(n) for n, t in _KINDS.items()]
    files.write_csv(o.select(*texts), path)
    return detect.detect_types(detect.read_texts(spark, path))


@register("raw_load", with_ctes("raw") + "select * from raw")
def q_raw_load(spark, sf_dir):
    loaded, table = publish.load_once(
        spark, fx.obs(spark, sf_dir).select(*fx.RAW_COLUMNS), scratch_path(spark, "raw"), as_of=fx.AS_OF
    )
    return table


@register(
    "load_once",
    with_ctes("obs") + "select true as first_loaded, false as second_loaded, count(*) as rows from obs",
)
def q_load_once(spark, sf_dir):
    path = scratch_path(spark, "raw-once")
    src = fx.obs(spark, sf_dir).select(*fx.RAW_COLUMNS)
    first, _ = publish.load_once(spark, src, path, as_of=fx.AS_OF)
    second, table = publish.load_once(spark, src.where(F.col("geo") < "N05"), path, as_of="2025-06-01 00:00:00")
    return table.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(first).alias("first_loaded"), F.lit(second).alias("second_loaded"), "rows"
    )


@register("load_batches", with_ctes("obs") + f"select {AS_OF_SQL} as loaded_at, count(*) as rows from obs")
def q_load_batches(spark, sf_dir):
    _, table = publish.load_once(
        spark, fx.obs(spark, sf_dir).select(*fx.RAW_COLUMNS), scratch_path(spark, "raw-batch"), as_of=fx.AS_OF
    )
    return table.groupBy("loaded_at").agg(F.count(F.lit(1)).alias("rows"))


SQL_TYPE_NAMES = {"STRING": "VARCHAR", "INT": "INTEGER", "TIMESTAMP_NTZ": "TIMESTAMP"}


@register(
    "table_schema",
    with_ctes("raw")
    + """select cast(row_number() over () as integer) as ordinal_position, column_name, column_type as data_type
from (describe select * from raw)""",
)
def q_table_schema(spark, sf_dir):
    _, table = publish.load_once(
        spark, fx.obs(spark, sf_dir).select(*fx.RAW_COLUMNS), scratch_path(spark, "raw-schema"), as_of=fx.AS_OF
    )
    listing = catalog.schema_frame(spark, table.schema)
    m = F.create_map(*[F.lit(x) for kv in SQL_TYPE_NAMES.items() for x in kv])
    return listing.select(
        "ordinal_position", "column_name", F.coalesce(F.try_element_at(m, F.col("data_type")), F.col("data_type")).alias("data_type")
    )


@register(
    "table_columns",
    with_ctes("raw")
    + ", listed as (select *, if(geo < 'N06', country_name, null) as known_name from raw)\n"
    + "\nunion all\n".join(
        f"select {i} as ordinal_position, '{c}' as column_name, any_value(typeof({c})) as data_type, count(*) as rows, count(*) - count({c}) as nulls from listed"
        for i, c in enumerate([*fx.RAW_COLUMNS, "loaded_at", "known_name"], 1)
    ),
)
def q_table_columns(spark, sf_dir):
    """Columns, types and missing values of a stored table, counted in it."""
    path = scratch_path(spark, "listed")
    fx.raw(spark, sf_dir).withColumn("known_name", F.when(F.col("geo") < "N06", F.col("country_name"))).write.parquet(path)
    listing = catalog.column_listing(spark.read.parquet(path))
    m = F.create_map(*[F.lit(x) for kv in SQL_TYPE_NAMES.items() for x in kv])
    return listing.withColumn("data_type", F.coalesce(F.try_element_at(m, F.col("data_type")), F.col("data_type")))


@register(
    "raw_sample",
    with_ctes("obs")
    + """select consumer_type, country_name, time, nrg_cons, tax, currency, value_eur_per_kwh, obs_id
from obs
where geo = 'N03' and consumer_type = 'household' and nrg_cons = 'TOT_KWH' and currency = 'EUR' and tax = 'I_TAX'
order by time, obs_id limit 5""",
)
def q_raw_sample(spark, sf_dir):
    o = fx.obs(spark, sf_dir)
    cond = (
        (F.col("geo") == "N03")
        & (F.col("consumer_type") == "household")
        & (F.col("nrg_cons") == "TOT_KWH")
        & (F.col("currency") == "EUR")
        & (F.col("tax") == "I_TAX")
    )
    return (
        o.where(cond)
        .select("consumer_type", "country_name", "time", "nrg_cons", "tax", "currency", "value_eur_per_kwh", "obs_id")
        .orderBy("time", "obs_id")
        .limit(5)
    )


@register(
    "clustered_raw",
    with_ctes("obs")
    + """select 'geo' as wanted, geo, time, nrg_cons, count(*) as n, sum(obs_id) as ids from obs where geo in ('N03', 'N17') group by geo, time, nrg_cons
union all
select 'time', geo, time, nrg_cons, count(*), sum(obs_id) from obs where time between '1995-S2' and '1996-S1' group by geo, time, nrg_cons
union all
select 'band', geo, time, nrg_cons, count(*), sum(obs_id) from obs where nrg_cons = 'TOT_KWH' group by geo, time, nrg_cons""",
)
def q_clustered_raw(spark, sf_dir):
    """Reads of the clustered raw table by each of its columns."""
    root, stored = scratch_path(spark, "clustered"), scratch_path(spark, "unclustered")
    fx.obs(spark, sf_dir).write.parquet(stored)
    clustered.write(spark.read.parquet(stored), root)
    out = None
    for name, wanted in (("geo", {"geo": ["N03", "N17"]}), ("time", {"time": ("1995-S2", "1996-S1")}), ("band", {"nrg_cons": ["TOT_KWH"]})):
        rows = clustered.read(spark, root, wanted).groupBy("geo", "time", "nrg_cons").agg(F.count(F.lit(1)).alias("n"), F.sum("obs_id").alias("ids"))
        rows = rows.select(F.lit(name).alias("wanted"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


# --- export ---------------------------------------------------------------------------


@register(
    "export_staging",
    with_ctes("stg")
    + """select consumer_type, country_code, country_name, period, nrg_cons, nrg_cons_label, tax_label,
       cast(price_eur_per_kwh as double) as price_eur_per_kwh, price_category, loaded_at from stg""",
)
def q_export_staging(spark, sf_dir):
    target = scratch_path(spark, f"export-{STG_TABLE}")
    publish.export_table(stg(spark, sf_dir), target)
    return spark.read.parquet(target)


@register(
    "export_mart",
    with_ctes("mart")
    + """select country_code, country_name, year, consumer_type, avg_price_eur_per_kwh,
       cast(min_price as double) as min_price, cast(max_price as double) as max_price,
       price_category_mode, prior_year_avg_price, yoy_change_pct from mart""",
)
def q_export_mart(spark, sf_dir):
    target = scratch_path(spark, f"export-{MART_TABLE}")
    publish.export_table(mart(spark, sf_dir), target)
    return spark.read.parquet(target)


@register(
    "export_summary",
    with_ctes("mart")
    + f"""select '{STG_TABLE}' as table_name, count(*) as rows from stg
union all select '{MART_TABLE}', count(*) from mart
union all select 'TOTAL', (select count(*) from stg) + (select count(*) from mart)""",
)
def q_export_summary(spark, sf_dir):
    tables = [(STG_TABLE, stg(spark, sf_dir)), (MART_TABLE, mart(spark, sf_dir))]
    return publish.export_all(spark, tables, scratch_path(spark, "export"))


# --- incremental load (Structured Streaming) ---------------------------------------


@register(
    "cube_stream_load",
    with_ctes("obs")
    + ","
    + _CELLS_SQL
    + f"""select c.consumer_type, c.geo, d.name as country_name, c.time, c.freq, c.freq_label, c.siec, c.siec_label,
       c.nrg_cons, c.nrg_cons_label, c.unit, c.unit_label, c.tax, c.tax_label, c.currency, c.currency_label, c.geo_label, c.time_label,
       c.value_eur_per_kwh, 1 as batches
from cells c left join {_DICT_SQL} on c.geo = d.geo
where cast(left(c.time, 4) as integer) between 1993 and 1997""",
)
def q_cube_stream_load(spark, sf_dir):
    from pricecube.streaming.landing import load_landed

    landing = scratch_path(spark, "landing")
    cube_docs(spark, sf_dir).select("doc.*", "dataset").write.partitionBy("dataset").json(landing)
    table = load_landed(
        spark, landing, scratch_path(spark, "stream-raw"), start=1993, end=1997, names=fx.COUNTRY_DICT
    )
    batches = table.agg(F.count_distinct("loaded_at")).scalar()
    return table.drop("loaded_at").withColumn("batches", batches)
