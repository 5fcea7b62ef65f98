"""Line deduplication by site-relative frequency.

A line is boilerplate of a host if more than ``ratio`` of the host's pages (and
at least ``min_pages``) have it.  Pages are counted with map-side combined
aggregates keyed by (host, line digest), so neither a hot host nor a hot line
gathers in one task.  A host has at most (mean distinct lines of a page) /
``ratio`` such lines, so they fit into one array a host; pages get that array by
a join whose small side Spark may broadcast by its known size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, quoted, table, written

RATIO, MIN_PAGES = 0.1, 5


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line)))


def line_dedup(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host_col: str = "source", text_col: str = "text", counts: bool = True) -> DataFrame:
    """All columns of ``docs`` with ``text`` cleaned; with ``counts`` also n_lines
    and n_dropped, in place of any columns of those names.

    Lines end at ``\\n`` and are compared without spaces around them; blank lines
    are never dropped.  A line that a page repeats counts once for that page and
    is dropped everywhere.  Null hosts form a host of their own.  Null text stays
    null, with no lines; text whose lines all go becomes empty.  Rows are never
    dropped; repeated rows count as pages of their own.
    """
    site, drop, kept = fresh(docs, "_site"), fresh(docs, "_drop"), fresh(docs, "_kept")
    text, host = F.col(text_col), F.coalesce(F.concat(F.lit("h"), F.col(host_col)), F.lit(""))
    lines = F.split(text, "\n")
    slim = docs.select(host.alias("site"), F.array_distinct(F.transform(F.filter(lines, lambda x: F.trim(x) != ""), line_key)).alias("keys"))
    pages = docs.select(host.alias("site")).groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    counted = slim.select("site", F.explode("keys").alias("key")).groupBy("site", "key").agg(F.count(F.lit(1)).alias("n"))
    boilerplate = written(
        counted.where(F.col("n") >= min_pages)
        .join(pages, "site")
        .where(F.col("n") > F.lit(ratio) * F.col("pages"))
        .groupBy(F.col("site").alias(site))
        .agg(F.collect_set("key").alias(drop)),
        "boilerplate",
    )
    joined = docs.withColumn(site, host).join(boilerplate, site, "left")
    left = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(drop), line_key(x)))
    cleaned = joined.withColumn(kept, F.when(F.col(drop).isNotNull() & text.isNotNull(), left))
    n_lines = F.when(text.isNull(), F.lit(0)).otherwise(F.size(lines))
    out = {c: F.col(quoted(c)) for c in docs.columns}
    out[text_col] = F.coalesce(F.array_join(kept, "\n"), text)
    if counts:
        out["n_lines"] = n_lines
        out["n_dropped"] = F.when(F.col(kept).isNull(), F.lit(0)).otherwise(n_lines - F.size(kept))
    return cleaned.select(*[value.alias(name) for name, value in out.items()])


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


OP9_SQL = f"""
with lines as (
  select rowid as r, doc_id, source, text, string_split(text, chr(10)) as parts from
    (select row_number() over () as rowid, * from documents)
), pages as (
  select source, count(*) as pages from lines group by source
), seen as (
  select distinct r, source, trim(line, ' ') as line from (select r, source, unnest(parts) as line from lines) where trim(line, ' ') <> ''
), boilerplate as (
  select s.source, line from seen s join pages p on s.source is not distinct from p.source
  group by s.source, line, pages having count(*) >= {MIN_PAGES} and count(*) > {RATIO} * pages
), dropped as (
  select source, list(line) as gone from boilerplate group by source
), cleaned as (
  select doc_id, text, parts,
         case when gone is null then parts else list_filter(parts, lambda x: not list_contains(gone, trim(x, ' '))) end as kept
  from lines l left join dropped d on l.source is not distinct from d.source
)
select doc_id,
       cast(coalesce(len(parts), 0) as int) as n_lines,
       cast(coalesce(len(parts) - len(kept), 0) as int) as n_dropped,
       case when text is not null then array_to_string(kept, chr(10)) end as text
from cleaned
"""
