"""Source operators on text that Spark derives from the tables; each document is one file."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.sources import grid as G
from hazeline.sources import lines as L
from hazeline.fixed_values import HOUR_COLUMNS
from hazeline.queries.aggregates import hour_wide
from hazeline.sources.hourly import checked_hourly, ragged_cells, read_hourly
from hazeline.sources.lookups import read_lookup, read_stations
from hazeline.sources.stages import read_stage, stage_path, write_stage, write_table_csv
from hazeline.queries.base import query, r, table, text_date


@query(
    "src_ragged_csv",
    """
    with t as (select o_orderkey, string_split(case o_orderkey % 3
        when 0 then o_orderkey || ',"' || o_orderstatus || '",-999'
        when 1 then o_orderkey || ',' || o_orderstatus || ', ' || o_orderpriority || ' ,-,x'
        else o_orderkey || ',"' || o_orderpriority || '",NA,' || o_custkey || ',y,extra,more'
        end, ',') as c from orders)
    select o_orderkey, """
    + ", ".join(
        f"case when trim(replace(c[{i}], '\"', '')) in ('NA','','-','-999','-999.000') then null"
        f" else trim(replace(c[{i}], '\"', '')) end as v{i}" for i in range(1, 8)
    )
    + " from t",
)
def src_ragged_csv(spark, sf):
    line = F.expr(
        "case o_orderkey % 3 "
        "when 0 then concat(o_orderkey, ',\"', o_orderstatus, '\",-999') "
        "when 1 then concat(o_orderkey, ',', o_orderstatus, ', ', o_orderpriority, ' ,-,x') "
        "else concat(o_orderkey, ',\"', o_orderpriority, '\",NA,', o_custkey, ',y,extra,more') end"
    )
    df = table(spark, sf, "orders").select("o_orderkey", ragged_cells(line, 7).alias("cells"))
    return df.select("o_orderkey", *[F.get("cells", F.lit(i)).alias(f"v{i + 1}") for i in range(7)])


def words(line):
    return F.split(line, " ")


def document_lines(spark, sf):
    """Every document as a file of lines."""
    return L.table_lines(table(spark, sf, "documents"), "doc_id", "text")


def document_grids(spark, sf):
    """Every document as a sheet with words as cells."""
    return G.grids_of(document_lines(spark, sf), {"header": G.has_cell(HEADER, words)}, cells=words)


LINES = """
    with f as (select doc_id, string_split(text, chr(10)) as l from documents),
    lines as (select doc_id, unnest(range(1, len(l) + 1)) as row_no, unnest(l) as line from f)
"""


@query(
    "src_raw_grid",
    LINES
    + """
    select doc_id, row_no, unnest(range(1, len(string_split(line, ' ')) + 1)) as cell_no,
      unnest(string_split(line, ' ')) as cell from lines
    """,
)
def src_raw_grid(spark, sf):
    lines = document_lines(spark, sf)
    return L.numbered(lines, L.splits(lines)).select(
        F.col("path").alias("doc_id"), "row_no", F.posexplode(words(F.col("line"))).alias("cell_no", "cell")
    ).withColumn("cell_no", F.col("cell_no") + 1)


HEADER = "(?i)tion|ment"
OPTIONAL = ("of", "the", "la", "que", "and")
HEADER_SQL = (
    LINES
    + f"""
    , h as (select doc_id, min(row_no) as header_row from lines
        where regexp_matches(line, '{HEADER}') group by doc_id),
    d as (select doc_id, header_row, string_split(line, ' ') as header from h
        join lines using (doc_id) where row_no = header_row),
    o as (select *, coalesce(header[2] in {OPTIONAL}, false) as opt from d),
    b as (select o.doc_id, row_no, opt, header, string_split(line, ' ') as c from o
        join lines using (doc_id) where row_no > header_row),
    s as (select doc_id, row_no,
        case when opt then header[1:1] || header[3:] else header end as hd,
        case when opt then c[1:1] || c[3:] else c end as cs from b)
"""
)


@query(
    "src_header_row",
    HEADER_SQL
    + """
    , z as (select doc_id, row_no, unnest(range(1, len(cs) + 1)) as pos, hd, cs from s)
    select doc_id, lower(coalesce(hd[pos], '...' || pos)) as col_name, count(*) as n_values, sum(length(cs[pos])) as n_chars
    from z group by all
    """,
)
def src_header_row(spark, sf):
    """Cells are counted by place first; names meet the counts."""
    grids = document_grids(spark, sf)
    optional = G.has_optional_column(F.col("header"), OPTIONAL)
    counts = G.cells_long(grids, words, optional).groupBy("path", "place").agg(
        F.count("value").alias("n"), F.sum(F.length("value")).alias("chars")
    )
    named = G.with_place_names(counts, G.header_places(grids, optional))
    return named.groupBy(F.col("path").alias("doc_id"), F.lower("col_name").alias("col_name")).agg(
        F.sum("n").alias("n_values"), F.sum("chars").alias("n_chars")
    )


@query(
    "src_header_rejects",
    LINES
    + f"""
    select doc_id from lines group by doc_id
    having not coalesce(bool_or(regexp_matches(line, '{HEADER}')), false)
    """,
)
def src_header_rejects(spark, sf):
    return G.rejected(document_grids(spark, sf)).select(F.col("path").alias("doc_id"))


@query(
    "src_last_header",
    LINES
    + """
    select doc_id, coalesce(max(row_no) filter (contains(string_split(line, ' ')[1], 'tion')), 0)
      as header_row from lines group by doc_id
    """,
)
def src_last_header(spark, sf):
    of = L.splits(document_lines(spark, sf), {"mark": G.starts_with("tion", cells=words)})
    last = L.marked(of, "mark", last=True)
    return of.select("path").distinct().join(last, "path", "left").select(
        F.col("path").alias("doc_id"), F.coalesce("row_no", F.lit(0).cast("long")).alias("header_row")
    )


@query(
    "win_next_row_after_marker",
    LINES
    + """
    , n as (select *, lead(line) over (partition by doc_id order by row_no) as next from lines)
    select doc_id, row_no as marker_row, string_split(line, ' ')[1] as marker,
      array_to_string(string_split(next, ' '), ' ') as next_cells
    from n where contains(string_split(line, ' ')[1], 'tion')
    """,
)
def win_next_row_after_marker(spark, sf):
    found = G.next_rows(document_grids(spark, sf), "tion", ["path"], words).withColumnRenamed("path", "doc_id")
    return found.withColumn(
        "next_cells",
        F.when(
            F.col("next_cells").isNotNull(), F.concat_ws(" ", "next_cells")
        ),
    )


@query(
    "sink_roundtrip",
    """
    select event_type, cast(cast(ts as date) as varchar) as date, count(*) as n,
      round(sum(value), 4) as total from events group by all
    """,
)
def sink_roundtrip(spark, sf):
    """The whole table written as a stage by partition, read back with its schema."""
    events = table(spark, sf, "events").select(
        "event_id", "user_id", text_date("ts").alias("date"), "value", "event_type"
    )
    path = stage_path(spark, "events")
    write_stage(events, path, ["event_type"], ["user_id", "date"])
    back = read_stage(spark, path, events.schema)
    return back.groupBy("event_type", "date").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("value"), 4).alias("total")
    )


@query(
    "sink_csv_roundtrip",
    """
    select event_type, cast(cast(ts as date) as varchar) as date, count(*) as n, sum(length(props)) as n_chars
    from events group by all
    """,
)
def sink_csv_roundtrip(spark, sf):
    """The whole table through the CSV sink and back."""
    events = table(spark, sf, "events").select("event_id", "event_type", text_date("ts").alias("date"), "props")
    path = stage_path(spark, "events-csv")
    write_table_csv(events, path)
    back = spark.read.schema(events.schema).csv(path, header=True, escape="\\")
    return back.groupBy("event_type", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("props")).alias("n_chars")
    )


@query(
    "src_station_table",
    """
    select c_custkey % 1000000 as naps, 'S' || c_custkey as station, c_name as station_name, nullif(c_mktsegment, 'BUILDING') as city,
      cast(c_nationkey + 0.5 as double) as latitude, -c_acctbal as longitude, case when c_custkey % 4 = 0 then c_custkey + 1 end as combined_stations
    from customer
    """,
)
def src_station_table(spark, sf):
    """The customers as a station table in CSV, with the flag columns of pollutants, through the station reader."""
    customers = table(spark, sf, "customer")
    written = customers.select(
        F.col("c_custkey").alias("NAPS"), F.col("c_name").alias("Station Name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "-").otherwise(F.col("c_mktsegment")).alias("City"),
        (F.col("c_nationkey") + 0.5).alias("Latitude"), (-F.col("c_acctbal")).alias("Longitude"),
        F.lit("Y").alias("SO2"), F.lit("N").alias("NO2"), F.lit("Y").alias("PAH"),
        F.when(F.col("c_custkey") % 4 == 0, F.col("c_custkey") + 1).alias("Combined Stations"),
    )
    path = stage_path(spark, "stations-csv")
    write_table_csv(written, path)
    read = read_stations(spark, path)
    return read.select(
        F.col("naps").cast("long").alias("naps"), "station", "station_name", "city", "latitude", "longitude",
        F.col("combined_stations").cast("long").alias("combined_stations"),
    )


@query(
    "src_lookup_table",
    """
    select o_orderpriority as station, cast(count(*) as integer) as n_published from orders group by all
    """,
)
def src_lookup_table(spark, sf):
    """Counts by priority written as a table of published counts and read under its schema."""
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("station")).agg(F.count(F.lit(1)).alias("n_published"))
    path = stage_path(spark, "published-csv")
    write_table_csv(counts, path)
    return read_lookup(spark, "published_counts", path)


KINDS = {"click": "O3", "error": "SO2", "purchase": "NO2", "signup": "CO", "view": "NO"}
HOURLY_SQL = (
    "with h as (select case event_type "
    + " ".join(f"when '{k}' then '{v}'" for k, v in KINDS.items())
    + """ end as pollutant, user_id + 1 as napsid, cast(ts as date) as date, hour(ts) as hr, round(avg(value), 6) as v
        from events group by all)
    """
)


def hourly_text(spark, sf, broken=None) -> str:
    """The events as hourly text files, four of a pollutant and year, with the optional column in those of O3; their paths.

    broken: a condition under which the date of a row is no date.
    """
    wide = hour_wide(table(spark, sf, "events"))
    kind = F.expr("case pollutant " + " ".join(f"when '{k}' then '{v}'" for k, v in KINDS.items()) + " end")
    hours = [F.coalesce(r(h).cast("string"), F.lit("-999")) for h in HOUR_COLUMNS]
    rows = wide.withColumn("pollutant", kind).withColumn("napsid", F.col("napsid") + 1)
    method = F.when(F.col("pollutant") == "O3", F.lit("1"))
    line = F.concat_ws(
        ",", "pollutant", method, F.concat(F.lit('"'), F.lpad(F.col("napsid").cast("string"), 7, "0"), F.lit('"')),
        F.lit("Town,ON,45.5,-75.5"), F.when(F.lit(False) if broken is None else broken, "20240230").otherwise(F.date_format("date", "yyyyMMdd")), *hours,
    )
    data = rows.select(
        F.concat_ws("_", "pollutant", (F.col("napsid") % 4).cast("string"), F.year("date").cast("string")).alias("file"), F.lit(1).alias("at"), line.alias("value")
    )
    title = F.when(F.col("file").startswith("O3"), F.lit("Method"))
    head = data.select("file").distinct().select(
        "file", F.lit(0).alias("at"),
        F.concat_ws(",", F.lit("Pollutant"), title, F.lit("NAPS ID,City,P/T,Latitude,Longitude,Date"), *[F.lit(h) for h in HOUR_COLUMNS]).alias("value"),
    )
    path = stage_path(spark, "hourly-text")
    data.union(head).repartition("file").sortWithinPartitions("file", "at").drop("at").write.partitionBy("file").text(path)
    return f"{path}/*/*.txt"


def with_folder_year(rows):
    """The text writer names files by itself, so the declared year is that of the folder."""
    return rows.withColumn("declared_year", F.regexp_extract("source", r"_(\d{4})/[^/]*$", 1).cast("int"))


@query(
    "src_hourly_files",
    HOURLY_SQL
    + """
    select pollutant, cast(napsid as varchar) as napsid, cast(date as varchar) as date, year(date) as year,
      count(v) as n_hours, round(sum(v), 4) as total from h group by all
    """,
)
def src_hourly_files(spark, sf):
    """Text files with quoted cells, an optional column and missing codes through the hourly reader."""
    rows, _ = read_hourly(spark, hourly_text(spark, sf))
    present = [F.col(h).isNotNull().cast("long") for h in HOUR_COLUMNS]
    total = [F.coalesce(F.col(h), F.lit(0.0)) for h in HOUR_COLUMNS]
    return rows.select(
        "pollutant", "napsid", text_date("date").alias("date"), F.col("year").cast("long").alias("year"), sum(present[1:], present[0]).alias("n_hours"),
        r(sum(total[1:], total[0]), 4).alias("total"),
    )


@query(
    "dq_hourly_accepted",
    HOURLY_SQL
    + """
    , d as (select distinct pollutant, napsid, date, napsid % 20 = 8 as unknown, napsid % 20 = 5 and day(date) = 13 as broken from h),
    f as (select pollutant, napsid % 4 as grp, year(date) as year, count(*) as n_rows, count(*) filter (broken) as n_bad,
        count(*) filter (unknown) as n_unknown from d group by all)
    select 'file' as part, pollutant, grp, year, n_rows, n_bad as n_invalid_dates, n_unknown as n_unknown_stations,
      n_bad = 0 and n_unknown = 0 as accepted from f
    union all
    select 'accepted', d.pollutant, null, null, count(*), null, null, null from d join f on d.pollutant = f.pollutant
      and napsid % 4 = grp and year(date) = f.year where n_bad = 0 and n_unknown = 0 group by d.pollutant
    union all
    select 'invalid', pollutant, null, null, count(*), null, null, null from d where broken group by pollutant
    """,
)
def dq_hourly_accepted(spark, sf):
    """The file check with unknown stations and broken dates: the report of each file, the rows of accepted files, the rows set aside."""
    rows, _ = read_hourly(spark, hourly_text(spark, sf, (F.col("napsid") % 20 == 5) & (F.dayofmonth("date") == 13)))
    station = F.col("user_id") + 1
    known = table(spark, sf, "events").where(station % 20 != 8).select(station.cast("string").alias("napsid")).distinct()
    accepted, invalid, report = checked_hourly(with_folder_year(rows), known)
    name = F.split(F.regexp_extract("source", r"file=([^/]+)/", 1), "_")
    files = report.select(
        F.lit("file").alias("part"), name[0].alias("pollutant"), name[1].cast("long").alias("grp"), name[2].cast("long").alias("year"),
        "n_rows", "n_invalid_dates", "n_unknown_stations", "accepted",
    )
    counts = [
        df.groupBy("pollutant").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("part", F.lit(part))
        for part, df in (("accepted", accepted), ("invalid", invalid))
    ]
    return files.unionByName(counts[0], allowMissingColumns=True).unionByName(counts[1], allowMissingColumns=True)
