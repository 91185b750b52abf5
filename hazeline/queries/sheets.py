"""The harmonisation flow on sheets: the tables written as text files of both eras, read back, parsed and merged.

Line items become 2010+ sheets, orders dichotomous and mass files, events speciation files; every row of a table is a row of a file.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hazeline.operators.joins import literal_table
from hazeline.plans import batch, harmonise
from hazeline.queries.base import query, table, text_date
from hazeline.sources.grid import read_grids, rejected
from hazeline.sources.provenance import file_name, wanted_sheets
from hazeline.sources.stages import stage_path

EPOCH = "1899-12-30"


def text(column: str):
    return F.col(column).cast("string")


def named(*parts):
    """One text of texts and numbers, a missing one as null; formatting every row's file name is far slower."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def write_sheets(spark, rows, heads, name: str) -> str:
    """rows: (file, place, value) in the order of place, an array of numbers; heads: (file, lines) put above them. Returns the folder."""
    above = heads.distinct().select("file", F.posexplode("lines").alias("i", "value")).select(
        "file", F.array(F.lit(-1), F.col("i")).cast("array<long>").alias("place"), "value"
    )
    below = rows.select("file", F.col("place").cast("array<long>").alias("place"), "value")
    path = stage_path(spark, name)
    (
        below.unionByName(above).repartition("file").sortWithinPartitions("file", "place").drop("place")
        .write.partitionBy("file").text(path)
    )
    return path


# 2010+ sheets. Stations S1 to S20; those whose number divides by 3 have no station-info sheet, those that divide by 10 no header in the mass sheet.
INTEGRATED_SQL = """
    li as (select l_suppkey % 20 + 1 as n, cast(l_shipdate as date) as d, l_orderkey, l_linenumber, l_suppkey, l_orderkey % 97 = 0 as bad,
        l_partkey % 10 < 2 as is_blank, l_linenumber % 2 = 1 as ions, l_quantity, l_tax, l_discount, l_extendedprice, l_partkey from lineitem),
    ln as (select *, row_number() over (partition by n, year(d), ions order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)
        + case when ions then 4 else 3 end as row_no from li),
    lc as (select *, case when ions then 'Ions-Spec_IC' else 'PM2.5' end as file_type, unnest(case when ions then
        [{'s': 'spec_', 'c': 'tf_nitrate', 'v': case when l_partkey % 7 = 0 then null else l_quantity end},
         {'s': 'spec_', 'c': 'tf_nitrate_mdl', 'v': l_tax}, {'s': 'dich_', 'c': 'nf_nitrate', 'v': l_discount}]
        else [{'s': 'dich_', 'c': 'pm2_5', 'v': l_extendedprice}] end) as x from ln where ions or n % 10 <> 0),
    integrated as (select 'S' || n as station, case when bad then null else d end as date, row_no, 'F' as fraction, is_blank, file_type,
        case when n % 3 <> 0 then x.s else '' end || x.c as col_name, cast(x.v as double) as value, l_orderkey, l_linenumber
        from lc where x.v is not null)
"""


def integrated_sheets(spark, sf) -> str:
    ions = F.col("l_linenumber") % 2 == 1
    n = F.col("l_suppkey") % 20 + 1
    date = F.when(F.col("l_orderkey") % 97 == 0, F.lit("unknown")).otherwise(
        F.date_diff(F.to_date("l_shipdate"), F.to_date(F.lit(EPOCH))).cast("string")
    )
    kind = F.expr("case l_partkey % 10 when 0 then 'FB' when 1 then 'TB' when 2 then '' else 'R' end")
    nitrate = F.when(F.col("l_partkey") % 7 == 0, F.lit("-999")).otherwise(text("l_quantity"))
    values = F.when(ions, F.concat_ws(",", nitrate, text("l_tax"), text("l_discount"))).otherwise(text("l_extendedprice"))
    rows = table(spark, sf, "lineitem").select(
        n.alias("n"), F.year("l_shipdate").alias("year"), F.when(ions, "Ions-Spec_IC").otherwise("PM2.5").alias("sheet"),
        F.array("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_extendedprice") * 100).cast("long")).alias("place"),
        F.concat_ws(",", F.concat(F.lit('"'), n.cast("string"), F.lit('"')), date, kind, values).alias("value"),
    ).withColumn("file", named(F.col("year"), "_S", F.col("n"), "_INT__", F.col("sheet"), ".csv"))
    files = rows.select("file", "n", "year", "sheet").distinct()
    title, lead = F.lit("Sheet of a station,,"), "NAPS ID,Sampling Date,Sample Type,"
    plain = F.col("sheet") == "PM2.5"
    sheets = files.select("file", F.when(
        plain & (F.col("n") % 10 == 0), F.array(title, F.lit("Sampler,,,S-2"), F.lit("a,b,c,d")),
    ).when(
        plain, F.array(title, F.lit("Sampler,,,S-2"), F.lit(f"{lead}PM2.5")),
    ).otherwise(F.array(
        title, F.lit("Medium,N/A,N/A,TF,TF,NF"), F.lit("Sampler,,,S-1,S-1,S-2"), F.lit(f"{lead}Nitrate,Nitrate MDL,Nitrate"),
    )).alias("lines"))
    info = files.where("n % 3 <> 0").select(named(F.col("year"), "_S", F.col("n"), "_INT__Station Info.csv").alias("file"), F.array(*map(F.lit, [
        "Site,x", "Sampler # (S-1),x", "Description,Speciation sampler", "Sampler # (S-2),x", "Description,Dichotomous sampler",
    ])).alias("lines"))
    return write_sheets(spark, rows, sheets.union(info), "integrated-sheets")


@query(
    "pipe_integrated_sheets",
    f"with {INTEGRATED_SQL} select station, cast(date as varchar) as date, row_no, is_blank, file_type, col_name, value from integrated",
)
def pipe_integrated_sheets(spark, sf):
    """2010+ sheets: header search, marker rows, sampler dictionary and serial dates, every cell as a long row."""
    long = batch.integrated(read_grids(spark, integrated_sheets(spark, sf)), "F")
    return long.select("station", text_date("date").alias("date"), "row_no", "is_blank", "file_type", "col_name", "value")


# Mass files: a station and year each; the mass, then pairs of value and limit.
MASS_SQL = """
    o as (select 'S' || (o_custkey % 20 + 1) as station, cast(o_orderdate as date) as date, o_orderkey,
        case o_orderstatus when 'F' then 'F' when 'O' then 'C' else 'X' end as fraction, o_totalprice as mass,
        case when o_orderkey % 3 = 0 then null else o_orderkey % 100 + 0.5 end as iron, 0.25 as iron_mdl,
        case when o_orderkey % 5 = 0 then null else o_custkey * 1.0 end as odd, 0.125 as odd_mdl from orders),
    orow as (select *, row_number() over (partition by station, year(date) order by o_orderkey) + 2 as row_no from o),
    ofirst as (select *, row_number() over (partition by station, date, fraction order by o_orderkey) as k from orow),
    om as (select *, unnest([{'sampler': 'dich', 'f': 'F'}, {'sampler': 'dich', 'f': 'C'}, {'sampler': 'spec', 'f': 'F'}]) as w from ofirst),
    ow as (select *, w.sampler as sampler, case w.f when 'F' then 'PM2.5' else 'PM2.5-10' end as pm from om
        where w.f = fraction and (w.sampler = 'spec' or k = 1)),
    oc as (select *, unnest([
        {'t': pm, 'c': case w.sampler || w.f when 'dichC' then 'dich_pm2_5_10' else w.sampler || '_pm2_5' end, 'v': cast(mass as double)},
        {'t': 'Elements ' || pm, 'c': sampler || '_iron_fe', 'v': cast(iron as double)},
        {'t': 'Elements ' || pm, 'c': sampler || '_iron_fe_mdl', 'v': cast(iron_mdl as double)},
        {'t': 'No file', 'c': sampler || '_odd', 'v': cast(odd as double)},
        {'t': 'No file', 'c': sampler || '_odd_mdl', 'v': cast(odd_mdl as double)}]) as x from ow),
    mass as (select sampler, station, date, row_no, fraction, false as is_blank, x.t as file_type, x.c as col_name, x.v as value
        from oc where x.v is not null)
"""


def mass_sheets(spark, sf) -> str:
    fraction = F.expr("case o_orderstatus when 'F' then 'F' when 'O' then 'C' else 'X' end")
    cells = [
        F.date_format("o_orderdate", "yyyy-MM-dd"), fraction, text("o_totalprice"),
        F.expr("case when o_orderkey % 3 = 0 then '-' else concat(o_orderkey % 100, '.5') end"), F.lit("0.25"),
        F.expr("case when o_orderkey % 5 = 0 then '' else concat(o_custkey, '.0') end"), F.lit("0.125"),
    ]
    rows = table(spark, sf, "orders").select(
        named(F.year("o_orderdate"), "_S", F.col("o_custkey") % 20 + 1, "_PMDICHOT.csv").alias("file"),
        F.array("o_orderkey").alias("place"), F.concat_ws(",", *cells).alias("value"),
    )
    head = F.array(F.lit("Dichotomous sampler at Town"), F.lit("Date,C_F,Mass,Iron,Iron d_l,Odd,Odd d_l"))
    return write_sheets(spark, rows, rows.select("file", head.alias("lines")), "mass-sheets")


def scheme(spark):
    return literal_table(
        spark, "old_name string, new_name string, mdl_name string, file_type string",
        [("iron", "iron_fe", "iron_fe_mdl", "Elements PM2.5"), ("odd", None, None, None)],
    )


@query(
    "pipe_mass_files",
    f"with {MASS_SQL} select sampler, station, cast(date as varchar) as date, row_no, fraction, file_type, col_name, value from mass",
)
def pipe_mass_files(spark, sf):
    """Pre-2010 mass files read as those of either sampler: pairs of value and limit, both fractions in one pass."""
    grids = read_grids(spark, mass_sheets(spark, sf))
    both = [
        harmonise.mass_file_long(grids, scheme(spark), sampler, fractions).withColumn("sampler", F.lit(sampler))
        for sampler, fractions in (("dich", ("F", "C")), ("spec", ("F",)))
    ]
    return both[0].unionByName(both[1]).select(
        "sampler", "station", text_date("date").alias("date"), "row_no", "fraction", "file_type", "col_name", "value"
    )


# Speciation files. Station and file type by user and event type; some stations have the known faults.
STATIONS = ("S60211", "S60427", "S100702", "S70301", "S11", "S12")
TYPES = {"click": "CARB", "error": "IC", "purchase": "ICPMS", "signup": "NA", "view": "WICPMS"}
DICTIONARY = (
    ("CARB", "cart_A_oc1", "OC1_A", "OCEC"), ("IC", "TF_sulphate", "TF_Sulphate_new", "Ions-Spec_IC"),
    ("ICPMS", "iron", None, "Metals"), ("NA", "sodium", "Sodium", "Volatile"),
)
_CASES = {
    "station": "case user_id % 6 " + " ".join(f"when {i} then '{s}'" for i, s in enumerate(STATIONS)) + " end",
    "ft": "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in TYPES.items()) + " end",
    "cart": "case event_id % 4 when 0 then 'A' when 1 then 'B' when 2 then 'FB' else '' end",
    "media": "case event_id % 4 when 0 then 'T' when 1 then 'N' when 2 then 'TB' else '' end",
    "fr": "case event_id % 3 when 0 then 'F' when 1 then 'C' else '' end",
}
SPECIATION_SQL = f"""
    e as (select event_id, cast(ts as date) as date, value, event_id % 1000 / 8 as other, {_CASES['station']} as station, {_CASES['ft']} as ft,
        nullif({_CASES['cart']}, '') as cart, nullif({_CASES['media']}, '') as media, nullif({_CASES['fr']}, '') as fr from events),
    er as (select *, row_number() over (partition by station, year(date), ft order by event_id) + 1 as row_no,
        case when ft = 'CARB' and station <> 'S60427' then cart in ('FB') when ft = 'IC' then media in ('TB') end as blank,
        case ft when 'ICPMS' then fr when 'WICPMS' then case when station in ('S11', 'S12') then fr else 'F' end else 'F' end as fraction from e),
    ec as (select *, coalesce(blank, false) as is_blank, unnest(case ft
        when 'CARB' then [{{'c': 'oc1', 'v': value}}, {{'c': case when station = 'S60211' then 'speciation_mass_ug_m3' else 'mas_sp' end, 'v': other}}]
        when 'IC' then [{{'c': 'sulphate', 'v': value}}, {{'c': 'nitrate', 'v': other}}]
        when 'ICPMS' then [{{'c': 'iron', 'v': value}}, {{'c': case when station = 'S100702' then null else 'na_total' end, 'v': other}}]
        when 'NA' then [{{'c': 'sodium', 'v': value}}]
        else [{{'c': case when station = 'S70301' then 'mass_ug_m3' else 'mass' end, 'v': value}}] end) as x from er where fraction in ('F', 'C')),
    eg as (select *, case when ft = 'CARB' and not is_blank and cart is not null and x.c in ('oc1', 'speciation_mass_ug_m3')
        then 'cart_' || cart || '_' || x.c when ft = 'IC' and media is not null then media || 'F_' || x.c else x.c end as name
        from ec where x.c is not null and x.v is not null),
    speciation as (select station, date, row_no, fraction, is_blank,
        case ft when 'CARB' then 'OCEC' when 'IC' then 'Ions-Spec_IC' when 'ICPMS' then 'Metals' when 'NA' then 'Volatile' else ft end as file_type,
        'spec_' || lower(case when ft = 'CARB' and name = 'cart_A_oc1' then 'OC1_A' when ft = 'IC' and name = 'TF_sulphate' then 'TF_Sulphate_new'
        else name end) as col_name, cast(x.v as double) as value from eg)
"""


def speciation_sheets(spark, sf) -> str:
    events = table(spark, sf, "events").select(
        "event_id", F.to_date("ts").alias("date"), F.coalesce(text("value"), F.lit("-")).alias("value"), (F.col("event_id") % 1000 / 8).cast("string").alias("other"),
        *[F.expr(case).alias(name) for name, case in _CASES.items()],
    )
    ft, station = F.col("ft"), F.col("station")
    coded = ~ft.isin("WICPMS") | station.isin("S11", "S12")
    code = F.when(ft == "CARB", F.col("cart")).when(ft == "IC", F.col("media")).when(ft == "NA", F.lit("y")).otherwise(F.col("fr"))
    second = F.when(~ft.isin("NA", "WICPMS"), F.col("other"))
    rows = events.select(
        named(F.year("date"), "_", F.col("station"), "_", F.col("ft"), ".csv").alias("file"), "ft", "station", F.array("event_id").alias("place"),
        F.concat_ws(",", F.date_format("date", "yyyy-MM-dd"), F.when(coded, code), "value", second, F.lit("V0")).alias("value"),
    )
    names = (
        F.when((ft == "CARB") & (station == "S60427"), "Date,0,oc1,Mas Sp,Flag").when(ft == "CARB", "Date,Cart,oc1,Mas Sp,Flag")
        .when(ft == "IC", "Date,Media,Sulphate,Nitrate,Flag").when(ft == "ICPMS", "Date,Fraction,Iron,Na total,Flag")
        .when(ft == "NA", "Date,Media,Sodium,Flag").when(coded, "Date,F_C,Mass,Flag").otherwise("Date,Mass,Flag")
    )
    return write_sheets(spark, rows, rows.select("file", F.array(names).alias("lines")), "speciation-sheets")


def dictionary(spark):
    return literal_table(spark, "file_type string, old_name string, new_name string, new_file_type string", DICTIONARY)


@query(
    "pipe_speciation_files",
    f"""with {SPECIATION_SQL} select station, cast(date as varchar) as date, row_no, fraction, is_blank, file_type, col_name, value
    from speciation""",
)
def pipe_speciation_files(spark, sf):
    """Pre-2010 speciation files: cartridges and media in the names, known faults mended, the header dictionary."""
    long = harmonise.speciation_long(read_grids(spark, speciation_sheets(spark, sf)), dictionary(spark))
    return long.select("station", text_date("date").alias("date"), "row_no", "fraction", "is_blank", "file_type", "col_name", "value")


@query(
    "pipe_merged_files",
    f"""
    with {INTEGRATED_SQL}, {MASS_SQL}, {SPECIATION_SQL},
    u as (select 0 as prio, station, date, row_no, fraction, is_blank, file_type, col_name, value from mass where sampler = 'dich'
        union all select 1, station, date, row_no, fraction, is_blank, file_type, col_name, value from integrated
        union all select 2, station, date, row_no, fraction, is_blank, file_type, col_name, value from speciation),
    m as (select station, date, fraction, is_blank, file_type, col_name, arg_min(value, (prio, row_no)) as value
        from u where date is not null group by all)
    select 'merged' as part, station, cast(date as varchar) as date, fraction, is_blank, file_type,
        case file_type when 'Ions-Spec_IC' then 'Ions_IC_' when 'Elements PM2.5' then 'EDXRF_' else '' end || col_name as col_name, value from m
    union all
    select 'quarantine', station, null, fraction, is_blank, file_type, col_name, value from u where date is null
    union all
    select 'rejects', year(d) || '_S' || n || '_INT__PM2.5.csv', null, null, null, null, null, null
    from ln where not ions and n % 10 = 0 group by n, year(d)
    """,
)
def pipe_merged_files(spark, sf):
    """Files of all kinds parsed once: the merged table, the rows set aside and the files without a header."""
    grids = read_grids(spark, integrated_sheets(spark, sf))
    parsed = harmonise.parsed_rows([
        harmonise.mass_file_long(read_grids(spark, mass_sheets(spark, sf)), scheme(spark), "dich", ("F", "C")),
        batch.integrated(grids, "F"),
        harmonise.speciation_long(read_grids(spark, speciation_sheets(spark, sf)), dictionary(spark)),
    ])
    short = literal_table(spark, "file_type string, short_name string", [("Ions-Spec_IC", "Ions_IC"), ("Elements PM2.5", "EDXRF")])
    merged, aside = harmonise.merge_long(parsed, short)
    columns = ["part", "station", "date", "fraction", "is_blank", "file_type", "col_name", "value"]
    rows = merged.withColumn("part", F.lit("merged")).select(columns).unionByName(aside.withColumn("part", F.lit("quarantine")).select(columns))
    without = rejected(grids.pick(wanted_sheets)).select(F.lit("rejects").alias("part"), file_name(F.col("path")).alias("station"))
    return rows.withColumn("date", text_date("date")).unionByName(without, allowMissingColumns=True)
