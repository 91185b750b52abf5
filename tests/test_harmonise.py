"""Small sheet files from both eras through to one wide row per station and date."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from hazeline.operators.joins import literal_table
from hazeline.operators.naming import canonical_names
from hazeline.operators.quality import duplicate_keys
from hazeline.plans import batch
from hazeline.plans import harmonise as Z
from hazeline.plans import sampler_timeline as T
from hazeline.sources import grid as G
from hazeline.sources import stages
from hazeline.sources.provenance import wanted_sheets

D1, D2, D3 = date(2012, 1, 1), date(2012, 1, 4), date(2009, 5, 1)


def put(folder, name, *lines):
    (folder / name).write_bytes("\n".join(lines).encode("latin1"))


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    new, old, mass = (tmp_path_factory.mktemp(n) for n in ("new", "old", "mass"))
    put(new, "2012_S60211_INT__Ions-Spec_IC.csv",
        "Medium,,,TF,TF,NF", "Sampler,,,S-1,S-1,S-1",
        "NAPS ID,Sampling Date,Sample Type,Nitrate,Nitrate MDL,Nitrate",
        "60211,40909,,1.5,0.1,2.5", "60211,40912,FB,0.2,0.1,0.3", "60211,bad,,9,9,9")
    put(new, "2012_S60211_INT__PM2.5.csv",
        "Sampler,,,S-2", "NAPS ID,Sampling Date,Sample Type,PM2.5", "60211,40909,R,8.5")
    put(new, "2012_S60211_INT__Station Info.csv",
        "Sampler # (S-1)", "Description,Speciation", "Sampler # (S-2)", "Description,Dichot")
    put(old, "2009_S60211_CARB.csv",
        "Carbon report", "Date,Cart,oc1,ec1,Flag", "2009-05-01,A,1,2,x", "2009-05-01,B,3,4,x",
        "2009-05-01,FB,7,8,x")
    put(old, "2009_S60427_CARB.csv", "Date,0,oc1", "2009-05-01,A,11")
    put(old, "2009_S60211_IC.csv",
        "Date,Media,Sulphate", "2009-05-01,T,5", "2009-05-01,N,6", "2009-05-01,,2", "2009-05-01,TB,4")
    put(old, "2009_S60211_ICPMS.csv",
        "Date,Fraction,Iron", "2009-05-01,C,21", "2009-05-01,F,22", "2009-05-01,,23")
    put(old, "2009_S60211_NA.csv", "Date,Media,Sodium", "2009-05-01,y,1.25")
    put(mass, "2012_S60211_PMDICHOT.csv",
        "Date,C_F,Mass,Iron,Iron d_l,Odd,Odd d_l", "2012-01-01,F,7,1,0.5,2,0.2",
        "2012-01-01,F,70,10,0.5,20,0.2", "2012-01-01,C,3,4,0.5,5,0.2", "2009-05-01,F,6,,0.5,,")
    header_dict = literal_table(
        spark, "file_type string, old_name string, new_name string, new_file_type string",
        [("CARB", "cart_A_oc1", "OC1_A", "OCEC"), ("IC", "TF_sulphate", "TF_Sulphate", "Ions-Spec_IC"),
         ("ICPMS", "iron", None, "Metals"), ("NA", "sodium", "Sodium", "Volatile")],
    )
    scheme = literal_table(
        spark, "old_name string, new_name string, mdl_name string, file_type string",
        [("iron", "iron_fe", "iron_fe_mdl", "Elements"), ("odd", None, None, None)],
    )
    grids = G.read_grids(spark, str(new))
    info = G.sampler_info(grids.where("sheet = 'Station Info'"))
    both = Z.mass_file_long(G.read_grids(spark, str(mass)), scheme, "dich", ("F", "C"))
    return {
        "dich": both, "dich_fine": both.where("fraction = 'F'"), "dich_coarse": both.where("fraction = 'C'"),
        "integrated": Z.integrated_long(grids.pick(wanted_sheets), info, "F"),
        "spec": Z.speciation_long(G.read_grids(spark, str(old)), header_dict),
    }


def cells(df, **where):
    rows = df.collect()
    return {
        (r.date, r.file_type, r.col_name): r.value
        for r in rows if all(r[k] == v for k, v in where.items())
    }


def test_integrated(sources):
    df = sources["integrated"]
    assert cells(df, is_blank=False, date=D1) == {
        (D1, "Ions-Spec_IC", "spec_tf_nitrate"): 1.5,
        (D1, "Ions-Spec_IC", "spec_tf_nitrate_mdl"): 0.1,
        (D1, "Ions-Spec_IC", "spec_nf_nitrate"): 2.5,
        (D1, "PM2.5", "dich_pm2_5"): 8.5,
    }
    assert cells(df, is_blank=True)[D2, "Ions-Spec_IC", "spec_tf_nitrate"] == 0.2


def test_speciation(sources):
    df = sources["spec"]
    samples = cells(df, is_blank=False, station="S60211", fraction="F")
    assert samples == {
        (D3, "OCEC", "spec_oc1_a"): 1.0, (D3, "OCEC", "spec_cart_a_ec1"): 2.0,
        (D3, "OCEC", "spec_cart_b_oc1"): 3.0, (D3, "OCEC", "spec_cart_b_ec1"): 4.0,
        (D3, "Ions-Spec_IC", "spec_tf_sulphate"): 5.0, (D3, "Ions-Spec_IC", "spec_nf_sulphate"): 6.0,
        # A row without a medium stays a sample.
        (D3, "Ions-Spec_IC", "spec_sulphate"): 2.0,
        (D3, "Metals", "spec_iron"): 22.0, (D3, "Volatile", "spec_sodium"): 1.25,
    }
    assert cells(df, fraction="C") == {(D3, "Metals", "spec_iron"): 21.0}
    assert cells(df, is_blank=True) == {
        (D3, "OCEC", "spec_oc1"): 7.0, (D3, "OCEC", "spec_ec1"): 8.0,
        (D3, "Ions-Spec_IC", "spec_tbf_sulphate"): 4.0,
    }
    # The cartridge of this station stands in an unnamed column.
    assert cells(df, station="S60427") == {
        (D3, "OCEC", "spec_oc1_a"): 11.0
    }


def test_mass_files(sources):
    assert cells(sources["dich_fine"]) == {
        (D1, "PM2.5", "dich_pm2_5"): 7.0, (D3, "PM2.5", "dich_pm2_5"): 6.0,
        (D1, "Elements", "dich_iron_fe"): 1.0, (D1, "Elements", "dich_iron_fe_mdl"): 0.5,
        (D3, "Elements", "dich_iron_fe_mdl"): 0.5,
        (D1, "No file", "dich_odd"): 2.0, (D1, "No file", "dich_odd_mdl"): 0.2,
    }
    coarse = cells(sources["dich_coarse"])
    assert coarse[D1, "PM2.5-10", "dich_pm2_5_10"] == 3.0
    assert coarse[D1, "Elements", "dich_iron_fe"] == 4.0


def test_merge_and_widen(spark, sources):
    short = literal_table(
        spark, "file_type string, short_name string",
        [("Ions-Spec_IC", "Ions_IC"), ("Elements", "EDXRF")],
    )
    merged, aside = Z.merge_long(Z.parsed_rows([sources["dich"], sources["integrated"], sources["spec"]]), short)
    assert aside.select("col_name").distinct().count() == 3  # the row without a date
    fine = merged.where("fraction = 'F' and not is_blank")
    got = cells(fine, station="S60211")
    # Both sources have this cell; the first in order wins.
    assert got[D1, "PM2.5", "dich_pm2_5"] == 7.0
    assert got[D1, "Ions-Spec_IC", "Ions_IC_spec_tf_nitrate"] == 1.5
    wide = Z.widen(fine, ["dich_pm2_5", "Ions_IC_spec_tf_nitrate", "EDXRF_dich_iron_fe"])
    assert duplicate_keys(wide, ["station", "date"]).count() == 0
    row = wide.where(F.col("date") == D1).first()
    assert (row.year, row.dich_pm2_5, row.Ions_IC_spec_tf_nitrate, row.EDXRF_dich_iron_fe) == (
        2012, 7.0, 1.5, 1.0
    )
    table = canonical_names(fine.select(F.col("col_name").alias("old_name")).distinct())
    canon = {r.col_name for r in Z.select_canonical(fine, table).collect()}
    assert {"spec.IC.TF.nitrate", "spec.IC.NF.nitrate", "dich.EDXRF.TF.iron_fe"} <= canon


def test_blanks_keep_their_own_rows(spark, sources):
    merged, _ = Z.merge_long(
        Z.parsed_rows([sources["spec"], sources["integrated"]]),
        literal_table(spark, "file_type string, short_name string", [("x", "y")]),
    )
    blanks = merged.where("is_blank")
    total = merged.count()
    assert blanks.count() + merged.where("not is_blank").count() == total
    assert {r.date for r in blanks.collect()} == {D2, D3}


def test_batch_run(spark, sources, tmp_path, tmp_path_factory):
    base = tmp_path_factory.getbasetemp()
    found = {n: sorted(base.glob(f"{n}[0-9]*"))[0] for n in ("new", "old", "mass")}
    look = tmp_path / "look"
    look.mkdir()
    (look / "dict.csv").write_text(
        "file_type,old_name,new_name,new_file_type,col_type\nCARB,cart_A_oc1,OC1_A,OCEC,num\n"
    )
    (look / "scheme.csv").write_text(
        "old_name,new_name,mdl_name,file_type\niron,iron_fe,iron_fe_mdl,Elements\n"
    )
    (look / "short.csv").write_text("file_type,short_name\nElements,EDXRF\nOCEC,OCEC\n")
    empty = tmp_path / "empty"
    empty.mkdir()
    put(empty, "2012_S1_X.csv", "nothing here")
    folders = batch.Folders(
        integrated_fine=str(found["new"]), integrated_coarse=str(empty),
        speciation=str(found["old"]), mass=str(empty), dichotomous=str(found["mass"]),
        header_dict=str(look / "dict.csv"), part_scheme=str(look / "scheme.csv"),
        file_type_short=str(look / "short.csv"),
    )
    target = str(tmp_path / "out")

    # the first run dies when it writes the merged table
    def dies(self, name, *args, write=stages.Run.stage, **more):
        if name == "merged":
            raise RuntimeError("killed")
        return write(self, name, *args, **more)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(stages.Run, "stage", dies)
        with pytest.raises(RuntimeError, match="killed"):
            batch.run(spark, folders, target)
    left = tmp_path / "out" / "tables"
    (left / "merged-half").mkdir()
    (left / "merged-half" / "part-0.parquet").write_bytes(b"half")
    # the second one goes on behind the parsed rows and reads no sheet
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(batch, "read_grids", None)
        tables = batch.run(spark, folders, target)
        assert sorted(p.name.rsplit("-", 1)[0] for p in left.iterdir()) == ["merged", "parsed", "quarantine", "rejects"]
        again = batch.run(spark, folders, target)["merged"]  # nothing is made anew
        assert again.inputFiles() == tables["merged"].inputFiles()
    merged = tables["merged"]
    assert merged.where("col_name = 'OCEC_spec_oc1_a' and value = 1.0").count() == 1
    assert merged.where("fraction = 'C' and col_name = 'dich_pm2_5_10'").first().value == 3.0
    assert duplicate_keys(
        merged, ["station", "date", "fraction", "is_blank", "file_type", "col_name"]
    ).count() == 0
    rejects = {r.path.rsplit("/", 1)[1] for r in tables["rejects"].collect()}
    assert rejects == {"2012_S1_X.csv"}
    names = batch.write_canonical_names(spark, merged, f"{target}/names")
    assert "spec.TOR.QF.oc1_a" in {r.new_name for r in names.collect()}
    # another file makes another key, and the old tables go
    put(empty, "2012_S2_X.csv", "nothing here either")
    later = batch.run(spark, folders, target)
    assert {r.path.rsplit("/", 1)[1] for r in later["rejects"].collect()} == {"2012_S1_X.csv", "2012_S2_X.csv"}
    assert later["merged"].inputFiles() != merged.inputFiles() and len(list(left.iterdir())) == 4


def test_sampler_dictionary(spark, tmp_path):
    put(tmp_path, "2004_S60211_PM.csv", "Partisol sampler at Windsor,x", "Date,y")
    put(tmp_path, "2012_S60211_INT__Station Info.csv", "Sampler # (S-1),x", "Description,Speciation")
    grids = G.read_grids(spark, str(tmp_path))
    both = T.sampler_dictionary(
        T.file_samplers(grids.where("sheet is null"), "PMPART25", "PM"),
        T.sheet_samplers(grids.where("sheet is not null"), "Integrated"),
    )
    got = {(r.sampler, r.year, r.type, r.sampler_num) for r in both.collect()}
    assert got == {("Partisol sampler", 2004, "PM", None), ("Speciation", 2012, "Spec", "S-1")}
