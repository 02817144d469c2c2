"""Project loads from folders of files: the same batches as from tables, and what was read of each file."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_projects import OPTICS, accp_batch, make, optics_row, species_dict  # noqa: F401

from foliar.plans.projects import accp, conifer, leaf_optics, nasa_hyspiri, yang_pheno


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def ledger(batch):
    return {(r.source, r.path): (r.lines, r.wrong_width, r.cells, r.missing, r.refused) for r in batch.ledger.collect()}


def same(a, b):
    assert set(a.tables()) == set(b.tables())
    for name, df in a.tables().items():
        columns = sorted(df.columns)
        assert rows(df.select(*columns)) == rows(b.tables()[name].select(*columns)), name


def test_accp(spark, make, tmp_path):  # noqa: F811
    write(tmp_path / "leafchem/achem.dat", "sampleid species site_id plot_id colldate nitrogen chloro_a water_th", "92BHX POGR BHI 1 920615 -999.0 2.0 0.01")
    write(tmp_path / "leafchem/bchem.dat", "sampleid,species,site_id,plot_id,colldate,lignin,leaf_wgt", "A1,USNEA,HF,NA,920616,20.0,3.0", "lonely,PIRE,JR,2,bad,21.0,oops")
    write(tmp_path / "leafchem/readme.txt", "no table")
    write(tmp_path / "leafspec/hf_f_sp.dat", "band wavelength 92BHX A1 92HFS19RO4", "1 400 0.5 -1 0.3", "2 402 0.6 0.7 0.3")
    write(tmp_path / "leafspec/map_d_sp.dat", "band wavelength M1", "1 400 0.2", "2 bad")
    write(tmp_path / "leafspec/jr_f_sp.dat", "band wavelength J1", "1 400 0.25")
    write(tmp_path / "leafspec/odd_sp.dat", "band wavelength Z", "1 400 0.9")
    b = accp.from_folder(spark, str(tmp_path))
    same(accp_batch(make), b)
    assert ledger(b) == {
        ("chemistry", "/achem.dat"): (1, 0, 8, 0, 0), ("chemistry", "/bchem.dat"): (2, 0, 14, 1, 0),
        ("spectra", "/hf_f_sp.dat"): (2, 0, 10, 0, 0), ("spectra", "/map_d_sp.dat"): (2, 1, 5, 0, 1),
        ("spectra", "/jr_f_sp.dat"): (1, 0, 3, 0, 0), ("spectra", "/odd_sp.dat"): (1, 0, 3, 0, 0),
    }


@pytest.mark.parametrize("project", ["angers", "lopex"])
def test_optics(spark, make, species_dict, tmp_path, project):  # noqa: F811
    data = [
        optics_row(1, "Acer rubrum L.", "an03r0001.txt", 1.0, None), optics_row(2, "Vitis vinifera L. (Sylvestris)", "an03r0002.txt", 2.0, 4.0),
        *([optics_row(3, "", "an03r0003.txt", None, 4.0)] if project == "lopex" else []),
    ]
    chem = make(OPTICS, *data)
    files = [("an03r0001.txt", "400.0", "0.5"), ("an03r0001.txt", "401.0", "0.6"), ("an03t0001.txt", "400.0", "0.1"), ("an03r0002.txt", "500.5", "0.7")]
    names = {r[4] for r in data} | {r[5] for r in data}
    for name in names:
        write(tmp_path / "spec" / name, *[f"{w}\t{v}" for f, w, v in files if f == name] or ["NA NA"])
    text = lambda x: "NA" if x is None else f'"{x}"' if isinstance(x, str) else str(x)
    head = [c for c in chem.columns if c != "line"]
    write(tmp_path / f"LDB_{project}{'2003' if project == 'angers' else '1993'}.csv", ",".join(head), *[",".join(text(v) for v in r[1:]) for r in data])
    points = make("fname string, wavelength double, spectravalue double", *[(f, float(w), float(v)) for f, w, v in files], *[(n, None, None) for n in names - {f for f, *_ in files}])
    build = getattr(leaf_optics, project)
    loaded = getattr(leaf_optics, f"{project}_from_folder")(spark, str(tmp_path), species_dict)
    same(build(chem if project == "lopex" else chem.drop("line"), points, species_dict), loaded)
    assert ledger(loaded)["spectra", "/an03r0001.txt"] == (2, 0, 4, 0, 0)
    (tmp_path / "spec/an03t0002.txt").unlink()
    with pytest.raises(ValueError, match="an03t0002.txt"):
        getattr(leaf_optics, f"{project}_from_folder")(spark, str(tmp_path), species_dict)


def test_conifer(spark, tmp_path):
    for name in ("sgf_oz/sgf_oz_top_s26.txt", "sgf_oz/sgf_oz_top_1d_s27.txt", "sqa_t1/sqa_t1_top_s1.txt", "elsewhere/sgf_oz_top_s3.txt"):
        write(tmp_path / name, *[f"{400 + 0.7 * i} {0.1 * i} {0.2 * i}" for i in range(6)])
    write(tmp_path / "all_pig.txt", "chla chlb tchl carot", "gf-oz2 gf-oz2 gf-oz2 gf-oz2", "1 2 3 4", "mk-rand mk-rand mk-rand mk-rand", "5 6 7 8")
    b = conifer.from_folder(spark, str(tmp_path))
    assert sorted(r.samplecode.split("|")[1] for r in b.samples.collect()) == ["gf-oz2-2-1", "mk-rand-1-1"]
    spectra = rows(b.spectra.where("samplecode like '%oz2%' and spectratype = 'reflectance'").select("wavelength", "spectravalue"))
    assert [w for w, _ in spectra] == [400.0, 401.0, 402.0, 403.0] and abs(spectra[1][1] - 0.1 / 0.7) < 1e-9
    assert set(ledger(b)) == {("spectra", f"/{n}") for n in ("sgf_oz/sgf_oz_top_s26.txt", "sqa_t1/sqa_t1_top_s1.txt", "elsewhere/sgf_oz_top_s3.txt")}
    assert b.ledger.agg(F.sum("lines"), F.sum("refused")).first()[:] == (18, 0)


def test_hyspiri(spark, make, tmp_path):  # noqa: F811
    root = tmp_path / "canopy_project"  # the folder's own path does not count
    write(root / "Spring2013/05202013/Processed/Averaged_Spectra.csv", "Spectra,Wave_350,Wave_351", "KING_Plot1_SP1_L1T_a_Refl,0.1,0.2", "KING_Soil_x_y_Refl,9,9")
    write(root / "Fall2014/20140915/processed/Averaged_Spectra.csv", "Wave_350.5,Spectra,Note", "bad,SHAF_Grape_Plot4_a_refl,n")
    write(root / "Fall2014/20140915/Canopy/Averaged_Spectra.csv", "Spectra,Wave_350", "KING_Plot1_SP1_L1T_a_Refl,0.7")
    write(root / "Fall2014/20140915/processed/Other.csv", "Spectra,Wave_350", "KING_Plot1_SP1_L1T_a_Refl,0.7")
    gps = make("Site string, Latitude double, Longitude double", ("Kingsburg", 36.0, -119.0))
    chn = make("Sample_Name string, Sample_Year int, Perc_C double, Perc_N double, Perc_H double", ("KING_Plot1_SP1_L1T", 2013, 40.0, 2.0, 6.0))
    b = nasa_hyspiri.from_folder(spark, str(root), gps, chn)
    spectra = [(r.samplecode, r.wavelength, r.spectravalue) for r in b.spectra.orderBy("wavelength").collect()]
    assert spectra == [
        ("nasa_hyspiri|KING_Plot1_SP1_L1T_Spring2013|2013", 350.0, 0.1), ("nasa_hyspiri|SHAF_Grape_Plot4_Fall2014|2014", 350.5, None),
        ("nasa_hyspiri|KING_Plot1_SP1_L1T_Spring2013|2013", 351.0, 0.2),
    ]
    assert ledger(b) == {
        ("spectra", "/Spring2013/05202013/Processed/Averaged_Spectra.csv"): (2, 0, 6, 0, 0),
        ("spectra", "/Fall2014/20140915/processed/Averaged_Spectra.csv"): (1, 0, 3, 0, 1),
    }
    assert b.traits.count() == 4
    write(root / "Fall2014/x/processed/Averaged_Spectra.csv", "Name,Wave_350", "a,1")
    with pytest.raises(ValueError, match="without"):
        nasa_hyspiri.from_folder(spark, str(root), gps, chn)


def test_pheno(spark, make, species_dict, tmp_path):  # noqa: F811
    write(tmp_path / "2011-MV/a.csv", "350,0.1,0.2", "0,1,1")
    write(tmp_path / "2011-MV/b.csv", "350,0.3,NA", "351,x,")
    cols = "`day of year` string, AU1 string, AL1 string, ` ` string"
    sheets = {s: make(cols, ("150", "1.5", "NA", "x"), ("170", "2.0", "3.0", "x")) for s in yang_pheno.SHEETS.values()}
    b = yang_pheno.from_folder(spark, str(tmp_path), sheets, species_dict, "MV", 2011)
    assert rows(b.spectra.drop("spectratype")) == [
        ("yang_pheno|AL1_150|2011", 350.0, 0.2), ("yang_pheno|AU1_150|2011", 350.0, 0.1), ("yang_pheno|AU1_170|2011", 350.0, 0.3),
    ]
    assert ledger(b) == {("reflectance", "/a.csv"): (2, 0, 6, 0, 0), ("reflectance", "/b.csv"): (2, 0, 6, 2, 1)}
