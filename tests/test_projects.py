"""Project loads on small literal tables with the edge rows of each layout."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from foliar.plans import reference_data
from foliar.plans.batch import Contact, load
from foliar.plans.build import audits, build_catalog, export, reports
from foliar.plans.projects import (
    accp,
    conifer,
    foster_beetle,
    leaf_optics,
    nasa_fft,
    nasa_hyspiri,
    ngee_arctic,
    ngee_tropics,
    wu_brazil,
    yang_pheno,
)
from foliar.session import small_table
from foliar.sources.catalog import Catalog

DICT = [
    ("ACRU", "nasa_fft", "ACRU"),
    ("Quercus rubra", "yang_pheno", "QURU"),
    ("Acer rubrum L.", "lopex", "ACRU"),
    ("Acer rubrum L.", "angers", "ACRU"),
    ("SAPU", "ngee_arctic", "SAPU"),
    ("Ficus", "ngee_tropics", "FICUS"),
]


@pytest.fixture()
def make(spark):
    return lambda schema, *data: small_table(spark, schema, list(data))


@pytest.fixture()
def species_dict(make):
    return make("speciesdatacode string, projectcode string, speciescode string", *DICT)


def lines(make, *files):
    data = [(f, 0, i, text) for f, *texts in files for i, text in enumerate(texts)]
    return make("file string, block int, row bigint, value string", *data)


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def accp_batch(make):
    chem = [
        make(
            "sampleid string, species string, site_id string, plot_id int, colldate string, nitrogen double, chloro_a double, water_th double",
            ("92BHX", "POGR", "BHI", 1, "920615", -999.0, 2.0, 0.01),
        ),
        make(
            "sampleid string, species string, site_id string, plot_id int, colldate string, lignin double, leaf_wgt double",
            ("A1", "USNEA", "HF", None, "920616", 20.0, 3.0),
            ("lonely", "PIRE", "JR", 2, "bad", 21.0, 3.0),
        ),
    ]
    spec = lines(
        make,
        ("/s/hf_f_sp.dat", "band wavelength 92BHX A1 92HFS19RO4", "1 400 0.5 -1 0.3", "2 402 0.6 0.7 0.3"),
        ("/s/map_d_sp.dat", "band wavelength M1", "1 400 0.2"),
        ("/s/jr_f_sp.dat", "band wavelength J1", "1 400 0.25"),
        ("/s/odd.dat", "band wavelength Z", "1 400 0.9"),
    )
    return accp.build(chem, spec)


def test_accp(make):
    b = accp_batch(make)
    # The spectra file's BH becomes BHI, the chemistry sample keeps its name.
    codes = as_dict(b.samples, "samplecode", "speciescode")
    assert codes == {
        "accp|92BHX|1992": "POSE",
        "accp|92BHIX|NA": None,
        "accp|A1|1992": "USNEA2",
        "accp|lonely|NA": "PIRE",
        "accp|M1_dry|NA": "ACMA3",
        "accp|J1|NA": None,
    }
    assert {(r.samplecode, r.trait): r.traitvalue for r in b.traits.collect()} == {
        ("accp|92BHX|1992", "leaf_chla_pct_mass"): 0.2,
        ("accp|92BHX|1992", "leaf_water_thickness"): 0.1,
        ("accp|A1|1992", "leaf_lignin_pct_mass"): 20.0,
        ("accp|lonely|NA", "leaf_lignin_pct_mass"): 21.0,
    }
    spectra = rows(b.spectra)
    assert [(s, k, p, w) for s, k, p, w, _ in spectra] == [
        ("accp|92BHIX|NA", "pseudo-absorbance", "fresh", 400.0),
        ("accp|92BHIX|NA", "pseudo-absorbance", "fresh", 402.0),
        ("accp|A1|1992", "pseudo-absorbance", "fresh", 402.0),
        ("accp|J1|NA", "reflectance", "fresh", 400.0),
        ("accp|M1_dry|NA", "pseudo-absorbance", "dry", 400.0),
    ]
    assert as_dict(b.spectra_info, "samplecode", "method_tag")["accp|M1_dry|NA"] == "seedling"
    assert as_dict(b.plots, "plotcode", "latitude")["accp.BHI.1"] == 43.6333


OPTICS = (
    "line int, `Latin Name` string, `Plant Type` string, `English Name` string, Refl_file string, Trans_file string, "
    "C_a double, C_b double, C_ab double, C_car double, C_anth double, EWT double, LMA double, C_C double, C_H double, "
    "C_O double, C_N double, C_prot1 double, C_prot2 double, C_cell1 double, C_cell2 double, C_lign1 double, C_lign2 double, "
    "C_star1 double, C_star2 double"
)


def optics_row(n, name, refl, star1, star2):
    return (n, name, "t", "e", refl, refl.replace("r", "t"), *[100.0] * 4, -999.0, 0.01, 0.02, 40.0, 6.0, 40.0, 0.0,
            *[1.0, 3.0] * 3, star1, star2)


def optics_points(make):
    data = [("an03r0001.txt", 400.0, 0.1), ("an03t0001.txt", 400.0, 0.4), ("an03t0001.txt", 401.0, 0.5), ("extra.txt", 1.0, 1.0)]
    return make("fname string, wavelength double, spectravalue double", *data)


def test_lopex(make, species_dict):
    chem = make(
        OPTICS,
        optics_row(1, "Acer rubrum L.", "an03r0001.txt", 5.0, -999.0),
        optics_row(2, "", "x2.txt", -999.0, 7.0),
        optics_row(3, "Vitis vinifera ssp. Sylvestris", "x3.txt", 1.0, 3.0),
    )
    points = optics_points(make).withColumn("fname", F.regexp_replace("fname", "an03t", "an03t"))
    b = leaf_optics.lopex(chem, points, species_dict)
    assert as_dict(b.samples, "samplecode", "speciescode") == {
        "lopex|Ace-rub_Leaf01|1993": "ACRU",
        "lopex|Ace-rub_Leaf02|1993": "ACRU",
        "lopex|Vit-vin-syl_Leaf03|1993": None,
    }
    traits = {(r.samplecode[-11:-5], r.trait): r.traitvalue for r in b.traits.collect()}
    assert traits[("Leaf01", "leaf_starch_pct_mass")] == 5.0
    assert traits[("Leaf02", "leaf_starch_pct_mass")] == 7.0
    assert traits[("Leaf03", "leaf_starch_pct_mass")] == 2.0
    assert traits[("Leaf01", "leaf_protein_pct_mass")] == 2.0
    assert ("Leaf01", "leaf_CN_ratio_mass") not in traits and ("Leaf01", "leaf_anth_per_area") not in traits
    assert abs(traits[("Leaf01", "leaf_chla_per_area")] - 1e-3) < 1e-12
    kinds = [(r.spectratype, r.wavelength) for r in b.spectra.collect()]
    assert sorted(kinds) == [("reflectance", 400.0), ("transmittance", 400.0), ("transmittance", 401.0)]
    assert as_dict(b.trait_info, "trait", "unit")["leaf_chla_per_area"] == "kg m-2"


def test_angers(make, species_dict):
    chem = make(OPTICS, optics_row(1, "Acer rubrum L.", "an03r0001.txt", 5.0, -999.0)).drop("line")
    b = leaf_optics.angers(chem, optics_points(make), species_dict)
    assert as_dict(b.samples, "samplecode", "speciescode") == {"angers|Ace-rub_0001|2003": "ACRU"}
    assert b.spectra.count() == 3


def test_conifer(make):
    grid = [350.5, 351.7, 352.9, 354.2, 356.0]
    names = ["sgf_oz/sgf_oz_top_s26", "sgf_oz/sgf_oz_top_s3", "sgf_oz1/sgf_oz1_top_s1", "sgf_gr/sgf_gr_1d_top_s1", "sqa_t2/sqa_t2_top_s1"]
    points = make(
        "specfile string, wavelength double, reflectance double, transmittance double",
        *[(f"/d/{n}.txt", w, w / 1000, 1 - w / 1000) for n in names for w in grid],
    )
    pigments = lines(
        make,
        ("all_pig.txt", "chla chlb tchl carot", "gf-oz1 gf-oz1 gf-oz1 gf-oz1", "1 2 3 NA", "mk-rand mk-rand mk-rand mk-rand",
         *["5 5 5 5"] * 33),
    )
    b = conifer.build(points, pigments)
    codes = as_dict(b.samples, "samplecode", "plotcode")
    assert "divittorio_conifer|gf-oz1-1-1|2009" in codes  # file s3 and the first oz1 row are one sample
    assert "divittorio_conifer|sgf-oz-2-1|2009" in codes  # s26 belongs to the second tree and is renumbered
    assert "divittorio_conifer|mk-rand-2-1|2009" in codes  # row 33 starts the second tree; file t2 s1 joins it
    assert len(codes) == 1 + 1 + 33
    spectra = b.spectra.where("samplecode = 'divittorio_conifer|mk-rand-2-1|2009' and spectratype = 'reflectance'")
    assert [(r.wavelength, round(r.spectravalue, 9)) for r in spectra.orderBy("wavelength").collect()] == [
        (float(w), w / 1000) for w in range(351, 357)
    ]
    assert b.spectra.count() == 3 * 2 * 6
    assert b.traits.where("trait = 'leaf_cartot_per_area'").count() == 33


def foster_batch(make):
    raw = make("TREEID int, Height string, Infested string, `350` double, `351` double", (1, "H", "Y", 0.1, 0.2), (1, "L", None, 0.3, None))
    return foster_beetle.build(raw, Contact("someone", "a@b"))


def test_foster(make):
    b = foster_batch(make)
    assert rows(b.samples.select("samplecode", "collectiondate"))[0] == ("foster_beetle|1_H|2014", dt.date(2014, 9, 5))
    values = {(r.samplecode[-6], r.condition): r.conditionvalue for r in b.conditions.collect()}
    assert values == {
        ("H", "bark_beetle_infested"): "yes", ("H", "CanopyPosition"): "M", ("H", "sunshade"): "shade",
        ("L", "CanopyPosition"): "B", ("L", "sunshade"): "shade",
    }
    plot = b.plots.first()
    assert abs(plot.latitude - 38.5028) < 1e-4 and abs(plot.longitude + 106.3356) < 1e-4
    assert b.spectra.count() == 4


def fft_batch(make, species_dict):
    cols = "Sample_Name string, Sample_Year int, Height string, Site string, Plot string, Species string, Age string, Wave_350 double, Wave_351 double"
    refl = make(cols, ("BH02-a", 2009, "T", "BH", "BH02", "ACRU", "N", 0.1, 0.2), ("MN1-x", 2009, "M", None, None, "XX", "O", 0.3, 0.4))
    trans = make(cols, ("BH02-a", 2009, "T", "BH", "BH02", "ACRU", "N", 0.5, 0.6), ("only-t", 2009, None, None, None, "ACRU", "3", 0.7, 0.8))
    caps = "SAMPLE_NAME string, SAMPLE_YEAR int, SPECIES string, COMMENTS string"
    d15n = make(
        f"{caps}, SAMPLE_dN15 double",
        ("BH02-a", 2009, "ACRU", "", 1.0), ("BH02-a", 2009, "ACRU", "", 3.0), ("BH02-a", 2009, "ACRU", "bad", 99.0),
    )
    lignin = make(f"{caps}, ADF_PERC_DW double, ADL_PERC_DW double, CELL_PERC_DW double", ("new", 2008, "ACRU", "", 1.0, 2.0, 3.0))
    lower = "Sample_Name string, Sample_Year int, Species string"
    cn = make(f"{lower}, Perc_N double, Perc_C double, CNRatio double", ("BH02-a", 2009, "ACRU", None, 4.0, 2.0), ("BH02-a", 2009, "ACRU", 2.0, 4.0, 2.0))
    lma = make(f"{lower}, EWT_g_cm2 double, LMA_g_DW_m2 double", ("BH02-a", 2009, "ACRU", -1.0, 50.0))
    plots = make("PLOT string, SITE string, LAT double, LON double", ("BH02", "BH", 45.0, -90.0), ("BH02", "BH", 45.0, -90.0), ("ZZ", "Z", 1.0, 1.0))
    return nasa_fft.build(refl, trans, d15n, lignin, cn, lma, plots, species_dict)


def test_nasa_fft(make, species_dict):
    b = fft_batch(make, species_dict)
    s = {r.samplecode: (r.plotcode, r.speciescode) for r in b.samples.collect()}
    assert s == {
        "nasa_fft|BH02-a|2009": ("nasa_fft.BH02", "ACRU"),
        "nasa_fft|MN1-x|2009": ("nasa_fft.MN1", None),
        "nasa_fft|only-t|2009": ("nasa_fft.only", "ACRU"),  # measured in transmittance only
        "nasa_fft|new|2008": ("nasa_fft.new", "ACRU"),  # analysed only
    }
    traits = {(r.samplecode.split("|")[1], r.trait): r.traitvalue for r in b.traits.collect()}
    assert traits[("BH02-a", "leaf_dN15")] == 2.0 and traits[("BH02-a", "leaf_N_pct_mass")] == 2.0
    assert ("BH02-a", "leaf_water_thickness") not in traits and traits[("BH02-a", "leaf_mass_per_area")] == 0.05
    values = {(r.samplecode.split("|")[1], r.condition): r.conditionvalue for r in b.conditions.collect()}
    assert values[("BH02-a", "NeedleAge")] == "1" and values[("only-t", "NeedleAge")] == "3"
    assert values[("MN1-x", "NeedleOldNew")] == "O"
    assert b.spectra.groupBy("spectratype").count().orderBy("spectratype").collect()[1]["count"] == 4
    assert as_dict(b.plots, "plotcode", "latitude") == {
        "nasa_fft.BH02": 45.0, "nasa_fft.MN1": None, "nasa_fft.only": None, "nasa_fft.new": None,
    }


def test_nasa_hyspiri(make):
    raw = make(
        "line int, Spectra string, file_path string, Wave_350 double",
        (1, "KING_P1_QUDO_L2T_x_Refl", "/h/Spring2013/05202013/Processed/a.csv", 0.1),
        (2, "KING_bare_Soil_L2T_x_Refl", "/h/Spring2013/05202013/Processed/a.csv", 0.2),
        (3, "KING_Plot1_Grape_x_Trans", "/h/Fall2014/2014_misc/processed/a.csv", 0.3),
        (4, "KING_P1_QUDO_L2T_y_Refl", "/h/Spring2013/05222013/Processed/a.csv", 0.4),
        (5, "two_parts", "/h/Fall2014/x/a.csv", 0.5),
    )
    gps = make("Site string, Latitude double, Longitude double", ("Kingsburg", 36.0, -119.0), ("Kingsburg", 38.0, None))
    chn = make("Sample_Name string, Sample_Year int, Perc_C double, Perc_N double, Perc_H double", ("KING_P1_QUDO_L2T", 2013, 40.0, None, 6.0))
    b = nasa_hyspiri.build(raw, gps, chn, ["line"])
    got = {r.samplecode: (r.plotcode, r.speciescode, r.collectiondate) for r in b.samples.collect()}
    assert got == {
        "nasa_hyspiri|KING_P1_QUDO_L2T_Spring2013|2013": ("nasa_hyspiri.KING.P1", "QUDO", dt.date(2013, 5, 21)),
        "nasa_hyspiri|KING_Plot1_Grape_Fall2014|2014": ("nasa_hyspiri.KING.Plot1", "VITIS", None),
    }
    assert set(as_dict(b.plots, "plotcode", "latitude").values()) == {37.0}
    assert sorted(r.spectracomment for r in b.spectra_info.collect()) == [
        "1 KING_P1_QUDO_L2T_x_Refl", "2 KING_Plot1_Grape_x_Trans", "3 KING_P1_QUDO_L2T_y_Refl",
    ]
    assert sorted(r.trait for r in b.traits.collect()) == ["leaf_C_pct_mass", "leaf_H_pct_mass"]
    assert b.spectra.count() == 3


def arctic_raw(make):
    gps = "Spectrometer_GPS_Lat double, Spectrometer_GPS_Long double"
    return {
        "2013": make("Sample_ID string, Chl_a_g_m2 double, Chl_b_g_m2 double, Wave_350 double", ("7", 1.0, 2.0, 10.0), ("8", 1.0, None, 20.0)),
        "2014": make("Spectra string, Wave_350 double, Wave_351 double", ("BNL10", 30.0, 31.0)),
        "2016b": make(f"Sample_Barcode string, {gps}, Wave_350 double", ("BNL20", 71.0, -156.0, 1.0), ("BNL21", 71.0, -156.0, 1.0), ("BNL22", 70.0, -156.0, 1.0)),
        "traits_main": make(
            "Sample_ID string, Measurement_Date string, USDA_Species_Code string, Perc_C double, Perc_N double, CN_ratio double, "
            "LMA_gDW_m2 double, N_area_gDW_m2 double, C_area_gDW_m2 double",
            ("BNL7", "20130701", "SAPU", 40.0, -9999.0, 20.0, 100.0, 1.0, 2.0),
            (None, "20130701", "SAPU", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
            ("BNL99", "bad", "SAPU", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        ),
        "pigments": make(
            "Barcode string, Chl_a_mg_m2 double, Chl_b_mg_m2 double, Chl_a_plus_b_mg_m2 double, Tot_Car_mg_m2 double, Total_area_m2 double",
            ("BNL30", 100.0, 50.0, 150.0, 20.0, 0.5),
        ),
        "seward_2016_lma": make("Sample_Barcode string, Site string, USDA_Species_Code string, Measurement_Date string, LMA_gDW_m2 double", ("40", "Seward_Kougarok", "SAPU", "20160701", 80.0)),
        "barrow_2016_lma": make("Sample_Barcode string, Species string, Measurement_Date string, LMA_gDW_m2 double", ("20", "SAPU", "20160702", 90.0)),
        "barrow_2016_chn": make("Sample_Barcode string, USDA_Species_Code string, Perc_C double, Perc_N double, CN_ratio double", ("BNL20", "SAPU", 41.0, 2.0, 20.5)),
    }


def test_ngee_arctic(make, species_dict):
    b = ngee_arctic.build(arctic_raw(make), species_dict)
    s = {r.samplecode: (r.plotcode, r.speciescode, r.collectiondate) for r in b.samples.collect()}
    barrow, na = "ngee_arctic.Barrow", "ngee_arctic.Barrow.NA"
    assert s == {
        "ngee_arctic|BNL7|2013": (na, "SAPU", dt.date(2013, 7, 1)),
        "ngee_arctic|BNL8|2013": (na, None, None),
        "ngee_arctic|BNL10|2014": (na, None, None),
        "ngee_arctic|BNL20|2016": (f"{barrow}.2", "SAPU", dt.date(2016, 7, 2)),
        "ngee_arctic|BNL21|2016": (f"{barrow}.2", None, None),
        "ngee_arctic|BNL22|2016": (f"{barrow}.1", None, None),
        "ngee_arctic|BNL30|2015": (na, None, None),
        "ngee_arctic|BNL40|2016": ("ngee_arctic.Seward_Kougarok.NA", "SAPU", dt.date(2016, 7, 1)),
    }
    t = {(r.samplecode.split("|")[1], r.trait): round(r.traitvalue, 9) for r in b.traits.collect()}
    assert t[("BNL7", "leaf_chltot_per_area")] == 0.003 and ("BNL7", "leaf_N_pct_mass") not in t
    assert t[("BNL20", "leaf_mass_per_area")] == 0.09 and t[("BNL20", "leaf_C_pct_mass")] == 41.0
    assert t[("BNL30", "leaf_chla_per_area")] == 1e-4 and t[("BNL30", "leaf_area")] == 0.5
    lat = as_dict(b.plots, "plotcode", "latitude")
    assert lat[na] == 71.275764 and lat["ngee_arctic.Seward_Kougarok.NA"] is None and lat[f"{barrow}.1"] == 70.0
    assert as_dict(b.trait_info, "trait", "unit")["leaf_area"] == "m2"
    value = b.spectra.where("samplecode = 'ngee_arctic|BNL10|2014' and wavelength = 350").first().spectravalue
    assert abs(value - 0.3) < 1e-12


def tropics_batch(make, species_dict):
    chem = make(
        "Barcode string, Species string, Canopy_position string, LWP_bar double",
        ("B1", "Ficus", "sunlit", -10.0), ("B2", "none", "understory", -9999.0), ("B3", "Ficus", None, None),
    )
    spectra = make(
        "Spectra string, Site string, Date string, Instrument string, Wave_350 double",
        ("B1", "PNM", "20160215", "SVC", 0.1), ("BNL11815", "PNM", "20160215", "SVC", 0.2),
        ("B2", None, "20160216", "ASD", 0.3), ("B9", "SanLorenzo", "20160216", "ASD", 0.4),
    )
    return ngee_tropics.build(chem, spectra, species_dict)


def test_ngee_tropics(make, species_dict):
    b = tropics_batch(make, species_dict)
    s = {r.samplecode.split("|")[1]: (r.plotcode, r.speciescode) for r in b.samples.collect()}
    assert s == {
        "B1": ("ngee_tropics.PNM", "FICUS"), "B2": ("ngee_tropics.NA", None),
        "B3": ("ngee_tropics.NA", "FICUS"), "B9": ("ngee_tropics.SanLorenzo", None),
    }
    assert as_dict(b.conditions, "samplecode", "conditionvalue") == {
        "ngee_tropics|B1|2016": "sun", "ngee_tropics|B2|2016": "shade", "ngee_tropics|B3|2016": None,
    }
    assert [r.traitvalue for r in b.traits.collect()] == [-1e6]


def test_wu_brazil(make):
    spectra = make("Wavelength string, L1 double, L2 double", ("350 nm", 0.1, None), ("351 nm", 0.2, 0.3))
    traits = make(
        "Leaf_Number string, SLA_m2_kg double, Water_Perc double, Light_Environment int, Complete_Leaf int, Leaf_Age int",
        ("L1", 10.0, 0.5, 3, 1, 2), ("L3", 0.0, 0.5, None, 2, 9),
    )
    b = wu_brazil.build(spectra, traits)
    assert sorted(r.samplecode for r in b.samples.collect()) == [f"wu_brazil|{x}|NA" for x in ("L1", "L2", "L3")]
    t = {(r.samplecode, r.trait): r.traitvalue for r in b.traits.collect()}
    assert t[("wu_brazil|L1|NA", "leaf_water_thickness")] == 0.05 and t[("wu_brazil|L3|NA", "leaf_mass_per_area")] is None
    c = {(r.samplecode[10:12], r.condition): r.conditionvalue for r in b.conditions.collect()}
    assert c[("L1", "sunshade")] == "sun" and c[("L3", "sunshade")] is None and c[("L3", "LeafAge")] is None
    assert b.spectra.count() == 4


def pheno_batch(make, species_dict):
    cols = "`day of year` string, AU1 string, AL1 string, ` ` string"
    sheets = {s: make(cols, ("150", "1.5", "NA", "x"), ("170", "2.0", "3.0", "x"), ("note", "1", "1", "x")) for s in yang_pheno.SHEETS.values()}
    matrix = lines(make, ("/m/1.csv", "350,0.1,0.2", "0,1,1"), ("/m/2.csv", "350,0.3,NA"))
    return yang_pheno.build(sheets, {"reflectance": matrix}, species_dict, "MV", 2011)


def test_yang_pheno(make, species_dict):
    b = pheno_batch(make, species_dict)
    s = {r.samplecode: (r.collectiondate, r.speciescode) for r in b.samples.collect()}
    assert s["yang_pheno|AU1_150|2011"] == (dt.date(2011, 5, 30), "QURU") and len(s) == 4
    assert rows(b.spectra.drop("spectratype")) == [
        # AU1 is the first column although AL1 sorts before it.
        ("yang_pheno|AL1_150|2011", 350.0, 0.2),
        ("yang_pheno|AU1_150|2011", 350.0, 0.1),
        ("yang_pheno|AU1_170|2011", 350.0, 0.3),
    ]
    assert as_dict(b.conditions, "samplecode", "conditionvalue")["yang_pheno|AL1_150|2011"] == "shade"
    t = {(r.samplecode[11:18], r.trait): round(r.traitvalue, 9) for r in b.traits.collect()}
    assert t[("AU1_150", "leaf_chla_per_area")] == 1.5e-5 and t[("AU1_170", "leaf_mass_per_area")] == 0.002
    assert ("AL1_150", "leaf_C_pct_mass") not in t
    one_file = {"reflectance": lines(make, ("/m/1.csv", "350,0.1,0.2"))}
    sheets = {s: make("d string, AU1 string", ("1", "1"), ("2", "2")) for s in yang_pheno.SHEETS.values()}
    with pytest.raises(ValueError, match="DOY"):
        yang_pheno.build(sheets, one_file, species_dict, "MV", 2011)


def test_whole_catalog(spark, make, tmp_path):
    reference = {
        "projects": make(
            "projectcode string, projectdescription string, affiliation string",
            *[(p, p, "x") for p in ("nasa_fft", "ngee_tropics", "yang_pheno", "accp")],
        ),
        "species": make(
            "speciescode string, scientificname string",
            *[(c, c.lower()) for c in ("ACRU", "QURU", "FICUS", "SAPU", "PIEN", "POSE", "USNEA2", "PIRE", "ACMA3")],
        ),
        "dictionary": make(
            "RawSpecies string, SpeciesCode string, Project string",
            *[(raw, code, p.upper()) for raw, p, code in DICT if p in ("nasa_fft", "ngee_tropics", "yang_pheno")],
        ),
        "attributes": make(
            "speciescode string, scientific_name string, family string, growth_form string, myco_asso string, ps_type string, shade_tolerance string",
            ("ACRU", "Acer rubrum", "f", "tree", "AM?", "C3", "Tolerant"),
        ),
    }
    projects = [
        lambda d: accp_batch(make),
        lambda d: foster_batch(make),
        lambda d: fft_batch(make, d),
        lambda d: tropics_batch(make, d),
        lambda d: pheno_batch(make, d),
    ]
    catalog = build_catalog(Catalog(spark, str(tmp_path)), reference, projects)
    counts = {name: df.count() for name, df in catalog.tables().items()}
    assert counts["samples"] == 6 + 2 + 4 + 4 + 4 and counts["spectra_data"] == 5 + 4 + 8 + 3 + 3
    for df in audits(catalog).values():
        for row in df.collect():
            assert all(v == 0 for k, v in row.asDict().items() if k.startswith("n_")), row
    # Loading again adds nothing.
    load(catalog, projects[1](catalog.table("species_dict")))
    assert {name: df.count() for name, df in catalog.tables().items()} == counts
    ids = [r.sampleid for r in catalog.table("samples").collect()]
    assert sorted(ids) == list(range(1, counts["samples"] + 1))
    out = {name: df.collect() for name, df in reports(catalog).items()}
    assert {(r.projectcode, r.n) for r in out["samples_by_project"]} == {
        ("accp", 6), ("foster_beetle", 2), ("nasa_fft", 4), ("ngee_tropics", 4), ("yang_pheno", 4),
    }
    assert {r.value for r in out["attribute_distribution"] if r.attribute == "shade_tolerance"} == {"tolerant", None}
    methods = catalog.table("specmethods").count()
    assert methods == 2 + 1 + 2 + 2
    export({"samples_by_project": reports(catalog)["samples_by_project"]}, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out/samples_by_project")).count() == 5
    catalog.delete("projects", F.col("projectcode") == "accp")
    left = {name: df.count() for name, df in catalog.tables().items()}
    assert left["samples"] == counts["samples"] - 6 and left["spectra_data"] == counts["spectra_data"] - 5
    assert left["sites"] == counts["sites"]
    assert all(r.n_rows == 0 for r in audits(catalog)["orphans"].collect())


def test_reference_rows(make):
    raw = make(
        "RawSpecies string, ScientificName string, SpeciesCode string, Database_ID string, Project string",
        ("a", "Cornus alba var. x L.", "kew-1", "ThePlantList", "NASA_FFT"), ("b", "Acer", "ACER", "USDA_Plants", "Lopex"),
    )
    assert rows(reference_data.dictionary_rows(raw))[0] == ("a", "nasa_fft", "kew-1")
    other = reference_data.other_species(raw)
    assert [(r.genus, r.species, r.variety) for r in other.collect()] == [("Cornus", "alba", "x")]
    usda = make(
        ", ".join(f"{c} string" for c in reference_data.USDA_NAMES),
        ("ACRU", "Acer", "rubrum", *[None] * 6, "Acer rubrum L."), ("ACER", "Acer", None, *[None] * 6, "Acer L."),
    )
    names = make("AccSpeciesName string, AccSpeciesID bigint", ("Acer rubrum", 1), ("Acer rubrum", 2))
    both = reference_data.species_rows(reference_data.backbone(usda, names), other)
    assert sorted((r.speciescode, r.tryspeciesid or 0) for r in both.collect()) == [("ACER", 0), ("ACRU", 1), ("ACRU", 2), ("kew-1", 0)]
    rate = reference_data.match_rate(reference_data.usda_species(usda), names).first()
    assert (rate.n_match, rate.n_total) == (2, 3)
    att = make("speciescode string, scientific_name string, family string, myco_asso string, shade_tolerance string", ("A", "x", "f", "ABM, ECM", "InTolerant"))
    assert reference_data.attribute_rows(att).first()[:] == ("A", "ECM", "intolerant")


def test_species_with_two_trait_database_ids_load(make, spark, tmp_path):
    usda = make(
        ", ".join(f"{c} string" for c in reference_data.USDA_NAMES),
        ("ACRU", "Acer", "rubrum", *[None] * 6, "Acer rubrum L."), ("ACER", "Acer", None, *[None] * 6, "Acer L."),
    )
    names = make("AccSpeciesName string, AccSpeciesID bigint", ("Acer rubrum", 2), ("Acer rubrum", 1))
    other = reference_data.other_species(make("RawSpecies string, ScientificName string, SpeciesCode string, Database_ID string", ("a", "Cornus alba L.", "kew-1", "ThePlantList")))
    species = reference_data.species_rows(reference_data.backbone(usda, names), other)
    catalog = Catalog(spark, str(tmp_path / "catalog"))
    catalog.reset()
    projects = make("projectcode string", ("p",))
    dictionary = make("RawSpecies string, Project string, SpeciesCode string", ("red maple", "P", "ACRU"))
    attributes = make("speciescode string, scientific_name string, family string, myco_asso string, shade_tolerance string", ("ACRU", "x", "f", "AM", "Tolerant"))
    for _ in range(2):
        reference_data.load(catalog, projects, species, dictionary, attributes)
    assert rows(catalog.table("species").select("speciescode", "tryspeciesid")) == [("ACER", None), ("ACRU", 1), ("kew-1", None)]
    assert rows(catalog.table("species_try").select("speciescode", "tryspeciesid")) == [("ACRU", 1), ("ACRU", 2)]
    assert all(r.n_rows == 0 for r in audits(catalog)["orphans"].collect()) and all(r.n_keys == 0 for r in audits(catalog)["unique"].collect())
    catalog.delete("species", F.col("speciescode") == "ACRU")
    assert catalog.table("species_try").count() == catalog.table("species_dict").count() == 0
    twice = species.where("speciescode = 'ACER'")
    for repeated in (twice, twice.withColumn("genus", F.lit("Acre"))):
        catalog.reset()
        with pytest.raises(ValueError):
            reference_data.load(catalog, projects, species.unionByName(repeated), dictionary, attributes)


def test_species_links_without_ids(make):
    plain = make("speciescode string, scientificname string", ("A", "x"))
    assert reference_data.species_of(plain).columns == plain.columns and reference_data.species_links(plain).count() == 0
