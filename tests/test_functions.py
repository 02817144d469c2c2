import datetime as dt

from pyspark.sql import functions as F

from foliar.functions import clean, parse, units
from foliar.functions.nulls import (
    extract,
    if_else,
    matches,
    not_in,
    paste_na,
    ratio,
    recode_keep,
    recode_lookup,
    strict_mean,
    update_where,
)


def test_missing_value_rules(values):
    out = values(
        "a string, x double",
        [("b", 1.0), (None, None), ("c", 0.0)],
        pasted=paste_na("|", F.lit("p"), "a", F.lit(2013)),
        choice=if_else(F.col("x") > 0.5, "yes", "no"),
        kept=not_in("a", ["b"]),
        grep=matches("a", "^b"),
        found=extract("a", "(c)", 1),
        look=recode_lookup("a", {"b": "B"}),
        keep=recode_keep("a", {"b": "B", "c": None}),
        upd=update_where("a", F.col("x") > 0.5, "new"),
        inv=ratio(F.lit(1.0), "x"),
    )
    assert out["pasted"] == ["p|b|2013", "p|NA|2013", "p|c|2013"]
    assert out["choice"] == ["yes", None, "no"]
    assert out["kept"] == [False, True, True]
    assert out["grep"] == [True, False, False]
    assert out["found"] == [None, None, "c"]
    assert out["look"] == ["B", None, None]
    assert out["keep"] == ["B", None, None]
    assert out["upd"] == ["new", None, "c"]
    assert out["inv"] == [1.0, None, None]


def test_recode_keep_leaves_other_values(values):
    out = values("a string", [("ECM?",), ("EM",), (None,)], x=recode_keep("a", {"ECM?": "ECM"}))
    assert out["x"] == ["ECM", "EM", None]


def test_strict_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 1.0), ("b", None)], "k string, v double")
    out = dict(df.groupBy("k").agg(strict_mean("v").alias("m")).collect())
    assert out == {"a": 2.0, "b": None}


def test_sentinels_and_retyping(spark, values):
    out = values(
        "x double, t string",
        [(-999.0, "1.5"), (-998.0, "n/a"), (-997.9, ""), (None, None)],
        below=clean.sentinel_below("x"),
        equal=clean.sentinel_equal("x", -999.0),
        neg=clean.negative_to_null("x"),
        num=F.col("t").try_cast("double"),
    )
    assert out["below"] == [None, None, -997.9, None]
    assert out["equal"] == [None, -998.0, -997.9, None]
    assert out["neg"] == [None] * 4
    assert out["num"] == [1.5, None, None, None]
    text = spark.createDataFrame([("x", 1)], "a string, b int")
    assert clean.drop_sentinels(text).columns == ["a", "b"]


def test_replicates(values):
    data = [(2.0, 4.0), (2.0, None), (None, 4.0), (None, None)]
    out = values("a double, b double", data, m=clean.replicate_mean("a", "b"), both=clean.both_mean("a", "b"))
    assert out["m"] == [3.0, 2.0, 4.0, None]
    assert out["both"] == [3.0, None, None, None]


def test_degrees(values):
    out = values("d int", [(38,), (-106,)], x=clean.dms_to_decimal("d", F.lit(30), F.lit(36.0)))
    assert [round(x, 6) for x in out["x"]] == [38.51, -106.51]


def test_unit_factors_round_trip(values):
    for (a, b), f in units.FACTORS.items():
        out = values("x double", [(3.0,), (None,)], y=units.convert("x", a, b) / f)
        assert abs(out["y"][0] - 3.0) < 1e-12 and out["y"][1] is None


def test_unit_labels_first_and_last(values):
    rules = [("_pct", "%"), ("_area", "kg m-2"), ("ratio", "unitless")]
    data = [("leaf_ratio_area",), ("leaf_pct_mass",), ("x",), (None,)]
    out = values("t string", data, first=units.label("t", rules), last=units.label("t", rules, True))
    assert out["first"] == ["kg m-2", "%", None, None]
    assert out["last"] == ["unitless", "%", None, None]


def test_convert_long_unknown_pair_is_missing(spark):
    df = spark.createDataFrame([(1.0, "bar", "Pa"), (1.0, "bar", "kg"), (1.0, "m", "m")], "v double, u string, w string")
    assert sorted(r.v or 0 for r in units.convert_long(df, "v", "u", "w").collect()) == [0, 1.0, 100000.0]


def test_names(values):
    data = [
        ("Acer pseudoplatanus L.",),
        ("Callicarpa bodinieri H.Lév.",),
        ("Rhododendron luteum var. albus subsp. niger Sweet",),
        ("Acer",),
        (None,),
    ]
    parts = parse.scientific_parts("n")
    out = values("n string", data, short=parse.abbreviate("n"), **parts)
    assert out["short"][0] == "Ace-pse" and out["short"][3] == "Acer" and out["short"][4] is None
    assert out["genus"] == ["Acer", "Callicarpa", "Rhododendron", None, None]
    assert out["variety"] == [None, None, "albus", None, None]
    assert out["subspecies"] == [None, None, "niger", None, None]


def test_accepted_name(values):
    data = [("Acer", "rubrum", "x"), ("Acer", "", "x"), ("Acer", None, "x"), (None, None, "Acer rubrum L. var. y")]
    out = values("g string, s string, f string", data, a=parse.accepted_name("g", "s", "f"))
    assert out["a"] == ["Acer rubrum", "Acer sp", "Acer sp", "Acer rubrum"]


def test_padded_and_positions(values):
    out = values(
        "n int, t string", [(7, "L12T"), (12, "L1x"), (123, None)],
        leaf=parse.leaf_name(F.lit("Ace-pse"), "n"), pos=parse.canopy_position("t"),
    )
    assert out["leaf"] == ["Ace-pse_Leaf07", "Ace-pse_Leaf12", "Ace-pse_Leaf123"]
    assert out["pos"] == ["T", None, None]


def test_coded_names(values):
    data = [
        ("KING_Plot1_Grape_x_Refl",),
        ("KING_P1_QUDO_L2T_x_trans",),
        ("KING_P1_BotX_L2T_x_refl",),
        ("KING_OrangeTree1_Top1_L2B_x_Refl",),
        ("RR_P1_QUDO_L3M_x_Refl_y",),
        ("RR_P1_QUDO_L3M_n_x_Trans_y",),
        ("a_b",),
        (None,),
    ]
    out = values("n string", data, **parse.coded_name("n"))
    assert out["species"] == ["Grape", "QUDO", None, "OrangeTree", "QUDO", "QUDO", None, None]
    assert out["plot"] == ["Plot1", "P1", "P1", "OrangeTree1", "P1", "P1", None, None]
    assert out["spectratype"][:6] == [
        "reflectance", "transmittance", "reflectance", "reflectance", "reflectance", "transmittance",
    ]
    assert out["CanopyPosition"] == [None, "T", "T", "B", "M", "M", None, None]
    assert out["Sample_Name"] == [
        "KING_Plot1_Grape", "KING_P1_QUDO_L2T", "KING_P1_BotX_L2T", "KING_OrangeTree1_Top1_L2B",
        "RR_P1_QUDO_L3M", "RR_P1_QUDO_L3M_n", None, None,
    ]


def test_plot_labels(values):
    data = [("na",), ("Grape",), ("Chem12",), ("TOWER",), ("P1",), (None,)]
    assert values("p string", data, x=parse.plot_label("p"))["x"] == [None, None, None, "Tower", "P1", None]


def test_light_and_needles(values):
    out = values(
        "a string", [("N",), ("O",), ("2",), ("3",), ("x",), (None,)],
        **parse.needle_age("a"), sun=parse.sunshade_by_letter(F.concat("a", F.lit("UL"))), pos=parse.sunshade_by_position("a"),
    )
    assert out["NeedleOldNew"] == ["N", "O", None, None, None, None]
    assert out["NeedleAge"] == [1.0, None, 2.0, 3.0, None, None]
    assert out["sun"] == ["sun"] * 5 + [None]
    assert out["pos"] == ["shade"] * 5 + [None]


def test_dates(values):
    out = values(
        "t string", [("920615",), ("690101",), ("681231",), ("bad",), (None,)], d=parse.parse_date("t", "%y%m%d")
    )
    assert out["d"] == [dt.date(1992, 6, 15), dt.date(1969, 1, 1), dt.date(2068, 12, 31), None, None]
    out = values(
        "t string", [("20130520",), ("05202013",), ("99999999",)], d=parse.parse_date("t", "%Y%m%d", "%m%d%Y")
    )
    assert out["d"] == [dt.date(2013, 5, 20), dt.date(2013, 5, 20), None]


def test_campaign_dates(values):
    data = [("a/Spring2013/05202013/x",), ("a/20140915/x",), ("a/2013_misc/x",), ("none",)]
    out = values("p string", data, d=parse.campaign_date("p"), y=parse.year_of(parse.campaign_date("p"), "p"))
    assert out["d"] == [dt.date(2013, 5, 20), dt.date(2014, 9, 15), None, None]
    assert out["y"] == [2013, 2014, 2013, None]


def test_day_of_year(values):
    data = [(2012, 366), (2011, 366), (2011, 1), (2011, 0), (None, 5)]
    out = values("y int, d int", data, x=parse.doy_to_date("y", "d"))
    assert out["x"] == [dt.date(2012, 12, 31), None, dt.date(2011, 1, 1), None, None]


def test_file_names(values):
    rx = r"(^\p{Alpha}+)_(\p{Alnum}+)_top_s(\p{Digit}+$)"
    out = values(
        "p string", [("/a/sgf_oz_top_s26.txt",), ("/a/odd.txt",)],
        **parse.file_name_parts(parse.base_name("p"), rx, {"site": 1, "cond": 2, "num": 3}),
    )
    assert out == {"site": ["sgf", "odd"], "cond": ["oz", "odd"], "num": ["26", "odd"]}
