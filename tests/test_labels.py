"""Label functions by literal cases."""

from pyspark.sql import functions as F

from tidewater.functions import labels as S


def _map(spark, function, cases):
    got = spark.createDataFrame([(k,) for k in cases], "x string").select("x", function("x").alias("y")).collect()
    assert {r.x: r.y for r in got} == cases


def test_markers(spark):
    _map(spark, lambda x: S.marker_of_token(x, ("rbcL",)), {"a|RBCL|b": "rbcL", "x-COI": "COI", "its1 y": "ITS2", "zzz": "OTHER", " ": None, None: None, "COIX": "OTHER"})
    _map(spark, lambda x: S.marker_of_label(x, ("rbcL",)), {"s_rbcl_2": "rbcl", "s_COI1_3": "coi", "s_ITS2": "its2", "s": "", "no_adapter_1": "", None: ""})
    _map(spark, lambda x: S.sample_base(x, ("rbcL",)), {"p_1_q_2_r_3": "p_q_2_r", "s_rbcL1_2": "s", "s_COI2_4": "s", "no_adapter|COI": "no_adapter", " s ": "s", None: ""})
    _map(spark, S.is_numeric_taxid, {"12": True, "-1": False, "NA": False, "": False})
    _map(spark, S.is_signed_taxid, {"12": True, "-1": True, "0": False, "-01": False, None: False})
    _map(spark, lambda x: S.threshold_of(x, {"COI": 1, "RBCL": 2, "_default": 9}), {"COI": 1.0, "x|coi|y": 1.0, "rbcl": 2.0, "q": 9.0, None: 9.0})


def test_ids(spark):
    got = spark.createDataFrame([("p_q__r",), ("no_adapter",), (None,)], "x string").select(F.concat_ws(",", *S.sample_dimensions("x"))).collect()
    assert [r[0] for r in got] == ["p,q,unknown,r", "unknown,unknown,unknown,unknown", "unknown,unknown,unknown,unknown"]
    row = spark.createDataFrame([("a_b_3_u_COI", ">no_adapter_2|cons1|x", "only")], "a string, b string, c string").select(*S.track_unit("a"), *S.consensus_sequence_id("b"), *S.consensus_sequence_id("c")).first()
    assert tuple(row) == ("a_b", "3", "u", "COI", "no_adapter", "cons1", "cons1_no_adapter", None, None, None)
    _map(spark, S.reads_of, {"x reads-12|reads-3": 12, "x": None})
    _map(spark, lambda x: S.reads_of(x, True), {"x reads-12|reads-3": None, "reads-7": 7})
    _map(spark, S.subject_label, {"a|b|c": "a|b", "a": "a"})
    _map(spark, lambda x: S.label_is_target(x, [("COI", "Insecta")]), {"COI|Insecta|z": True, "ITS2|Insecta": False, None: False})
    first, second = (r[0] for r in spark.createDataFrame([("My Sample!",), ("",)], "x string").select(S.stable_sample_id("x")).collect())
    assert first == "my_sample_" + first[-8:] and second.startswith("unknown_")


def test_numbers(spark):
    _map(spark, S.epoch_of, {"1970-01-02T00:00:00Z": 86400, "1970-01-01T01:00:00+01:00": 0, "soon": None, None: None})
    rounds = ["round 10", "round 2", "second round", "first round", "round", "round 002b"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rounds], "x string").orderBy(S.natural_round_key("x"), "x").collect()]
    assert got == ["first round", "second round", "round", "round 2", "round 002b", "round 10"]
    row = spark.range(1).select(S.shorter_coverage(F.lit(50), F.lit(80), F.lit(40)), S.shorter_coverage(F.lit(30), F.lit(80), F.lit(40)), S.fixed_number(F.lit(1.23456), "percent"), S.fixed_number(F.lit(2 / 3), "fraction"), S.canonical_json(b=F.lit(1), a=F.lit(None).cast("string"))).first()
    assert tuple(row) == (100.0, 75.0, "1.235", "0.666667", '{"a":null,"b":1}')
