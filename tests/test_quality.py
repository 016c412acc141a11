"""Cleaning and quality counters (S14-S18, E6)."""

from pyspark.sql import functions as F

from faultline.operators import quality as Q


def _raw(spark):
    rows = [("T1", "A1", 2, "N??o Crítico", "43,7999", "NULL", 0, "Caminhao"),
            ("T1", "A2", 2, "Não Cr??tico", "1,5", "Activate", 1, "Caminhao"),
            ("T2", "A1", 2, "N?o Crítico", "2,0", "NULL", 0, "Escavadeira"),
            ("T2", "A3", 1, "Crítico", "NULL", "Inactive", 0, "Escavadeira"),
            ("T3", "A1", 2, "Não Crítico", "3,25", "NULL", 1, "Caminhao"),
            ("T3", "A4", 3, None, "7,1", None, 0, "Caminhao")]
    return spark.createDataFrame(rows, "TAG string, Alarme string, Id_Criticidade int, Criticidade string, "
                                       "Valor string, Classe string, Is_Dont_Go int, Tipo string")


def test_counters(spark):
    r = Q.quality_counts(_raw(spark)).first()
    assert (r["criticidade_fixed"], r["null_string_fixed"], r["decimal_fixed"], r["valor_null_fixed"]) == (3, 3, 5, 1)
    assert r["n_rows"] == 6 and r["valor_rejected"] == 0


def test_clean_values_and_rows(spark):
    raw = _raw(spark)
    c = Q.clean_telemetry(raw)
    rows = c.collect()
    assert len(rows) == 6
    assert rows[0]["Valor"] == 43.7999
    assert rows[3]["Valor"] is None
    assert [r["Criticidade"] for r in rows[:3]] == ["Não Crítico"] * 3
    assert rows[4]["Criticidade"] == "Não Crítico" and rows[5]["Criticidade"] is None
    assert [r["Classe"] for r in rows] == [None, "Activate", None, "Inactive", None, None]
    assert [r["Is_Dont_Go"] for r in rows] == [r["Is_Dont_Go"] for r in raw.collect()]
    assert dict(c.dtypes)["Valor"] == "double"
    Q.assert_clean(c, expected_rows=6)


def test_e6_rejects_never_raise(spark):
    df = spark.createDataFrame([("1.234,56",), ("abc",), ("nan",), ("1.5d",), (None,), ("-2,5",)], "Valor string")
    out = df.select(F.col("Valor").alias("raw"), Q.clean_telemetry.__globals__["parse_decimal"](F.col("Valor")).alias("v"))
    got = [r["v"] for r in out.collect()]
    assert got == [None, None, None, None, None, -2.5]
    full = df.withColumn("Criticidade", F.lit("x")).withColumn("Classe", F.lit("x"))
    r = Q.quality_counts(full).first()
    assert r["valor_rejected"] == 4  # null input is not a reject


def test_inverted_intervals(spark):
    df = spark.createDataFrame([(1, 2), (5, 3), (7, 7), (9, 1)], "inicio_us long, fim_us long")
    assert Q.inverted_intervals(df).first()["inicio_after_fim"] == 2


def test_duplicates_and_mismatch(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", 2)], "TAG string, x int")
    r = Q.duplicate_rows(df).first()
    assert r["duplicate_rows"] == 2 and r["distinct_rows"] == 2
    iv = spark.createDataFrame([("a",)], "Tag string")
    assert [x["TAG"] for x in Q.tag_mismatch(df, iv).collect()] == ["b"]


def test_timestamp_gaps(spark):
    h = 3_600_000_000
    df = spark.createDataFrame([("jan", 0), ("jan", h), ("jan", 4 * h + 5), ("feb", 10 * h)],
                               "_source_month string, ts_us long")
    g = Q.timestamp_gaps(df).collect()
    # the second gap runs over the month boundary
    assert [(r["_source_month"], r["gap_start_us"], r["gap_end_us"], r["missing_units"]) for r in g] == \
        [("jan", 2 * h, 4 * h, 2), ("jan", 5 * h, 10 * h, 5)]


def test_duplicate_rows_tell_nulls_and_borders_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, "a"), ("ab", "c"), ("a", "bc"), ("-", None), (None, "-")],
                               "x string, y string")
    r = Q.duplicate_rows(df).first()
    assert r["duplicate_rows"] == 1 and r["distinct_rows"] == 6
