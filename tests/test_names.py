import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablelift.functions import clean_name, standardize_name
from tablelift.operators.columns import (
    cast_all_text,
    keep_last_columns,
    map_columns,
    project_columns,
    standardize_columns,
)

CASES = {
    " ID_CLIENTE ": "id_cliente",
    "NOMBRE COMPLETO": "nombre_completo",
    "CAMPA\ufffd\ufffdA": "campana",
    "CAMPAÑA": "campana",
    "NOMBRE_CIUDAD": "nombre_ciudad",
    "PINGÜINO": "pingino",
    "X\ufffdY": "xny",
    "X\ufffd\ufffd\ufffdY": "xnny",
    "A B\tC": "a_b_c",
    "\u00a0Q\u2003": "q",
    "1ra COL": "1ra_col",
    "  Mes/Año 2024 ": "mes/ano_2024",
    "a\x1cb\x85c": "a_b_c",
    "": "",
}


@pytest.mark.parametrize("raw, clean", CASES.items())
def test_clean_name_cases(raw, clean):
    assert clean_name(raw) == clean


def test_standardize_name_cases(spark):
    frame = spark.createDataFrame(list(CASES.items()), "raw string, clean string")
    got = frame.select("clean", standardize_name(F.col("raw")).alias("got")).collect()
    assert [r.got for r in got] == [r.clean for r in got]


def spelled_out(name):
    """The clean-up, one character at a time."""
    while name and name[0].isspace():
        name = name[1:]
    while name and name[-1].isspace():
        name = name[:-1]
    out, i, spaced = "", 0, False
    while i < len(name):
        c = name[i]
        if c == "\ufffd":
            i += name[i : i + 2] == "\ufffd\ufffd"
            c = "n"
        elif c.isspace():
            c = "" if spaced else "_"
        else:
            base = unicodedata.normalize("NFD", c)
            if len(c) == 1 and len(base) == 2 and c.lower() in "ñáéíóú":
                c = base[0]
        spaced = name[i].isspace()
        out += c if c.isascii() else ""
        i += 1
    return re.sub("[A-Z]", lambda m: m[0].lower(), out)


NAMES = st.text(st.sampled_from("aZ_ñÑáÉíÓúüß \t\n\u00a0\u2003\x1d\ufffd\x0b9€K"), max_size=12)


@settings(max_examples=300, deadline=None)
@given(NAMES)
def test_clean_name_property(name):
    assert clean_name(name) == spelled_out(name)


@settings(max_examples=5, deadline=None)
@given(st.lists(NAMES, min_size=40, max_size=80))
def test_column_form_equals_header_form(spark, names):
    frame = spark.createDataFrame([(n,) for n in names], "raw string")
    got = frame.select("raw", standardize_name(F.col("raw")).alias("got")).collect()
    assert [r.got for r in got] == [clean_name(r.raw) for r in got]


def test_collision_names_both(spark):
    frame = spark.createDataFrame([(1, 2)], ["CAMPAÑA", "campana"])
    with pytest.raises(ValueError, match=r"campana.*CAMPAÑA.*campana"):
        standardize_columns(frame)


def test_mapping_known_unknown_spaced_and_last_wins(spark):
    frame = spark.createDataFrame([(1, 2)], ["nombre_largo", "campaa"])
    mapped = map_columns(frame, {" NOMBRE LARGO": "first", "nombre_largo": "Nombre", "none": "x", "CAMPAA": "campana"})
    assert mapped.columns == ["nombre", "campana"]


def test_mapping_collision(spark):
    with pytest.raises(ValueError, match="same name"):
        map_columns(spark.createDataFrame([(1, 2)], ["a", "b"]), {"a": "b"})


def test_last_duplicate_kept(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4)], ["X", "Y", "X", "Z"])
    kept = keep_last_columns(frame)
    assert kept.columns == ["X", "Y", "Z"]
    assert tuple(kept.first()) == (3, 2, 4)


def test_projection_is_pruned_in_the_scan(read):
    plan = project_columns(read("orders"), ["o_totalprice", "o_orderkey"])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_all_text(spark):
    frame = spark.sql("SELECT 1 AS i, true AS b, array(1,2) AS a, X'00ff' AS x, CAST(NULL AS INT) AS n")
    text = cast_all_text(frame)
    assert {t for _, t in text.dtypes} == {"string"}
    assert tuple(text.first()) == ("1", "true", "[1,2]", "\\x00ff", None)
