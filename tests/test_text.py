import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import expand_template, sql_table_name, sql_table_name_qualified
from tablelift.operators.columns import cast_for_target, encode_tsv, target_ddl, target_type


def test_line_escapes_and_null_marker(spark):
    frame = spark.createDataFrame(
        [(None, "a\tb", "c\nd\re", "\\N", '"q"', "", True)],
        "n string, t string, l string, m string, q string, e string, b boolean",
    )
    line = encode_tsv(frame).first()["line"]
    assert line == "\\N\ta\\tb\tc\\nd\\re\t\\\\N\t\"q\"\t\ttrue"


@pytest.mark.parametrize(
    "sql, word, qualified",
    [
        ("SELECT * FROM A.B", "a", "A.B"),
        ("insert INTO xY(a)", "xy", "unknown"),
        ("nothing", "unknown", "unknown"),
        ("update  t1 set x=1 from\nt2", "t1", "t2"),
        ("", "unknown", "unknown"),
        ("select 1 FROM año", "año", "año"),
    ],
)
def test_table_names(spark, sql, word, qualified):
    frame = spark.createDataFrame([(sql,)], "sql string")
    got = frame.select(sql_table_name(F.col("sql")), sql_table_name_qualified(F.col("sql"))).first()
    assert tuple(got) == (word, qualified)


@pytest.mark.parametrize(
    "template, filled",
    [
        ("h=${A}-${MISSING}-${B}x", "h=1-${MISSING}-${A}x"),
        ("$${A}$", "$1$"),
        ("${A", "${A"),
        ("${}", "${}"),
        ("line\n${A}\n", "line\n1\n"),
        ("", ""),
    ],
)
def test_templates(spark, template, filled):
    values = F.create_map(F.lit("A"), F.lit("1"), F.lit("B"), F.lit("${A}"))
    frame = spark.createDataFrame([(template,)], "t string")
    assert frame.select(expand_template(F.col("t"), values)).first()[0] == filled


# The target type of each Spark type.
TYPES = [
    (T.ByteType(), "SMALLINT"),
    (T.ShortType(), "SMALLINT"),
    (T.IntegerType(), "INTEGER"),
    (T.LongType(), "BIGINT"),
    (T.DecimalType(20, 0), "NUMERIC(20,0)"),
    (T.FloatType(), "REAL"),
    (T.DoubleType(), "DOUBLE PRECISION"),
    (T.StringType(), "TEXT"),
    (T.BooleanType(), "BOOLEAN"),
    (T.DateType(), "DATE"),
    (T.TimestampType(), "TIMESTAMP"),
    (T.TimestampNTZType(), "TIMESTAMP"),
    (T.TimeType(), "TIME"),
    (T.BinaryType(), "BYTEA"),
    (T.ArrayType(T.IntegerType()), "TEXT"),
    (T.StructType([T.StructField("a", T.IntegerType())]), "TEXT"),
    (T.MapType(T.StringType(), T.IntegerType()), "TEXT"),
    (T.NullType(), "TEXT"),
    (T.DayTimeIntervalType(), "TEXT"),
]


@pytest.mark.parametrize("data_type, expected", TYPES)
def test_target_types(data_type, expected):
    assert target_type(data_type) == expected


def test_cast_for_target(spark):
    frame = spark.sql(
        "SELECT 1 AS i, timestamp'2024-01-02 03:04:05' AS ts, array(1) AS a, named_struct('k', 2) AS s,"
        " map('k', 3) AS m, NULL AS n, INTERVAL 1 DAY AS d, TIME'10:11:12' AS t"
    )
    cast = cast_for_target(frame)
    assert dict(cast.dtypes) == {
        "i": "int", "ts": "timestamp_ntz", "a": "string", "s": "string", "m": "string", "n": "string", "d": "string",
        "t": "string",
    }
    row = cast.first()
    assert (row.a, row.s, row.m, row.n, row.t) == ("[1]", '{"k":2}', '{"k":3}', None, "10:11:12")
    assert target_ddl(cast.schema)["ts"] == "TIMESTAMP"


def test_types_agree_with_the_databases_dialect(spark):
    """The column types Spark itself gives a PostgreSQL table, found without a connection."""
    frame = cast_for_target(spark.sql("SELECT 1S AS s, 2 AS i, 3L AS l, 'x' AS t, true AS b, timestamp'2024-01-02' AS ts"))
    utils = spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get("jdbc:postgresql://nowhere/none")
    found = {
        f.name: utils.getJdbcType(spark._jvm.org.apache.spark.sql.types.DataType.fromJson(f.dataType.json()), dialect)
        .databaseTypeDefinition()
        for f in frame.schema.fields
    }
    assert found == target_ddl(frame.schema)
