"""Names, projections, text forms and templates."""

from pyspark.sql import functions as F

from catalogue.base import query, table
from tablelift.functions import expand_template, sql_table_name, sql_table_name_qualified, standardize_name
from tablelift.operators.columns import cast_all_text, encode_tsv, map_columns, project_columns, standardize_columns

UNTIDY = [" C CUSTKEY ", "Ñombre", "C  Nation\tKEY", "SALDO\ufffd\ufffd", "Categoría"]

# White space and word characters beyond ASCII, spelled out for an engine whose \s and \w are ASCII only.
SQL_SPACE = r"\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SQL_WORD = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"

EVENT_TEXT = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in ["event_id", "ts", "user_id", "event_type", "value", "props"]
)


def untidy_customers(spark, folder):
    return table(spark, folder, "customer").toDF(*UNTIDY)


@query(
    "standardize_columns",
    """
    SELECT c_custkey, c_name AS nombre, c_nationkey AS c_nation_key, c_acctbal AS saldon, c_mktsegment AS categoria
    FROM customer
    """,
)
def standardize_columns_query(spark, folder):
    return standardize_columns(untidy_customers(spark, folder))


@query(
    "column_mapping",
    """
    SELECT c_custkey AS id_cliente, c_name AS nombre, c_nationkey AS c_nation_key, c_acctbal AS saldo,
           c_mktsegment AS categoria
    FROM customer
    """,
)
def column_mapping(spark, folder):
    mapping = {"C CUSTKEY": "wrong", " c_custkey ": "Id Cliente", "SALDO\ufffd": " Saldo", "not there": "x"}
    return map_columns(standardize_columns(untidy_customers(spark, folder)), mapping)


@query("project_columns", "SELECT c_mktsegment, c_custkey, c_name FROM customer")
def project_columns_query(spark, folder):
    return project_columns(table(spark, folder, "customer"), ["c_mktsegment", "c_custkey", "c_name"])


@query("cast_all_text", f"SELECT {EVENT_TEXT} FROM events")
def cast_all_text_query(spark, folder):
    return cast_all_text(table(spark, folder, "events"))


@query(
    "encode_tsv",
    r"""
    WITH fields AS (
      SELECT doc_id, text, nullif(lang, 'en') AS lang, source || chr(9) || 'C:\' AS source, n_chars FROM documents
    ), escaped AS (
      SELECT doc_id, n_chars,
             replace(replace(replace(replace(text, '\', '\\'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r') AS text,
             coalesce(lang, '\N') AS lang,
             replace(replace(source, '\', '\\'), chr(9), '\t') AS source
      FROM fields
    )
    SELECT doc_id, concat_ws(chr(9), doc_id::VARCHAR, text, lang, source, n_chars::VARCHAR) AS line FROM escaped
    """,
)
def encode_tsv_query(spark, folder):
    documents = table(spark, folder, "documents").withColumns(
        {"lang": F.nullif("lang", F.lit("en")), "source": F.concat("source", F.lit("\tC:\\"))}
    )
    return encode_tsv(documents).select("doc_id", "line")


@query(
    "standardize_name",
    rf"""
    WITH named AS (
      SELECT doc_id, chr(160) || text || chr(65533) || chr(65533) || ' Ñ' || chr(65533) || 'ü ' AS name FROM documents
    ), folded AS (
      SELECT doc_id, translate(regexp_replace(
               regexp_replace(name, '^[{SQL_SPACE}]+|[{SQL_SPACE}]+$', '', 'g'),
               chr(65533) || '{{1,2}}', 'n', 'g'), 'ñÑáÁéÉíÍóÓúÚ', 'nnaaeeiioouu') AS name
      FROM named
    )
    SELECT doc_id, lower(regexp_replace(regexp_replace(name, '[{SQL_SPACE}]+', '_', 'g'), '[^\x00-\x7F]', '', 'g')) AS name
    FROM folded
    """,
)
def standardize_name_query(spark, folder):
    name = F.concat(F.lit("\u00a0"), "text", F.lit("\ufffd\ufffd Ñ\ufffdü "))
    return table(spark, folder, "documents").select("doc_id", standardize_name(name).alias("name"))


@query(
    "sql_table_name",
    rf"""
    SELECT doc_id, lower(coalesce(nullif(
             regexp_extract(text, '(?i)(?:FROM|INTO|UPDATE)[{SQL_SPACE}]+({SQL_WORD}+)', 1), ''), 'unknown')) AS table_name
    FROM documents
    """,
)
def sql_table_name_query(spark, folder):
    return table(spark, folder, "documents").select("doc_id", sql_table_name(F.col("text")).alias("table_name"))


@query(
    "sql_table_name_qualified",
    rf"""
    SELECT page_id, coalesce(nullif(regexp_extract(
             CASE WHEN strpos(url, '?') > 0 THEN url ELSE 'SELECT * frOM ' || replace(url, 'http://', '') END,
             '(?i)FROM[{SQL_SPACE}]+({SQL_WORD}+\.{SQL_WORD}+|{SQL_WORD}+)', 1), ''), 'unknown') AS table_name
    FROM pages
    """,
)
def sql_table_name_qualified_query(spark, folder):
    statement = F.when(F.instr("url", "?") > 0, F.col("url")).otherwise(
        F.concat(F.lit("SELECT * frOM "), F.replace(F.col("url"), F.lit("http://"), F.lit("")))
    )
    return table(spark, folder, "pages").select("page_id", sql_table_name_qualified(statement).alias("table_name"))


@query(
    "expand_template",
    "SELECT c_custkey, c_mktsegment || '-${MISSING}-' || c_name || '${SEG}$' AS filled FROM customer",
)
def expand_template_query(spark, folder):
    template = F.concat(F.lit("${SEG}-${MISSING}-${NAME}$"))
    values = F.create_map(
        F.lit("SEG"), F.col("c_mktsegment"), F.lit("NAME"), F.concat("c_name", F.lit("${SEG}"))
    )
    return table(spark, folder, "customer").select("c_custkey", expand_template(template, values).alias("filled"))
