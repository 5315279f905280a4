import pytest
from pyspark.sql import types as T

from flowspark.errors import RecipeError
from flowspark.types import as_bool, check_evolution, forced_types, normalise_columns, parse_schema, plain_name, spark_type, void_to_string


@pytest.mark.parametrize(
    ("word", "kind"),
    [("texto", T.StringType()), (" Entero ", T.IntegerType()), ("bigint", T.LongType()), ("float", T.FloatType()), ("bool", T.BooleanType()), ("fecha", T.DateType()), ("timestamp", T.TimestampType()), ("decimal(12, 2)", T.DecimalType(12, 2))],
)
def test_type_words(word, kind):
    assert spark_type(word) == kind


@pytest.mark.parametrize("word", ["", "array", "decimal(39,2)", "decimal(5,6)", "decimal(0,0)"])
def test_unknown_types(word):
    with pytest.raises(RecipeError):
        spark_type(word)


def test_schema_text():
    assert parse_schema("id:int|total:decimal(12,2)").simpleString() == "struct<id:int,total:decimal(12,2)>"
    for bad in ("", "a:int|A:int", "1a:int", "a"):
        with pytest.raises(RecipeError):
            parse_schema(bad)


@pytest.mark.parametrize(("name", "plain"), [("  Método de Pago  ", "metodo_de_pago"), ("2026 Total", "col_2026_total"), ("a--b__c", "a_b_c")])
def test_plain_names(name, plain):
    assert plain_name(name) == plain


def test_booleans():
    assert as_bool("Sí") and not as_bool("no") and as_bool(True)
    with pytest.raises(RecipeError):
        as_bool("tal vez")


def test_normalise_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["Ä b", "c"])
    assert normalise_columns(df, True).columns == ["a_b", "c"]
    with pytest.raises(RecipeError):
        normalise_columns(df, False)
    with pytest.raises(RecipeError):
        normalise_columns(spark.createDataFrame([(1, 2)], ["Á", "a"]), True)


def test_void_and_forced_types(spark):
    df = void_to_string(spark.sql("SELECT NULL AS v, '12' AS n, ' ' AS e"))
    assert df.schema["v"].dataType == T.StringType()
    assert forced_types(df, {"n": "int", "e": "int"}).collect()[0][1:] == (12, None)
    with pytest.raises(RecipeError, match="v|n"):
        forced_types(spark.sql("SELECT 'x' AS n"), {"n": "int"})


def test_evolution():
    old = parse_schema("a:int|b:string")
    assert check_evolution(old, parse_schema("a:int|b:string|c:int")) == ["c"]
    for new, code in (("a:int", "ELIMINACION_COLUMNAS"), ("b:string|a:int", "REORDENAMIENTO_COLUMNAS"), ("a:long|b:string", "CAMBIO_TIPO")):
        with pytest.raises(RecipeError) as e:
            check_evolution(old, parse_schema(new))
        assert e.value.code == code
