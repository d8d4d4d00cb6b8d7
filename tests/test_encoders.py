import pytest
from pyspark.sql import functions as F

from plan_text import executed_plan
from tabcycle.functions.columns import columns_of_type, column_types, input_features, shape
from tabcycle.functions.text import indicator_name, regex_all, regex_first, text_to_number, translate_values
from tabcycle.operators.assembly import FeatureAssembly
from tabcycle.operators.encoders import CastColumns, DropColumns, OneHotColumns, OrdinalMap, RegexNumber


@pytest.fixture
def people(spark):
    rows = [("a b", "x", 1), ("c", "y", 2), (None, "x", None), ("d!", "x", 4)]
    return spark.createDataFrame(rows, "word string, letter string, number int")


def columns(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def test_schema_helpers(people):
    assert list(column_types(people)) == ["word", "letter", "number"]
    for wanted in ("string", "StringType", "StringType()"):
        assert columns_of_type(people, wanted) == ["word", "letter"]
    assert columns_of_type(people, "int") == columns_of_type(people, "IntegerType") == ["number"]
    assert shape(people) == (4, 3)
    assert input_features(people, ["letter"]) == ["word", "number"]


@pytest.mark.parametrize(
    "value, name",
    [
        ("Yes (during pregnancy)", "Diabetic_Yes_during_pregnancy"),
        ("No, borderline diabetes", "Diabetic_No_borderline_diabetes"),
        ("a/b-c_d é", "Diabetic_abc_d_"),
    ],
)
def test_indicator_names(value, name):
    assert indicator_name("Diabetic", value) == name


def test_one_hot_null_and_drop_last(people):
    out = OneHotColumns(inputCols=["word", "letter"]).fit(people).transform(people)
    assert out.columns == ["number", "word_a_b", "word_c", "letter_x"]
    assert columns(out, "word_a_b", "word_c", "letter_x") == [(1, 0, 1), (0, 1, 0), (0, 0, 1), (0, 0, 1)]


def test_one_hot_keeps_a_single_remaining_value(people):
    encoder = OneHotColumns(inputCols=["letter"], excludeCategories={"letter": ["x"]}, dropOriginal=False)
    assert encoder.fit(people).transform(people).columns == ["word", "letter", "number", "letter_y"]


def test_one_hot_number_column_and_drop_cols(people):
    encoder = OneHotColumns(inputCols=["number"], dropCols=["word"], dropLast=False)
    out = encoder.fit(people).transform(people)
    assert out.columns == ["letter", "number", "number_1", "number_2", "number_4"]
    assert columns(out, "number_2") == [(0,), (1,), (0,), (0,)]


def test_one_hot_serves_the_categories_it_learned(spark, people):
    model = OneHotColumns(inputCols=["letter"], dropLast=False).fit(people)
    later = spark.createDataFrame([("q", "new", 1)], people.schema)
    assert columns(model.transform(later), "letter_x", "letter_y") == [(0, 0)]


def test_one_hot_refuses_clashing_names(spark):
    for values in (["a b", "a_b"], ["Yes", "yes"]):
        df = spark.createDataFrame([(v,) for v in values], "w string")
        with pytest.raises(ValueError, match="not unique"):
            OneHotColumns(inputCols=["w"], dropLast=False).fit(df)
    df = spark.createDataFrame([("k", 1), ("l", 2)], "w string, w_k int")
    with pytest.raises(ValueError, match="not unique"):
        OneHotColumns(inputCols=["w"]).fit(df)


def test_one_hot_refuses_what_is_no_category(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("w"), F.lit("x").alias("v"))
    with pytest.raises(ValueError, match="'w' has more than maxCategories=20"):
        OneHotColumns(inputCols=["w", "v"], maxCategories=20).fit(df)


def test_one_hot_fit_is_one_read_and_transform_none(people, jobs):
    encoder = OneHotColumns(inputCols=["word", "letter"])
    model = encoder.fit(people)
    out, started = jobs(lambda: model.transform(people))
    assert started == 0
    assert "Python" not in executed_plan(out)


def test_ordinal_map(people):
    out = OrdinalMap(mappings={"word": {"a b": 4.5, "c": 2}}).transform(people)
    assert out.columns == ["letter", "number", "word_transformed"]
    assert out.schema["word_transformed"].dataType.typeName() == "float"
    assert columns(out, "word_transformed") == [(4.5,), (2.0,), (0.0,), (0.0,)]
    out = OrdinalMap(mappings={"number": {1: 10, 4: 40}}, replaceNa=False, dropOriginal=False).transform(people)
    assert columns(out, "number_transformed") == [(10.0,), (None,), (None,), (40.0,)]
    out = OrdinalMap(mappings={"letter": {"y": 1}}, naValue=-1.0).transform(people)
    assert columns(out, "letter_transformed") == [(-1.0,), (1.0,), (-1.0,), (-1.0,)]


def test_large_mapping_is_joined(spark):
    df = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    mapping = {f"k{i}": f"v{i}" for i in range(0, 1000, 2)}
    out = translate_values(df, "k", mapping, "v")
    assert out.columns == ["k", "v"]
    got = {r.k: r.v for r in out.collect()}
    assert got == {f"k{i}": f"v{i}" if i % 2 == 0 else None for i in range(1000)}


@pytest.mark.parametrize(
    "text, number",
    [
        ("18", 18.0), (" 2.5 ", 2.5), ("-1e3", -1000.0), (".5", 0.5), ("18d", None), ("1f", None),
        ("", None), ("abc", None), (None, None), ("inf", float("inf")), ("0x10", None),
    ],
)
def test_text_to_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(text_to_number(F.col("t"))).first()[0] == number


def test_regex_follows_python_patterns(spark):
    df = spark.createDataFrame([("été 42 x7",), ("none",), (None,)], "t string")
    t = F.col("t")
    out = df.select(
        regex_first(t, r"\d+").alias("first"),
        regex_first(t, r"(?P<w>\w+) \d", as_number=False).alias("word"),
        regex_all(t, r"[a-z]?(\d+)").alias("every"),
    ).collect()
    assert [tuple(r) for r in out] == [(42.0, "été", ["42", "7"]), (None, None, []), (None, None, None)]
    with pytest.raises(ValueError, match="2 groups"):
        regex_first(t, r"(a)(b)")


def test_regex_stage(spark):
    df = spark.createDataFrame([("18-24",), ("80 or older",), ("",), (None,)], "age string")
    out = RegexNumber(inputCols=["age"], pattern="^.{0,2}").transform(df)
    assert columns(out, "age_transformed") == [(18.0,), (80.0,), (None,), (None,)]
    kept = RegexNumber(inputCols=["age"], pattern="[0-9]", firstOnly=False, dropOriginal=False).transform(df)
    assert kept.columns == ["age", "age_transformed"]
    assert columns(kept, "age_transformed")[0] == (["1", "8", "2", "4"],)


def test_cast_and_drop(people):
    out = CastColumns(types={"number": "string"}).transform(people)
    assert columns_of_type(out) == ["word", "letter", "number"]
    out = CastColumns(types={"word": "int"}, safe=True).transform(people)
    assert columns(out, "word") == [(None,)] * 4
    assert DropColumns(cols=["word", "absent"]).transform(people).columns == ["letter", "number"]


def test_assembly_keeps_slot_order(spark):
    train = spark.createDataFrame([(1, 2.0, 0)], "a int, b double, y int")
    model = FeatureAssembly(excludeCols=["y"]).fit(train)
    later = spark.createDataFrame([(0, 9.0, 7.0, 3)], "y int, extra double, b double, a int")
    assert list(model.transform(later).first()["features"]) == [3.0, 7.0]
    empty = spark.createDataFrame([(None, 1.0, 0)], train.schema)
    assert FeatureAssembly(excludeCols=["y"], handleInvalid="skip").fit(train).transform(empty).count() == 0
