import pytest
from pyspark.sql import functions as F

from statlake.functions import policy as grammar

OPTIONS = {
    # arguments, empty argument lists, empty entries, blanks around
    "ship=mask(k7 ,k8);port=flip();;  ;  crew=flip": [("ship", "mask(k7,k8)"), ("port", "flip()"), ("crew", "flip()")],
    # bare columns, one of them first
    "ship;;port ; crew=flip": [("ship", "undefined"), ("port", "undefined"), ("crew", "flip()")],
    "": [],
    " ; ;": [],
    # a repeated column keeps its place and takes the last function
    "a=f;b=g;a=h(1)": [("a", "h(1)"), ("b", "g()")],
    # more than one equals sign
    "a=b=c;d==e": [("d", "e()")],
    "=f": [("f", "undefined")],
}

DECLARATIONS = {
    # padding, empty arguments in the middle and at the end
    "  mask( x,, y , )   ": ("mask", ["x", "", "y", ""], "mask(x,,y,)"),
    # brackets count as blanks
    "mask x,, y ,": ("mask", ["x", "", "y", ""], "mask(x,,y,)"),
    "flip()": ("flip", [], "flip()"),
    "   flip  ": ("flip", [], "flip()"),
    "flip ( , )": ("flip", ["", ""], "flip(,)"),
    "fpe-digits(  harbour-9 )": ("fpe-digits", ["harbour-9"], "fpe-digits(harbour-9)"),
}


def test_options_as_columns(spark):
    rows = spark.createDataFrame([(o,) for o in OPTIONS], "o string")
    parsed = rows.select("o", grammar.parse_option(F.col("o")).alias("p")).collect()
    assert {r["o"]: [(m["var"], m["pseudoFunc"]) for m in r["p"]] for r in parsed} == OPTIONS


@pytest.mark.parametrize("option", OPTIONS)
def test_option_on_driver(option):
    assert grammar.parse_policy(option) == OPTIONS[option]


def test_declarations(spark):
    rows = spark.createDataFrame([(d,) for d in DECLARATIONS], "d string")
    parsed = rows.select(
        "d", grammar.declaration(F.col("d")).alias("p"), grammar.canonical(F.col("d")).alias("c")
    ).collect()
    assert {r["d"]: (r["p"]["name"], r["p"]["args"], r["c"]) for r in parsed} == DECLARATIONS
    for text, (name, args, _) in DECLARATIONS.items():
        assert grammar.parse_declaration(text) == (name, args)


def test_json(spark):
    text = '[{"var":"mast","pseudoFunc":"sail(red,2)"},{"var":"keel","pseudoFunc":"undefined"},{"var":"port","pseudoFunc":"moor()"}]'
    rows = spark.createDataFrame([(0, "mast = sail( red , 2 );;keel; port=moor ;"), (1, "")], "id int, o string")
    made = rows.select("id", grammar.to_policy_json(grammar.parse_option(F.col("o"))).alias("j"))
    assert {r["id"]: r["j"] for r in made.collect()} == {0: text, 1: "[]"}
    texts = spark.createDataFrame([(0, text), (1, "{broken"), (2, None), (3, "[]")], "id int, j string")
    policies = texts.select("id", grammar.from_policy_json(F.col("j")).alias("p"))
    variables = policies.select("id", grammar.policy_vars(F.col("p")).alias("v"))
    assert {r["id"]: r["v"] for r in variables.collect()} == {0: ["mast", "keel", "port"], 1: [], 2: [], 3: []}


def test_lookups(spark):
    policy = grammar.parse_option(F.col("o"))
    row = (
        spark.createDataFrame([("a=f(1);b=f( 1 );c",)], "o string")
        .select(
            grammar.policy_functions(policy).alias("functions"),
            grammar.function_of(policy, F.lit("b")).alias("b"),
            grammar.function_of(policy, F.lit("x")).alias("x"),
        )
        .first()
    )
    assert row["functions"] == ["f(1)", "undefined"] and row["b"] == "f(1)" and row["x"] is None
