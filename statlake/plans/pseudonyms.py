"""Pseudonymization: presets, types, policies, SQL functions, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from statlake.functions import policy as grammar
from statlake.operators.layout import spread
from statlake.operators.pseudonymize import depseudonymize, pseudonymize, register_functions
from statlake.plans.registry import query
from statlake.plans.workspace import KEYS, fresh_lake
from statlake.plans.workspace import table as stored_table
from statlake.streaming.changes import write_available


def table(spark, sf_dir, name):
    """A test table spread over the cores: the ciphers are CPU-heavy and the tables are small files."""
    return spread(stored_table(spark, sf_dir, name))


# -- presets: each token has the length and the alphabet of its value and can be restored ------


def _token_properties(df, key, value, function, pattern):
    """Whether each token keeps length and alphabet and restores to its value."""
    policy = [("token", function)]
    tokens = pseudonymize(df.withColumn("token", F.col(value)), policy, KEYS)
    both = depseudonymize(tokens.withColumn("plain", F.col("token")), [("plain", function)], KEYS)
    return both.select(
        key,
        (F.length("token") == F.length(value)).alias("same_length"),
        F.col("token").rlike(pattern).alias("in_alphabet"),
        (F.col("plain") == F.col(value)).alias("restored"),
    )


def _preset_sql(dataset, key):
    return f"SELECT {key}, true AS same_length, true AS in_alphabet, true AS restored FROM {dataset}"


@query("pseudo_digits", _preset_sql("orders", "o_orderkey"))
def pseudo_digits(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("text")
    )
    return _token_properties(orders, "o_orderkey", "text", "fpe-digits(key1)", "^[0-9]+$")


@query("pseudo_alphanumeric", _preset_sql("customer", "c_custkey"))
def pseudo_alphanumeric(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    pattern = "^[0-9A-Za-z]{8}#[0-9A-Za-z]+$"
    return _token_properties(customer, "c_custkey", "c_name", "fpe-alphanumeric(key1)", pattern)


@query("pseudo_text", _preset_sql("part", "p_partkey"))
def pseudo_text(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return _token_properties(part, "p_partkey", "p_name", "fpe-text(key2)", "^[0-9A-Za-z ]+$")


@query("pseudo_fnr", _preset_sql("customer", "c_custkey"))
def pseudo_fnr(spark, sf_dir):
    number = F.concat(
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", number.alias("fnr"))
    return _token_properties(customer, "c_custkey", "fnr", "fpe-fnr(key1)", "^[0-9]{11}$")


@query(
    "pseudo_apply_properties",
    """SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderkey) AS order_keys,
              count(DISTINCT o_orderpriority) AS priorities, true AS mostly_changed FROM orders""",
)
def pseudo_apply_properties(spark, sf_dir):
    """Tokens are as many as values, and nearly all differ from them."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    policy = "o_custkey=fpe-digits(key1);o_orderkey=fpe-digits(key1);o_orderpriority=fpe-text(key2)"
    tokens = pseudonymize(orders.withColumn("plain", F.col("o_orderkey")), policy, KEYS)
    return tokens.agg(
        F.count("*").alias("n"),
        F.countDistinct("o_custkey").alias("customers"),
        F.countDistinct("o_orderkey").alias("order_keys"),
        F.countDistinct("o_orderpriority").alias("priorities"),
        (F.count_if(F.col("plain") != F.col("o_orderkey")) > 0.99 * F.count("*")).alias("mostly_changed"),
    )


# -- types: restore(apply(x)) = x -------------------------------------------------------------


def _round_trip(name, dataset, key, column, value, as_text=False):
    result = f"CAST({value} AS VARCHAR)" if as_text else value

    @query(f"pseudo_roundtrip_{name}", f"SELECT {key}, {result} AS {column} FROM {dataset}")
    def run(spark, sf_dir):
        rows = table(spark, sf_dir, dataset).select(key, F.expr(value).alias(column))
        policy = {column: "fpe-alphanumeric(key1)"}
        restored = depseudonymize(pseudonymize(rows, policy, KEYS), policy, KEYS)
        return restored.select(key, F.col(column).cast("string")) if as_text else restored

    return run


_round_trip("string", "customer", "c_custkey", "c_name", "c_name")
_round_trip("long", "orders", "o_orderkey", "o_custkey", "o_custkey")
_round_trip("int", "customer", "c_custkey", "c_nationkey", "c_nationkey")
_round_trip("double", "orders", "o_orderkey", "o_totalprice", "o_totalprice")
_round_trip("float", "customer", "c_custkey", "balance", "CAST(c_acctbal AS FLOAT)")
_round_trip("boolean", "labels", "doc_id", "is_toxic", "toxic = 1")
_round_trip("date", "orders", "o_orderkey", "order_day", "CAST(o_orderdate AS DATE)", as_text=True)
_round_trip("timestamp", "events", "event_id", "ts", "ts")


# -- datasets, joins, SQL, streams --------------------------------------------------------------


@query("pseudo_write_read", "SELECT * FROM customer")
def pseudo_write_read(spark, sf_dir):
    lake = fresh_lake(spark)
    lake.write(
        stored_table(spark, sf_dir, "customer"),
        "/tables/customer",
        valuation="SENSITIVE",
        state="RAW",
        pseudo="c_name=fpe-alphanumeric(key1); c_nationkey = fpe-digits( key2 );c_mktsegment=fpe-text(key2)",
    )
    return lake.read("/tables/customer", pseudo="c_name;c_nationkey;c_mktsegment")


@query(
    "pseudo_join_consistency",
    "SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment",
)
def pseudo_join_consistency(spark, sf_dir):
    orders = pseudonymize(
        table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey=fpe-digits(key1)", KEYS
    )
    customer = pseudonymize(
        table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"),
        "c_custkey=fpe-digits(key1)",
        KEYS,
    )
    # counted by token before the join, so a customer with very many orders is one row in it
    counts = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    joined = counts.join(customer, counts.o_custkey == customer.c_custkey)
    return joined.groupBy("c_mktsegment").agg(F.sum("n").alias("n"))


@query(
    "pseudo_read_where",
    """SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
       WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey = 7""",
)
def pseudo_read_where(spark, sf_dir):
    """Predicates on restored columns, which reach the scan as tokens."""
    lake = fresh_lake(spark)
    policy = "c_name=fpe-text(key1);c_nationkey=fpe-digits(key1);c_mktsegment=fpe-alphanumeric(key2)"
    lake.write(table(spark, sf_dir, "customer"), "/tables/customer", valuation="SENSITIVE", state="RAW", pseudo=policy)
    where = {"c_mktsegment": ["BUILDING", "MACHINERY"], "c_nationkey": 7}
    found = lake.read("/tables/customer", pseudo="c_name;c_nationkey;c_mktsegment", where=where)
    return found.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query("pseudo_sql_udf", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def pseudo_sql_udf(spark, sf_dir):
    register_functions(spark, ["fpe-alphanumeric(key1)"], KEYS)
    table(spark, sf_dir, "customer").createOrReplaceTempView("statlake_customer")

    def trip(column, kind):
        name = f"pseudo_fpe-alphanumeric(key1)_{{}}_{kind}_udf"
        restore, apply = name.format("restore"), name.format("apply")
        return f"`{restore}`(`{apply}`({column})) AS {column}"

    return spark.sql(
        f"SELECT c_custkey, {trip('c_name', 'string')}, {trip('c_nationkey', 'integer')}, "
        f"{trip('c_acctbal', 'double')} FROM statlake_customer"
    )


@query("pseudo_stream", "SELECT event_id, user_id, props FROM events")
def pseudo_stream(spark, sf_dir):
    policy = {"user_id": "fpe-digits(key1)", "props": "fpe-digits(key1)"}
    schema = stored_table(spark, sf_dir, "events").schema
    # the bracket makes the path a pattern, which a stream may read whether it names a file or a folder
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet")
    tokens = pseudonymize(events.select("event_id", "user_id", "props"), policy, KEYS)
    root = fresh_lake(spark).root
    write_available(tokens, f"{root}/streams/events", f"{root}/streams/events-checkpoint")
    stored = spark.read.schema(tokens.schema).parquet(f"{root}/streams/events")
    return depseudonymize(spread(stored), policy, KEYS)


# -- policy grammar -----------------------------------------------------------------------------

_FUNCTION_SQL = "'fpe-digits(key' || c_nationkey || ')'"


def _policies(spark, sf_dir):
    """A policy option for each customer."""
    option = F.expr("concat(c_name, ' = fpe-digits( key', c_nationkey, ' ) ; ;', c_mktsegment)")
    customer = stored_table(spark, sf_dir, "customer")
    return customer.select("c_custkey", "c_name", "c_mktsegment", grammar.parse_option(option).alias("policy"))


@query(
    "policy_parse",
    f"""SELECT c_custkey, CAST(0 AS INT) AS position, c_name AS var, {_FUNCTION_SQL} AS pseudo_func FROM customer
        UNION ALL SELECT c_custkey, CAST(1 AS INT), c_mktsegment, 'undefined' FROM customer""",
)
def policy_parse(spark, sf_dir):
    entries = _policies(spark, sf_dir).select("c_custkey", F.posexplode("policy").alias("position", "entry"))
    return entries.select(
        "c_custkey", "position", F.col("entry.var").alias("var"), F.col("entry.pseudoFunc").alias("pseudo_func")
    )


@query(
    "policy_json_roundtrip",
    f"""SELECT c_custkey, '[{{"var":"' || c_name || '","pseudoFunc":"' || {_FUNCTION_SQL} ||
              '"}},{{"var":"' || c_mktsegment || '","pseudoFunc":"undefined"}}]' AS json,
              c_name || ';' || c_mktsegment AS vars FROM customer""",
)
def policy_json_roundtrip(spark, sf_dir):
    texts = _policies(spark, sf_dir).select("c_custkey", grammar.to_policy_json(F.col("policy")).alias("json"))
    variables = grammar.policy_vars(grammar.from_policy_json(F.col("json")))
    return texts.select("c_custkey", "json", F.array_join(variables, ";").alias("vars"))


@query(
    "policy_functions",
    f"""SELECT c_custkey, {_FUNCTION_SQL} || ';undefined' AS functions, {_FUNCTION_SQL} AS name_function,
              'undefined' AS segment_function, CAST(NULL AS VARCHAR) AS missing_function FROM customer""",
)
def policy_functions(spark, sf_dir):
    return _policies(spark, sf_dir).select(
        "c_custkey",
        F.array_join(grammar.policy_functions(F.col("policy")), ";").alias("functions"),
        grammar.function_of(F.col("policy"), F.col("c_name")).alias("name_function"),
        grammar.function_of(F.col("policy"), F.col("c_mktsegment")).alias("segment_function"),
        grammar.function_of(F.col("policy"), F.lit("no such column")).alias("missing_function"),
    )
