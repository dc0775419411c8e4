"""Projection, filters, scalar and array functions, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearline.catalog.registry import PANEL_SQL, query, rounded
from wearline.functions import arrays, scalar
from wearline.operators import quality, rows
from wearline.operators.aggregates import stack
from wearline.operators.splits import sample_rows
from wearline.operators.transforms import downcast
from wearline.panel import engine_panel, table
from wearline.schema import ENTITY, columns_with_prefix, numeric_columns

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_KEY_SQL = ", ".join(LINE_KEY)


@query("select_by_prefix", PANEL_SQL + """
SELECT dataset_id, engine_id, cycle, sensor_1, sensor_2, sensor_3, sensor_4, sensor_5 FROM panel""")
def select_by_prefix(spark, sf):
    panel = engine_panel(spark, sf)
    return panel.select(*ENTITY, "cycle", *columns_with_prefix(panel.columns, "sensor_"))


@query("select_numeric", "SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_numeric(spark, sf):
    line = table(spark, sf, "lineitem")
    return line.select(*numeric_columns(line.schema, ("l_orderkey", "l_partkey", "l_suppkey")))


@query("project_drop", "SELECT o_orderkey, o_custkey, o_totalprice AS total_price, o_orderpriority FROM orders")
def project_drop(spark, sf):
    return table(spark, sf, "orders").drop("o_orderstatus", "o_orderdate").withColumnRenamed("o_totalprice", "total_price")


@query("derived_arithmetic", f"""
SELECT {LINE_KEY_SQL}, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge,
       round(l_extendedprice / l_quantity, 8) AS unit_price, l_quantity + l_linenumber AS plus,
       l_quantity - l_linenumber AS minus
FROM lineitem""")
def derived_arithmetic(spark, sf):
    line = table(spark, sf, "lineitem")
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return line.select(
        *LINE_KEY,
        F.round(price * (1 - F.col("l_discount")) * (1 + F.col("l_tax")), 6).alias("charge"),
        F.round(F.try_divide(price, quantity), 8).alias("unit_price"),
        (quantity + F.col("l_linenumber")).alias("plus"),
        (quantity - F.col("l_linenumber")).alias("minus"),
    )


@query("filter_predicates", f"""
SELECT {LINE_KEY_SQL}, l_quantity FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'R'""")
def filter_predicates(spark, sf):
    line = table(spark, sf, "lineitem")
    return line.where((F.col("l_quantity") > 30) & (F.col("l_returnflag") == "R")).select(*LINE_KEY, "l_quantity")


@query("filter_isin", """
SELECT 'chosen' AS mode, count(*) AS n FROM part WHERE p_type IN ('SMALL', 'ECONOMY')
UNION ALL SELECT 'empty shows all', count(*) FROM part
UNION ALL SELECT 'empty shows none', 0""")
def filter_isin(spark, sf):
    part = table(spark, sf, "part")
    modes = {
        "chosen": rows.keep_selected(part, "p_type", ["SMALL", "ECONOMY"], True),
        "empty shows all": rows.keep_selected(part, "p_type", [], True),
        "empty shows none": rows.keep_selected(part, "p_type", [], False),
    }
    return rows.union_all(*[d.agg(F.lit(m).alias("mode"), F.count(F.lit(1)).alias("n")) for m, d in modes.items()])


@query("rows_by_position", """
WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS p,
                  row_number() OVER (ORDER BY o_orderkey DESC) AS q FROM orders)
SELECT 'head' AS part, o_orderkey, o_totalprice FROM r WHERE p < 5
UNION ALL SELECT 'tail', o_orderkey, o_totalprice FROM r WHERE q <= 5
UNION ALL SELECT 'slice', o_orderkey, o_totalprice FROM r WHERE p >= 1 AND p < 3
UNION ALL SELECT 'label', o_orderkey, o_totalprice FROM r WHERE o_orderkey = 0""")
def rows_by_position(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    key = ["o_orderkey"]
    parts = {
        "head": rows.head(orders, key, 5),
        "tail": rows.tail(orders, key, 5),
        "slice": rows.rows_between(orders, key, 1, 3),
        "label": orders.where("o_orderkey = 0"),
    }
    return rows.union_all(*[d.select(F.lit(p).alias("part"), "o_orderkey", "o_totalprice") for p, d in parts.items()])


CELLS_SQL = """
WITH c AS (SELECT vec_id, cast(unnest(embedding) AS double) AS x,
                  generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
"""


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))


@query("positions_where", CELLS_SQL + """
SELECT vec_id, cast(i AS bigint) AS position FROM c WHERE x > 0.1""")
def positions_where(spark, sf):
    found = arrays.positions_where("e", lambda x: x > 0.1).cast("array<bigint>")
    return _vectors(spark, sf).select("vec_id", F.explode(found).alias("position"))


@query("conditional_value", f"""
SELECT {LINE_KEY_SQL},
       CASE WHEN l_discount > 0.05 THEN 'high' WHEN l_discount > 0.02 THEN 'mid' ELSE 'low' END AS level,
       CASE WHEN l_tax > 0 THEN l_tax ELSE 0.5 END AS tax_or_half
FROM lineitem""")
def conditional_value(spark, sf):
    level = F.when(F.col("l_discount") > 0.05, "high").when(F.col("l_discount") > 0.02, "mid").otherwise("low")
    tax = F.when(F.col("l_tax") > 0, F.col("l_tax")).otherwise(0.5)
    return table(spark, sf, "lineitem").select(*LINE_KEY, level.alias("level"), tax.alias("tax_or_half"))


@query("map_values", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS finished FROM orders""")
def map_values(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", scalar.map_values("o_orderstatus", {"F": 1, "O": 0}).alias("finished")
    )


@query("replace_values", f"""
SELECT {LINE_KEY_SQL}, CASE WHEN l_discount = 0 THEN 1 ELSE l_discount END AS discount,
       CASE WHEN l_linenumber <> 7 THEN l_tax END AS tax
FROM lineitem""")
def replace_values(spark, sf):
    line = table(spark, sf, "lineitem")
    tax = F.when(F.col("l_linenumber") == 7, F.lit(float("-inf"))).otherwise(F.col("l_tax"))
    return line.withColumn("raw_tax", tax).select(
        *LINE_KEY, scalar.replace_value("l_discount", 0.0, 1.0).alias("discount"),
        scalar.infinite_to_missing("raw_tax").alias("tax"),
    )


@query("ratio_feature", f"""
SELECT {LINE_KEY_SQL}, round_even(l_quantity / CASE WHEN l_discount > 0 THEN l_discount ELSE 0.5 END, 2) AS ratio
FROM lineitem""")
def ratio_feature(spark, sf):
    return table(spark, sf, "lineitem").select(*LINE_KEY, scalar.guarded_ratio("l_quantity", "l_discount").alias("ratio"))


@query("math_scalars", f"""
SELECT {LINE_KEY_SQL}, pow(l_quantity, 2) AS squared, round(abs(l_discount - 0.05), 6) AS distance,
       round_even(l_quantity / 4, 1) AS quarter
FROM lineitem""")
def math_scalars(spark, sf):
    return table(spark, sf, "lineitem").select(
        *LINE_KEY, F.pow("l_quantity", F.lit(2)).alias("squared"),
        F.round(F.abs(F.col("l_discount") - 0.05), 6).alias("distance"),
        F.bround(F.col("l_quantity") / 4, 1).alias("quarter"),
    )


@query("clip_bounds", PANEL_SQL + """
SELECT dataset_id, engine_id, cycle,
       CASE WHEN sensor_3 IS NOT NULL THEN greatest(sensor_3, 5) END AS at_least,
       CASE WHEN sensor_3 IS NOT NULL THEN least(sensor_3, 40) END AS at_most,
       CASE WHEN sensor_3 IS NOT NULL THEN least(greatest(sensor_3, 5), 40) END AS both
FROM panel""")
def clip_bounds(spark, sf):
    return engine_panel(spark, sf).select(
        *ENTITY, "cycle", scalar.clip("sensor_3", lower=5.0).alias("at_least"),
        scalar.clip("sensor_3", upper=40.0).alias("at_most"), scalar.clip("sensor_3", 5.0, 40.0).alias("both"),
    )


@query("log1p_skew", "SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 6) AS log_balance FROM customer")
def log1p_skew(spark, sf):
    return rounded(
        table(spark, sf, "customer").select("c_custkey", scalar.log1p_clipped("c_acctbal").alias("log_balance")),
        ["log_balance"],
    )


@query("cast_types", """
SELECT p_partkey, cast(p_size AS double) AS size_double, cast(p_partkey AS varchar) AS key_text,
       try_cast(p_type AS integer) AS type_number, cast(substr(p_brand, 7) AS integer) AS brand_number
FROM part""")
def cast_types(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size_double"), F.col("p_partkey").cast("string").alias("key_text"),
        F.col("p_type").try_cast("int").alias("type_number"),
        F.expr("substr(p_brand, 7)").try_cast("int").alias("brand_number"),
    )


@query("sample_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY (o_orderkey * 48271 + 42) % 2147483647, o_orderkey LIMIT 50""")
def sample_n(spark, sf):
    return sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 50)


EDGE_VALUES = {"to_127": 127, "to_128": 128, "to_32767": 32767, "to_32768": 32768}
WHOLE = ["l_orderkey", "l_partkey", "l_suppkey", *EDGE_VALUES]


def _kind_sql(c: str) -> str:
    source = f"(SELECT least(l_orderkey, {EDGE_VALUES[c]}) AS {c} FROM lineitem)" if c in EDGE_VALUES else "lineitem"
    fits = " ".join(f"WHEN min({c}) >= -{1 << bits - 1} AND max({c}) <= {(1 << bits - 1) - 1} THEN '{kind}'"
                    for kind, bits in (("tinyint", 8), ("smallint", 16), ("int", 32)))
    return f"SELECT '{c}' AS \"column\", CASE {fits} ELSE 'bigint' END AS kind, cast(sum({c}) AS double) AS total FROM {source}"


@query("downcast_types", " UNION ALL ".join(map(_kind_sql, WHOLE)) + """
UNION ALL SELECT 'l_quantity', 'float', sum(cast(l_quantity AS float)) FROM lineitem""")
def downcast_types(spark, sf):
    edges = [F.least("l_orderkey", F.lit(v)).alias(c) for c, v in EDGE_VALUES.items()]
    small = downcast(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", *edges, "l_quantity"))
    totals = small.agg(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("kind"),
                 F.sum(F.col(f.name).cast("double")).alias("total")).alias(f"_{i}")
        for i, f in enumerate(small.schema.fields)
    ])
    return stack(totals, [], len(small.columns))


@query("array_elementwise", """
WITH c AS (SELECT vec_id, unnest(generate_series(1, 64)) AS i, embedding AS e FROM embeddings),
p AS (SELECT vec_id, i, cast(e[i] AS double) AS a, cast(e[65 - i] AS double) AS b FROM c)
SELECT vec_id, cast(i - 1 AS bigint) AS i, round(a + b, 6) AS added, round(a - b, 6) AS subtracted,
       round(a * b, 6) AS multiplied, round(a / nullif(b, 0), 2) AS divided
FROM p""")
def array_elementwise(spark, sf):
    v = _vectors(spark, sf).withColumn("r", F.reverse("e"))
    names = {"added": "add", "subtracted": "sub", "multiplied": "mul", "divided": "div"}
    zipped = v.select("vec_id", F.arrays_zip(*[arrays.elementwise("e", "r", op).alias(n) for n, op in names.items()]).alias("z"))
    out = zipped.select("vec_id", F.posexplode("z").alias("i", "z")).select("vec_id", F.col("i").cast("long").alias("i"), "z.*")
    return rounded(rounded(out, ["added", "subtracted", "multiplied"]), ["divided"], 2)


@query("array_reshape", """
SELECT vec_id, cast(embedding[2] AS double) AS cell_0_1, cast(embedding[9] AS double) AS cell_1_0,
       round(cast(embedding[2] AS double) + embedding[3], 6) AS slice_sum, cast(len(embedding) AS bigint) AS flat_size,
       cast(embedding[64] AS double) AS flat_last
FROM embeddings""")
def array_reshape(spark, sf):
    v = _vectors(spark, sf).withColumn("m", arrays.reshape("e", 8, 8))
    part = F.aggregate(F.slice("e", 2, 2), F.lit(0.0), lambda a, x: a + x)
    return v.select(
        "vec_id", arrays.cell(F.col("m"), 0, 1).alias("cell_0_1"), arrays.cell(F.col("m"), 1, 0).alias("cell_1_0"),
        F.round(part, 6).alias("slice_sum"), F.size(F.flatten("m")).cast("long").alias("flat_size"),
        F.element_at(F.flatten("m"), -1).alias("flat_last"),
    )


@query("sort_engine_cycle", PANEL_SQL + "SELECT dataset_id, engine_id, cycle, sensor_1 FROM panel ORDER BY 1, 2, 3")
def sort_engine_cycle(spark, sf):
    return engine_panel(spark, sf).select(*ENTITY, "cycle", "sensor_1").orderBy(*ENTITY, "cycle")


@query("sort_desc", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC")
def sort_desc(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"))


@query("distinct_sorted", "SELECT DISTINCT l_suppkey FROM lineitem ORDER BY 1")
def distinct_sorted(spark, sf):
    return rows.distinct_sorted(table(spark, sf, "lineitem"), "l_suppkey")


@query("union_all_by_name", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def union_all_by_name(spark, sf):
    customers = table(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    suppliers = table(spark, sf, "supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS key", "s_name AS name")
    return rows.union_all(customers, suppliers)


@query("duplicate_count", """
SELECT 'all columns' AS subset, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_duplicates
FROM lineitem
UNION ALL SELECT 'order line', count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
FROM lineitem""")
def duplicate_count(spark, sf):
    line = table(spark, sf, "lineitem")
    whole = quality.duplicate_count(line).select(F.lit("all columns").alias("subset"), "n_duplicates")
    part = quality.duplicate_count(line, ["l_orderkey", "l_linenumber"]).select(F.lit("order line").alias("subset"), "n_duplicates")
    return whole.unionByName(part)


@query("dedup_keep_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity) AS r FROM lineitem)
WHERE r = 1""")
def dedup_keep_first(spark, sf):
    line = table(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity", "l_shipdate")
    return quality.drop_duplicates(line, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity"])


@query("drop_missing_rows", PANEL_SQL + "SELECT dataset_id, engine_id, cycle, sensor_3 FROM panel WHERE sensor_3 IS NOT NULL")
def drop_missing_rows(spark, sf):
    return engine_panel(spark, sf).select(*ENTITY, "cycle", "sensor_3").na.drop("any")
