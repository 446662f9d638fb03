"""Queries that apply lambdas to arrays; each is one narrow stage over the scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import arrays
from millrace.plans.catalogue import query, table
from millrace.workspace import fresh_name

# Four whole numbers per line item, the counterpart of readings() below.
READINGS_SQL = """
    WITH readings AS (
        SELECT l_orderkey, l_linenumber,
               [CAST(l_quantity AS INTEGER), l_linenumber,
                CAST(round(l_discount * 100) AS INTEGER),
                CAST(round(l_tax * 100) AS INTEGER)] AS temp
        FROM lineitem)
"""


def readings(spark, sf_dir):
    """Line items with four of their numbers as an array."""

    def hundredths(name):
        return F.round(F.col(name) * 100).cast("int")

    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array(
            F.col("l_quantity").cast("int"),
            "l_linenumber",
            hundredths("l_discount"),
            hundredths("l_tax"),
        ).alias("temp"),
    )


def keyed(df, **columns):
    return df.select(
        "l_orderkey", "l_linenumber", *[column.alias(name) for name, column in columns.items()]
    )


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber,
           CAST(to_json(list_transform(temp, lambda x: x + 1)) AS VARCHAR) AS plus_one,
           CAST(to_json(list_transform(temp, lambda x: (x * 9) // 5 + 32)) AS VARCHAR)
               AS fahrenheit
    FROM readings
""")
def array_transform(spark, sf_dir):
    return keyed(
        readings(spark, sf_dir),
        plus_one=F.to_json(F.transform("temp", lambda x: x + 1)),
        fahrenheit=F.to_json(F.transform("temp", arrays.to_fahrenheit)),
    )


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber,
           CAST(to_json(list_transform(temp, lambda x: x + l_orderkey)) AS VARCHAR) AS plus_key
    FROM readings
""")
def array_transform_capture(spark, sf_dir):
    key = F.col("l_orderkey")
    return keyed(
        readings(spark, sf_dir), plus_key=F.to_json(F.transform("temp", lambda x: x + key))
    )


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber,
           CAST(to_json(list_transform([temp[1:3], temp], lambda v:
               list_transform(v, lambda x: x + l_orderkey + len(v)))) AS VARCHAR) AS nested
    FROM readings
""")
def array_transform_nested(spark, sf_dir):
    nested = F.array(F.slice("temp", 1, 3), F.col("temp"))
    return keyed(
        readings(spark, sf_dir), nested=F.to_json(arrays.add_inside(nested, F.col("l_orderkey")))
    )


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber,
           CAST(to_json(list_transform(temp, lambda x: x > 5)) AS VARCHAR) AS high
    FROM readings
""")
def array_bool(spark, sf_dir):
    return keyed(
        readings(spark, sf_dir), high=F.to_json(F.transform("temp", lambda x: x > 5))
    )


# Spark's upper case of a sharp s is SS, as Unicode has it; DuckDB keeps one letter.
@query("""
    SELECT doc_id,
           array_to_string(list_transform(string_split(text, ' '), lambda x: lower(x)), '|')
               AS lower_words,
           array_to_string(list_transform(string_split(text, ' '),
               lambda x: upper(replace(x, 'ß', 'SS'))), '|') AS upper_words
    FROM documents
""")
def array_upper(spark, sf_dir):
    words = F.split("text", " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.array_join(F.transform(words, F.lower), "|").alias("lower_words"),
        F.array_join(F.transform(words, F.upper), "|").alias("upper_words"),
    )


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber,
           CAST(to_json(list_filter(temp, lambda x: x > 5)) AS VARCHAR) AS high,
           CAST(to_json(list_filter(temp, lambda x: x < 0)) AS VARCHAR) AS negative
    FROM readings
""")
def array_filter(spark, sf_dir):
    return keyed(
        readings(spark, sf_dir),
        high=F.to_json(F.filter("temp", lambda x: x > 5)),
        negative=F.to_json(F.filter("temp", lambda x: x < 0)),
    )


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber,
           len(list_filter(temp, lambda x: x % 10 = 1)) > 0 AS ends_in_one,
           len(list_filter(temp, lambda x: x = 45)) > 0 AS has_45
    FROM readings
""")
def array_exists(spark, sf_dir):
    return keyed(
        readings(spark, sf_dir),
        ends_in_one=F.exists("temp", lambda x: x % 10 == 1),
        has_45=F.exists("temp", lambda x: x == 45),
    )


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber, CAST(list_sum(temp) AS BIGINT) AS total,
           CAST(list_sum(temp) * 2 AS BIGINT) AS doubled
    FROM readings
""")
def array_sum(spark, sf_dir):
    return keyed(
        readings(spark, sf_dir),
        total=arrays.array_sum("temp"),
        doubled=arrays.array_sum("temp", lambda total: total * 2),
    )


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber, CAST(list_sum(temp) // len(temp) AS BIGINT) AS average
    FROM readings
""")
def array_avg_div(spark, sf_dir):
    return keyed(readings(spark, sf_dir), average=arrays.array_mean("temp"))


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber,
           CAST((list_sum(temp) // len(temp)) * 9 // 5 + 32 AS BIGINT) AS average_f
    FROM readings
""")
def array_avg_converted(spark, sf_dir):
    return keyed(
        readings(spark, sf_dir), average_f=arrays.array_mean("temp", arrays.to_fahrenheit)
    )


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber,
           CAST(list_sum(temp) // len(temp) AS BIGINT) AS average_all,
           CAST(list_sum(temp[1:2]) // 2 AS BIGINT) AS average_front,
           CAST(list_sum(temp[3:4]) // 2 AS BIGINT) AS average_back
    FROM readings
""")
def array_multi(spark, sf_dir):
    return keyed(
        readings(spark, sf_dir),
        average_all=arrays.array_mean("temp"),
        average_front=arrays.array_mean(F.slice("temp", 1, 2)),
        average_back=arrays.array_mean(F.slice("temp", 3, 2)),
    )


@query(READINGS_SQL + """
    , positive AS (
        SELECT l_orderkey, l_linenumber, list_transform(temp, lambda x: x + 1) AS v FROM readings)
    SELECT l_orderkey, l_linenumber,
           round(power(list_product(v), 0.25), 6) AS geomean,
           round(exp(list_sum(list_transform(v, lambda x: ln(x))) / 4), 6) AS log_geomean
    FROM positive
""")
def array_geomean(spark, sf_dir):
    positive = F.transform("temp", lambda x: x + 1)
    return keyed(
        readings(spark, sf_dir),
        geomean=F.round(arrays.geometric_mean(positive), 6),
        log_geomean=F.round(arrays.log_geometric_mean(positive), 6),
    )


@query(READINGS_SQL + """
    SELECT l_orderkey, l_linenumber,
           CAST(to_json(list_transform(temp, lambda x: x + l_orderkey)) AS VARCHAR) AS plus_key,
           CAST(to_json(list_filter(temp, lambda x: x > 5)) AS VARCHAR) AS high,
           len(list_filter(temp, lambda x: x = 45)) > 0 AS has_45,
           CAST(list_sum(temp) // 4 AS INTEGER) AS average,
           round(power(list_product(list_transform(temp, lambda x: x + 1)), 0.25), 6) AS geomean
    FROM readings
""")
def array_sql(spark, sf_dir):
    """The same lambdas in SQL text over a named view."""
    view = fresh_name("readings")
    readings(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT l_orderkey, l_linenumber,
               to_json(transform(temp, x -> x + l_orderkey)) AS plus_key,
               to_json(filter(temp, x -> x > 5)) AS high,
               exists(temp, x -> x = 45) AS has_45,
               reduce(temp, 0, (acc, x) -> acc + x, acc -> CAST(acc div size(temp) AS INT))
                   AS average,
               round(aggregate(temp, named_struct('product', 1.0D, 'n', 0),
                   (acc, x) -> named_struct('product', acc.product * (x + 1), 'n', acc.n + 1),
                   acc -> power(acc.product, 1.0D / acc.n)), 6) AS geomean
        FROM {view}
    """)


@query("""
    SELECT vec_id, round(sqrt(list_sum(list_transform(embedding,
           lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm
    FROM embeddings
""")
def embedding_norm(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.round(arrays.euclidean_norm("embedding"), 6).alias("norm")
    )
