"""Example queries over the TPC-H-like tables, each with its SQL counterpart.

``QUERIES[name](spark, folder)`` runs on ``<folder>/<table>.parquet``;
``ORACLES[name]`` gives the same rows in ANSI SQL over views of those tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe import jobs
from veilframe.functions import matches
from veilframe.functions.texts import ALPHABET
from veilframe.operators import link, profile, pseudonymize, tokenise
from veilframe.plans import LinkSpec, Policy
from veilframe.sources import read_table, write_table
from veilframe.sources.tables import shared_folder, write_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def treat(df: DataFrame, seed: int | None = None, **entries) -> DataFrame:
    return pseudonymize(df, Policy.from_dict(entries), seed)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def put_json(spark: SparkSession, path: str, value: dict) -> str:
    """Store a configuration where every executor can read it."""
    text = spark.createDataFrame([(json.dumps(value, ensure_ascii=False),)], "value string")
    text.coalesce(1).write.text(path)
    return path


def to_4(name: str) -> Column:
    """Means come from sums in some order; compare four decimals."""
    return F.round(name, 4).alias(name)


RANDOM_TEXT = f"^[{ALPHABET}]*$"


# Stateless treatments


@query("SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def delete(spark, folder):
    return treat(table(spark, folder, "customer"), c_name=["Delete"])


@query("""
SELECT c_custkey,
       '*' || substr(c_name, 1, 1) || repeat('*', length(c_name) - 2)
           || substr(c_name, length(c_name), 1) AS c_name
FROM customer""")
def mask(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_name")
    return treat(df, c_name=["Masking", "1:0-:1"])


@query("""
SELECT doc_id,
       CASE WHEN length(text) >= 6
            THEN '*' || substr(text, 1, 2) || repeat('*', length(text) - 5)
                     || substr(text, length(text) - 2, 3)
            ELSE '*' || substr(text, 1, 2) || repeat('*', greatest(length(text) - 2, 0))
       END AS text
FROM documents""")
def mask_documents(spark, folder):
    df = table(spark, folder, "documents").select("doc_id", "text")
    return treat(df, text=["Masking", "1:1:0-:1:1:1"])


@query("""
SELECT o_orderkey,
       CASE WHEN length(o_orderpriority) >= 8
            THEN '**' || substr(o_orderpriority, 2, length(o_orderpriority) - 6)
                      || repeat('*', 5)
            ELSE '**' || substr(o_orderpriority, 2)
       END AS o_orderpriority,
       '**' AS o_orderstatus
FROM orders""")
def mask_short_texts(spark, folder):
    """Texts shorter than their spec: the last mode set covers the rest."""
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return treat(
        df,
        o_orderpriority=["Masking", "0:1-:1:0:0:0:0:0"],
        o_orderstatus=["Masking", "0-:1:1:1"],
    )


@query("""
SELECT p_partkey, substr(p_brand, 1, 1) || substr(p_brand, length(p_brand), 1) AS p_brand
FROM part""")
def part_delete(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_brand")
    return treat(df, p_brand=["PartDelete", "1:0-:1"])


@query("""
SELECT page_id, substr(url, 8) AS url,
       CASE WHEN length(html) >= 4 THEN substr(html, 2, length(html) - 3)
            ELSE substr(html, 2) END AS html
FROM pages""")
def part_delete_pages(spark, folder):
    df = table(spark, folder, "pages").select("page_id", "url", "html")
    return treat(df, url=["PartDelete", "0:0:0:0:0:0:0:1-"], html=["PartDelete", "0:1-:0:0"])


@query("""
SELECT o_orderkey, floor(o_totalprice * 10 + 0.5::DOUBLE) / 10 AS o_totalprice
FROM orders""")
def round_half_up(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return treat(df, o_totalprice=["Round", "R", 2])


@query("""
SELECT c_custkey, ceil(c_acctbal / 100.0::DOUBLE) * 100 + 0.0::DOUBLE AS c_acctbal
FROM customer""")
def round_up(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return treat(df, c_acctbal=["Round", "RU", -2])


@query("""
SELECT c_custkey, floor(c_acctbal / 100.0::DOUBLE) * 100 AS c_acctbal
FROM customer""")
def round_down(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return treat(df, c_acctbal=["Round", "RD", -2])


def order_cells(spark, folder) -> DataFrame:
    """A text column that holds prices, and words for pending orders."""
    price = F.col("o_totalprice").cast("string")
    cell = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(price)
    return table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", cell.alias("cell"))


@query("""
SELECT o_orderkey, o_orderstatus = 'P' AS blank,
       CASE WHEN o_orderstatus <> 'P' THEN ceil(o_totalprice) END AS number
FROM orders""")
def round_text_cells(spark, folder):
    """Cells that are no numbers become empty; the row stays."""
    return treat(order_cells(spark, folder), cell=["Round", "RU", 1]).select(
        "o_orderkey", (F.col("cell") == "").alias("blank"), F.col("cell").try_cast("double").alias("number")
    )


@query("SELECT sha256(c_custkey::VARCHAR) AS c_custkey, sha256(c_name) AS c_name FROM customer")
def encrypt(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_name")
    return treat(df, c_custkey=["Encryption"], c_name=["Encryption"])


@query("SELECT conv_id, turn, role, sha256(text) AS text FROM conversations")
def encrypt_conversations(spark, folder):
    return treat(table(spark, folder, "conversations"), text=["Encryption"])


# Statistics and the treatments that use them


@query("""
WITH s AS (SELECT count(l_quantity) AS n, avg(l_quantity) AS a, stddev_pop(l_quantity) AS d,
                  min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
SELECT 'l_quantity' AS "column", '' AS conditions, 'Count' AS stat, n::DOUBLE AS value FROM s
UNION ALL SELECT 'l_quantity', '', 'Avg', round(a, 6) FROM s
UNION ALL SELECT 'l_quantity', '', 'Sd', round(d, 6) FROM s
UNION ALL SELECT 'l_quantity', '', 'Min', round(lo, 6) FROM s
UNION ALL SELECT 'l_quantity', '', 'Max', round(hi, 6) FROM s""")
def profile_columns(spark, folder):
    policy = Policy.from_dict({"l_quantity": ["TopBottom"]})
    found = profile(table(spark, folder, "lineitem"), policy, ("Count", "Avg", "Sd", "Min", "Max"))
    return found.withColumn("value", F.round("value", 6))


@query("""
WITH s AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS d FROM lineitem
           WHERE l_returnflag = 'R' AND l_linestatus = 'F')
SELECT 'l_quantity' AS "column", 'l_returnflag=R&l_linestatus=F' AS conditions, 'Avg' AS stat,
       round(a, 6) AS value FROM s
UNION ALL SELECT 'l_quantity', 'l_returnflag=R&l_linestatus=F', 'Sd', round(d, 6) FROM s""")
def profile_where(spark, folder):
    policy = Policy.from_dict(
        {
            "전처리": ["통계", "Avg", "Sd"],
            "l_quantity": ["MicroAggregation", "l_returnflag=R", "l_linestatus=F"],
        }
    )
    return profile(table(spark, folder, "lineitem"), policy).withColumn("value", F.round("value", 6))


@query("""
WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN l_extendedprice < m - d OR l_extendedprice > m + d
                  THEN m ELSE l_extendedprice END, 4) AS l_extendedprice
FROM lineitem, s""")
def top_bottom(spark, folder):
    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return treat(df, l_extendedprice=["TopBottom"]).withColumns({"l_extendedprice": to_4("l_extendedprice")})


@query("""
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders
           WHERE o_orderstatus <> 'P')
SELECT o_orderkey, o_orderstatus = 'P' AS blank,
       CASE WHEN o_orderstatus <> 'P'
            THEN round(CASE WHEN o_totalprice < m - d OR o_totalprice > m + d
                            THEN m ELSE o_totalprice END, 4) END AS number
FROM orders, s""")
def top_bottom_text_cells(spark, folder):
    return treat(order_cells(spark, folder), cell=["TopBottom"]).select(
        "o_orderkey",
        (F.col("cell") == "").alias("blank"),
        F.round(F.col("cell").try_cast("double"), 4).alias("number"),
    )


@query("""
WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS d FROM lineitem
           WHERE l_returnflag = 'R' AND l_linestatus = 'F')
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
                       AND (l_extendedprice < m - d OR l_extendedprice > m + d)
                  THEN m ELSE l_extendedprice END, 4) AS l_extendedprice
FROM lineitem, s""")
def micro_aggregation(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus"
    )
    treated = treat(df, l_extendedprice=["MicroAggregation", "l_returnflag=R", "l_linestatus=F"])
    return treated.select("l_orderkey", "l_linenumber", to_4("l_extendedprice"))


@query("""
SELECT p_partkey, p_size = 7 AND p_type = 'ECONOMY' AS hit FROM part
WHERE (p_size = 7 AND p_type = 'ECONOMY') OR p_type = 'PROMO'""")
def condition_filter(spark, folder):
    """The equality conditions on their own, as filter and as column."""
    df = table(spark, folder, "part")
    policy = Policy.from_dict(
        {
            "p_retailprice": ["MicroAggregation", "p_size=7", "p_type=ECONOMY"],
            "p_size": ["MicroAggregation", "p_type=PROMO"],
        }
    )
    first, second = [matches(df, t.conditions) for t in policy.treatments]
    return df.filter(first | second).select("p_partkey", first.alias("hit"))


def drawn_numbers(before: Column, drawn: Column) -> list[Column]:
    """What must hold of random numbers: in range, hardly one as before, centred, spread."""
    low, high = F.min(before), F.max(before)
    return [
        F.count("*").alias("n"),
        ((F.min(drawn) >= low) & (F.max(drawn) <= high)).alias("in_range"),
        (F.count_if(drawn == before) < 0.01 * F.count("*")).alias("changed"),
        (F.abs(F.avg(drawn) - (low + high) / 2) < 0.05 * (high - low)).alias("centred"),
        (F.abs(F.stddev_pop(drawn) * F.sqrt(F.lit(12.0)) / (high - low) - 1) < 0.05).alias("spread"),
    ]


@query("""
SELECT count(*) AS n, true AS in_range, true AS changed, true AS centred, true AS spread FROM lineitem""")
def random_number_in_range(spark, folder):
    df = table(spark, folder, "lineitem").select("l_quantity", F.col("l_quantity").alias("before"))
    drawn = treat(df, seed=1, l_quantity=["Random"])
    return drawn.agg(*drawn_numbers(F.col("before"), F.col("l_quantity")))


@query("SELECT c_custkey, length(c_mktsegment) AS n, true AS ok FROM customer")
def random_text_shape(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    drawn = F.col("c_mktsegment")
    return treat(df, seed=2, c_mktsegment=["Random"]).select(
        "c_custkey", F.length(drawn).cast("long").alias("n"), drawn.rlike(RANDOM_TEXT).alias("ok")
    )


@query("SELECT doc_id, length(text) AS n, true AS ok FROM documents")
def random_documents(spark, folder):
    df = table(spark, folder, "documents").select("doc_id", "text")
    drawn = F.col("text")
    return treat(df, seed=3, text=["Random"]).select(
        "doc_id", F.length(drawn).cast("long").alias("n"), drawn.rlike(RANDOM_TEXT).alias("ok")
    )


@query("""
SELECT count(*) FILTER (WHERE o_orderstatus <> 'P') AS n, true AS in_range, true AS changed,
       true AS centred, true AS spread,
       sum(length(o_orderpriority)) FILTER (WHERE o_orderstatus = 'P')::BIGINT AS letters, true AS texts
FROM orders""")
def random_mixed_cells(spark, folder):
    """Each cell by what it holds: a number in range, or a text of its length."""
    df = order_cells(spark, folder).withColumn("before", F.col("cell"))
    drawn = treat(df, seed=4, cell=["Random"])
    word = F.col("o_orderstatus") == "P"
    number = lambda name: F.when(~word, F.col(name).try_cast("double"))
    text_ok = F.col("cell").rlike(RANDOM_TEXT) & (F.length("cell") == F.length("before"))
    figures = drawn_numbers(number("before"), number("cell"))
    return drawn.agg(
        F.count_if(~word).alias("n"),
        *figures[1:],
        F.sum(F.when(word, F.length("cell").cast("long"))).alias("letters"),
        (F.count_if(word & ~text_ok) == 0).alias("texts"),
    )


@query("""
SELECT o_orderkey, length(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS n, true AS ok FROM orders""")
def random_dates(spark, folder):
    """Cells that are neither numbers nor texts become texts of the length they print with."""
    df = table(spark, folder, "orders").select("o_orderkey", F.date_trunc("second", "o_orderdate").alias("d"))
    drawn = F.col("d")
    return treat(df, seed=6, d=["Random"]).select(
        "o_orderkey", F.length(drawn).cast("long").alias("n"), drawn.rlike(RANDOM_TEXT).alias("ok")
    )


@query("SELECT event_id, 10 AS n, CASE WHEN value > 50 THEN 4 ELSE 5 END AS m, true AS ok FROM events")
def random_days_and_flags(spark, folder):
    df = table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("date").alias("day"), (F.col("value") > 50).alias("high")
    )
    drawn = treat(df, seed=7, day=["Random"], high=["Random"])
    return drawn.select(
        "event_id",
        F.length("day").alias("n"),
        F.length("high").alias("m"),
        (F.col("day").rlike(RANDOM_TEXT) & F.col("high").rlike(RANDOM_TEXT)).alias("ok"),
    )


@query("""
WITH s AS (SELECT avg(l_extendedprice) AS pm, stddev_pop(l_extendedprice) AS pd,
                  avg(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qm,
                  stddev_pop(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qd
           FROM lineitem)
SELECT sha256(l_orderkey::VARCHAR) AS l_orderkey,
       '*' || substr(l_partkey::VARCHAR, 1, 1)
           || repeat('*', length(l_partkey::VARCHAR) - 1) AS l_partkey,
       CASE WHEN length(l_suppkey::VARCHAR) >= 2
            THEN substr(l_suppkey::VARCHAR, length(l_suppkey::VARCHAR), 1) ELSE '' END AS l_suppkey,
       l_linenumber,
       round(CASE WHEN l_returnflag = 'A' AND (l_quantity < qm - qd OR l_quantity > qm + qd)
                  THEN qm ELSE l_quantity END, 4) AS l_quantity,
       round(CASE WHEN l_extendedprice < pm - pd OR l_extendedprice > pm + pd
                  THEN pm ELSE l_extendedprice END, 4) AS l_extendedprice,
       floor(l_discount * 10 + 0.5::DOUBLE) / 10 AS l_discount,
       length(l_linestatus) AS linestatus_length, true AS linestatus_drawn,
       l_returnflag, l_shipdate
FROM lineitem, s""")
def all_treatments(spark, folder):
    """One policy with all eight treatments, in one projection."""
    treated = treat(
        table(spark, folder, "lineitem"),
        seed=5,
        l_orderkey=["Encryption"],
        l_partkey=["Masking", "1:0-"],
        l_suppkey=["PartDelete", "0-:1"],
        l_quantity=["MicroAggregation", "l_returnflag=A"],
        l_extendedprice=["TopBottom"],
        l_discount=["Round", "R", 2],
        l_tax=["Delete"],
        l_linestatus=["Random"],
    )
    return treated.withColumns(
        {
            "l_quantity": to_4("l_quantity"),
            "l_extendedprice": to_4("l_extendedprice"),
            "linestatus_length": F.length("l_linestatus").cast("long"),
            "linestatus_drawn": F.col("l_linestatus").rlike(RANDOM_TEXT),
        }
    ).drop("l_linestatus")


# Links


@query("""
SELECT c_name, c_mktsegment, o_orderkey, o_totalprice
FROM customer JOIN orders ON c_custkey = o_custkey""")
def token_join(spark, folder):
    spec = LinkSpec(["c_custkey"], ["o_custkey"], ["c_name", "c_mktsegment"], ["o_orderkey", "o_totalprice"])
    return link(table(spark, folder, "customer"), table(spark, folder, "orders"), spec)


@query("""
SELECT o_orderkey, o_totalprice, event_id, event_type
FROM orders JOIN events ON o_custkey = user_id""")
def m2m_join(spark, folder):
    """Many orders and many events per customer.

    The number of customers grows with both tables. On a key such as the nation
    the number of pairs would grow with the square of the data.
    """
    spec = LinkSpec(["o_custkey"], ["user_id"], ["o_orderkey", "o_totalprice"], ["event_id", "event_type"])
    return link(table(spark, folder, "orders"), table(spark, folder, "events"), spec)


def order_link(spark, folder, key_mode) -> DataFrame:
    """Each order with the figures of its customer's orders of the same status."""
    orders, keys = table(spark, folder, "orders"), ["o_custkey", "o_orderstatus"]
    groups = orders.groupBy(*keys).agg(
        F.count("*").alias("orders"), F.max("o_totalprice").alias("largest")
    )
    spec = LinkSpec(keys, keys, ["o_orderkey", "o_totalprice"], ["orders", "largest"], key_mode)
    return link(orders, groups, spec)


@query("""
SELECT a.c_name AS c_name_a, b.c_name AS c_name_b
FROM customer a JOIN customer b
  ON a.c_custkey::VARCHAR || a.c_nationkey::VARCHAR = b.c_custkey::VARCHAR || b.c_nationkey::VARCHAR""")
def concat_key_join(spark, folder):
    """Digits that run together: customer 1 of nation 12 meets customer 11 of nation 2."""
    keys, customer = ["c_custkey", "c_nationkey"], table(spark, folder, "customer")
    return link(customer, customer, LinkSpec(keys, keys, ["c_name"], ["c_name"], "concat"))


@query("""
WITH g AS (SELECT o_custkey, o_orderstatus, count(*) AS orders, max(o_totalprice) AS largest
           FROM orders GROUP BY o_custkey, o_orderstatus)
SELECT o_orderkey, o_totalprice, g.orders, g.largest
FROM orders o JOIN g ON o.o_custkey = g.o_custkey AND o.o_orderstatus = g.o_orderstatus""")
def composite_join(spark, folder):
    return order_link(spark, folder, "columns")


@query("""
WITH g AS (SELECT l_returnflag, count(*) AS lines, max(l_quantity) AS most FROM lineitem GROUP BY l_returnflag)
SELECT l_orderkey, l_linenumber, g.lines, g.most FROM lineitem l JOIN g ON l.l_returnflag = g.l_returnflag""")
def hot_key_join(spark, folder):
    """Each line with figures of its return flag: three keys, all of them hot."""
    lineitem = table(spark, folder, "lineitem")
    groups = lineitem.groupBy("l_returnflag").agg(F.count("*").alias("lines"), F.max("l_quantity").alias("most"))
    spec = LinkSpec(["l_returnflag"], ["l_returnflag"], ["l_orderkey", "l_linenumber"], ["lines", "most"])
    return link(lineitem, groups, spec, split_hot_keys=True, pairs_per_cell=500)


@query("""
SELECT o_orderkey, e.event_id
FROM orders o JOIN events e
  ON (CASE WHEN o_orderstatus = 'F' THEN o_custkey::VARCHAR ELSE '' END) = e.user_id::VARCHAR""")
def empty_keys_left_out(spark, folder):
    """Rows with an empty key are dropped on request instead of matching each other."""
    known = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).otherwise("")
    orders = table(spark, folder, "orders").withColumn("k", known)
    spec = LinkSpec(["k"], ["user_id"], ["o_orderkey"], ["event_id"], drop_empty_keys=True)
    return link(orders, table(spark, folder, "events"), spec)


@query("""
SELECT a.l_linestatus AS status_a, b.l_linestatus AS status_b, count(*) AS pairs
FROM lineitem a JOIN lineitem b ON a.l_orderkey // 64 = b.l_orderkey // 64 GROUP BY ALL""")
def hot_key_join_of_like_rows(spark, folder):
    """Keys with many lines on both sides, and hardly a difference among the rows that are wanted.

    Their pairs are counted, so the link returns like ones with their number.
    """
    lines = table(spark, folder, "lineitem").withColumn("k", F.floor(F.col("l_orderkey") / 64))
    spec = LinkSpec(["k"], ["k"], ["l_linestatus"], ["l_linestatus"])
    found = link(lines, lines, spec, split_hot_keys=True, pairs_per_cell=20_000, pairs="pairs")
    found = found.groupBy("l_linestatus_a", "l_linestatus_b").agg(F.sum("pairs").alias("pairs"))
    return found.withColumnsRenamed({"l_linestatus_a": "status_a", "l_linestatus_b": "status_b"})


@query("""
SELECT c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey""")
def link_to_tokens(spark, folder):
    """One side comes with keyed tokens in place of its keys, as its owner has written them."""
    path, secret = new_folder(spark), b"a shared secret"
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    write_table(tokenise(orders, ["o_custkey"], "token", secret=secret), path, "parquet")
    spec = LinkSpec.from_dict(
        {
            "join_key": {"A": ["c_custkey"], "B": {"token": "token"}},
            "column_list": {"A": ["c_name"], "B": ["o_orderkey", "o_totalprice"]},
        },
        secret=secret,
    )
    return link(table(spark, folder, "customer"), read_table(spark, path, "parquet"), spec)


# HMAC by its definition, with the secret "pepper" padded to 64 bytes and masked.
@query("""
SELECT c_custkey,
       sha256(unhex('2c392c2c392e' || repeat('5c', 58))
              || unhex(sha256(unhex('465346465344' || repeat('36', 58)) || encode(c_name)))) AS c_name
FROM customer""")
def encrypt_keyed(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_name")
    return treat(df, c_name=["Encryption", "key=pepper"])


# Tables and configurations on storage


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def text_table_round_trip(spark, folder):
    path, customer = new_folder(spark), table(spark, folder, "customer")
    write_table(customer, path)
    text = read_table(spark, path)
    return text.select(*[F.col(f.name).cast(f.dataType) for f in customer.schema])


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def nested_text_folders(spark, folder):
    path = new_folder(spark)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_table(orders.filter("o_orderstatus = 'F'"), f"{path}/finished")
    write_table(orders.filter("NOT o_orderstatus <=> 'F'"), f"{path}/other/open")
    text = read_table(spark, path)
    return text.select(*[F.col(f.name).cast(f.dataType) for f in orders.schema])


@query("""
WITH s AS (SELECT avg(l_extendedprice) AS pm, stddev_pop(l_extendedprice) AS pd,
                  avg(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qm,
                  stddev_pop(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qd
           FROM lineitem)
SELECT l_orderkey, l_linenumber,
       round(CASE WHEN l_returnflag = 'A' AND (l_quantity < qm - qd OR l_quantity > qm + qd)
                  THEN qm ELSE l_quantity END, 4) AS l_quantity,
       round(CASE WHEN l_extendedprice < pm - pd OR l_extendedprice > pm + pd
                  THEN pm ELSE l_extendedprice END, 4) AS l_extendedprice
FROM lineitem, s""")
def stored_statistics(spark, folder):
    """Statistics written by one job, with their conditions, and read by the next."""
    path = new_folder(spark)
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    policy = Policy.from_dict(
        {"l_quantity": ["MicroAggregation", "l_returnflag=A"], "l_extendedprice": ["TopBottom"]}
    )
    write_table(profile(df, policy), path, format="parquet")
    treated = pseudonymize(df, policy, statistics=read_table(spark, path, format="parquet"))
    return treated.select("l_orderkey", "l_linenumber", to_4("l_quantity"), to_4("l_extendedprice"))


@query("""
SELECT count(*) AS n, true AS same, true AS in_range, true AS changed, true AS centred, true AS spread,
       true AS shaped FROM orders""")
def random_by_identity(spark, folder):
    """Random cells that follow the row: the same however the table lies, and still uniform."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    policy = Policy.from_dict({"o_totalprice": ["Random"], "o_orderpriority": ["Random"]})
    dealt = orders.repartition(7, "o_orderpriority").sortWithinPartitions("o_totalprice")
    one, two = (pseudonymize(df, policy, seed=11, identity=["o_orderkey"]) for df in (orders, dealt))
    two = two.withColumnsRenamed({"o_totalprice": "x", "o_orderpriority": "y"})
    was = orders.withColumnsRenamed({"o_totalprice": "price", "o_orderpriority": "text"})
    joined = one.join(two, "o_orderkey").join(was, "o_orderkey")
    number, text = F.col("o_totalprice"), F.col("o_orderpriority")
    same = (number == F.col("x")) & (text == F.col("y"))
    shaped = text.rlike(RANDOM_TEXT) & (F.length(text) == F.length("text"))
    return joined.agg(*drawn_numbers(F.col("price"), number), F.min(same).alias("same"), F.min(shaped).alias("shaped"))


@query("SELECT c_custkey, sha256('pepper' || c_name) AS c_name FROM customer")
def encrypt_salted(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_name")
    return treat(df, c_name=["Encryption", "salt=pepper"])


@query("""
SELECT o_orderkey, (o_orderkey + 1152921504606846976)::VARCHAR AS wide,
       (o_totalprice::DECIMAL(30, 2) + 12345678901234567890)::DECIMAL(30, 2)::VARCHAR AS price
FROM orders WHERE o_orderstatus <> 'F'""")
def untouched_numbers(spark, folder):
    """Numbers that a double does not hold, under a condition that their rows do not meet."""
    wide = F.col("o_orderkey") + F.lit(1 << 60)
    price = (F.col("o_totalprice").cast("decimal(30,2)") + F.lit("12345678901234567890").cast("decimal(30,0)"))
    df = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", wide.alias("wide"), price.cast("decimal(30,2)").alias("price")
    )
    rule = ["MicroAggregation", "o_orderstatus=F"]
    treated = treat(df, wide=rule, price=rule).filter("o_orderstatus <> 'F'")
    return treated.select("o_orderkey", "wide", F.col("price").cast("string").alias("price"))


@query("""
WITH s AS (SELECT avg(l_partkey) AS m, stddev_pop(l_partkey) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey < m - d OR l_partkey > m + d AS mean,
       CASE WHEN l_partkey < m - d OR l_partkey > m + d THEN round(m, 4)::VARCHAR ELSE l_partkey::VARCHAR END AS l_partkey,
       CASE WHEN l_partkey < m - d OR l_partkey > m + d THEN floor(m + 0.5)::BIGINT ELSE l_partkey END AS rounded
FROM lineitem, s""")
def integers_with_means(spark, folder):
    """Keys whose ends become the mean: the others keep their digits, as text or as integers."""
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").alias("rounded")
    )
    rule = ["TopBottom"]
    texts = treat(df, l_partkey=rule)
    both = pseudonymize(texts, Policy.from_dict({"rounded": rule}), integers="round")
    # Means come from sums in some order: four decimals of them.
    mean = F.col("l_partkey").contains(".")
    figure = F.round(F.col("l_partkey").cast("double"), 4).cast("string")
    cell = F.when(mean, figure).otherwise(F.col("l_partkey"))
    return both.select("l_orderkey", "l_linenumber", mean.alias("mean"), cell.alias("l_partkey"), "rounded")


@query("SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS cell FROM customer")
def empty_cells_of_one_column(spark, folder):
    """A table of one column keeps its empty cells, which are blank lines."""
    path = new_folder(spark)
    cell = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_name"))
    write_table(table(spark, folder, "customer").select(cell.alias("cell")), path)
    return read_table(spark, path)


@query("""
SELECT 'l_extendedprice' AS "column", '' AS conditions, 'Min' AS stat, min(l_extendedprice) AS value
FROM lineitem
UNION ALL SELECT 'l_extendedprice', '', 'Max', max(l_extendedprice) FROM lineitem""")
def profile_job(spark, folder):
    path = new_folder(spark)
    policy = put_json(
        spark, f"{path}/policy", {"전처리": ["통계", "Min", "Max"], "l_extendedprice": ["Random"]}
    )
    write_table(table(spark, folder, "lineitem").select("l_extendedprice"), f"{path}/table")
    report = jobs.run_profile(spark, f"{path}/table", policy, f"{path}/out")
    return report.withColumn("value", F.col("value").cast("double"))


@query("""
WITH s AS (SELECT avg(l_extendedprice) AS a, stddev_pop(l_extendedprice) AS d,
                  min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
                  avg(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qa,
                  stddev_pop(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qd,
                  min(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qlo,
                  max(l_quantity) FILTER (WHERE l_returnflag = 'A') AS qhi FROM lineitem)
SELECT 'l_extendedprice' AS "column", '' AS conditions, 'Avg' AS stat, round(a, 4) AS value FROM s
UNION ALL SELECT 'l_extendedprice', '', 'Sd', round(d, 4) FROM s
UNION ALL SELECT 'l_extendedprice', '', 'Min', round(lo, 4) FROM s
UNION ALL SELECT 'l_extendedprice', '', 'Max', round(hi, 4) FROM s
UNION ALL SELECT 'l_quantity', 'l_returnflag=A', 'Avg', round(qa, 4) FROM s
UNION ALL SELECT 'l_quantity', 'l_returnflag=A', 'Sd', round(qd, 4) FROM s
UNION ALL SELECT 'l_quantity', 'l_returnflag=A', 'Min', round(qlo, 4) FROM s
UNION ALL SELECT 'l_quantity', 'l_returnflag=A', 'Max', round(qhi, 4) FROM s""")
def profile_in_parts(spark, folder):
    """A table that arrives in folders: each is read once, and the report is of all so far."""
    path, lines = new_folder(spark), table(spark, folder, "lineitem")
    lines = lines.select("l_linenumber", "l_extendedprice", "l_quantity", "l_returnflag")
    policy = put_json(
        spark,
        f"{path}/policy",
        {
            "전처리": ["통계", "Avg", "Sd", "Min", "Max"],
            "l_extendedprice": ["TopBottom"],
            "l_quantity": ["MicroAggregation", "l_returnflag=A"],
        },
    )
    some = F.col("l_linenumber")
    for i, part in enumerate([some == 1, some == 2, (some > 2) | some.isNull()]):
        write_table(lines.filter(part), f"{path}/part{i}", "parquet")
        report = jobs.run_profile(
            spark, f"{path}/part{i}", policy, f"{path}/report{i}", "parquet", parts=f"{path}/moments"
        )
    return report.withColumn("value", F.round("value", 4))


@query("""
SELECT o_orderkey::VARCHAR AS o_orderkey, '*' || o_orderstatus AS o_orderstatus,
       CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey || ',' || o_orderstatus || ',1,2' END AS record
FROM orders""")
def records_set_aside(spark, folder):
    """Lines with cells too many do not end the job: it goes on and writes them elsewhere."""
    path, orders = new_folder(spark), table(spark, folder, "orders")
    policy = put_json(spark, f"{path}/policy", {"o_orderstatus": ["Masking", "1-"]})
    line = F.concat_ws(",", "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, F.lit("1,2")))
    lines = orders.select(line.alias("o_orderkey,o_orderstatus"))
    write_lines(lines, f"{path}/table", header=True)
    jobs.run_pseudonymize(spark, f"{path}/table", policy, f"{path}/out", refused=f"{path}/refused")
    treated = read_table(spark, f"{path}/out").withColumn("record", F.lit(None).cast("string"))
    aside = read_table(spark, f"{path}/refused", quote='"')
    cells = F.split("record", ",")
    aside = aside.select(cells[0], F.concat(F.lit("*"), cells[1]), "record")
    return treated.union(aside)


@query("""
SELECT c_custkey::VARCHAR AS c_custkey, sha256(c_name) AS c_name,
       '*' || substr(c_mktsegment, 1, 1) || repeat('*', length(c_mktsegment) - 1) AS c_mktsegment,
       floor(c_acctbal) AS c_acctbal
FROM customer""")
def pseudonymize_job(spark, folder):
    path = new_folder(spark)
    policy = put_json(
        spark,
        f"{path}/policy",
        {
            "c_name": ["Encryption"],
            "c_mktsegment": ["Masking", "1:0-"],
            "c_acctbal": ["Round", "RD", "1"],
            "c_nationkey": ["Delete"],
        },
    )
    write_table(table(spark, folder, "customer"), f"{path}/table")
    jobs.run_pseudonymize(spark, f"{path}/table", policy, f"{path}/out")
    treated = read_table(spark, f"{path}/out")
    return treated.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("""
SELECT s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def link_job(spark, folder):
    path = new_folder(spark)
    spec = put_json(
        spark,
        f"{path}/spec",
        {
            "join_key": {"A": ["s_nationkey"], "B": ["n_nationkey"]},
            "column_list": {"A": ["s_name"], "B": ["n_name"]},
        },
    )
    write_table(table(spark, folder, "supplier"), f"{path}/a")
    write_table(table(spark, folder, "nation"), f"{path}/b")
    jobs.run_link(spark, f"{path}/a", f"{path}/b", spec, f"{path}/out")
    return read_table(spark, f"{path}/out")


@query("""
SELECT '*' || substr(s_name, 1, 1) || repeat('*', length(s_name) - 1) AS s_name, sha256(n_name) AS n_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def link_job_then_pseudonymize_job(spark, folder):
    """One job reads what the other wrote, both as they are by default."""
    path = new_folder(spark)
    keys = {"A": ["s_nationkey"], "B": ["n_nationkey"]}
    spec = put_json(spark, f"{path}/spec", {"join_key": keys, "column_list": {"A": ["s_name"], "B": ["n_name"]}})
    policy = put_json(spark, f"{path}/policy", {"s_name": ["Masking", "1:0-"], "n_name": ["Encryption"]})
    write_table(table(spark, folder, "supplier"), f"{path}/a")
    write_table(table(spark, folder, "nation"), f"{path}/b")
    jobs.run_link(spark, f"{path}/a", f"{path}/b", spec, f"{path}/linked")
    jobs.run_pseudonymize(spark, f"{path}/linked", policy, f"{path}/out")
    return read_table(spark, f"{path}/out")


# All of it


@query("""
WITH linked AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, o_orderkey, o_orderstatus,
                       o_totalprice
                FROM customer JOIN orders ON c_custkey = o_custkey),
     s AS (SELECT avg(c_acctbal) FILTER (WHERE o_orderstatus = 'F') AS bm,
                  stddev_pop(c_acctbal) FILTER (WHERE o_orderstatus = 'F') AS bd,
                  avg(o_totalprice) AS pm, stddev_pop(o_totalprice) AS pd FROM linked)
SELECT sha256(c_custkey::VARCHAR) AS c_custkey,
       '*' || substr(c_name, 1, 1) || repeat('*', length(c_name) - 2)
           || substr(c_name, length(c_name), 1) AS c_name,
       round(CASE WHEN o_orderstatus = 'F' AND (c_acctbal < bm - bd OR c_acctbal > bm + bd)
                  THEN bm ELSE c_acctbal END, 4) AS c_acctbal,
       o_orderkey,
       round(CASE WHEN o_totalprice < pm - pd OR o_totalprice > pm + pd
                  THEN pm ELSE o_totalprice END, 4) AS o_totalprice
FROM linked, s""")
def link_then_policy(spark, folder):
    """Link two tables, then treat the result.

    The treatment scans its input twice, so the link is stored in between, and
    removed when the result is written.
    """
    path = new_folder(spark)
    spec = LinkSpec(
        ["c_custkey"],
        ["o_custkey"],
        ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"],
        ["o_orderkey", "o_orderstatus", "o_totalprice"],
    )
    policy = Policy.from_dict(
        {
            "c_custkey": ["Encryption"],
            "c_name": ["Masking", "1:0-:1"],
            "c_acctbal": ["MicroAggregation", "o_orderstatus=F"],
            "c_mktsegment": ["Delete"],
            "o_orderstatus": ["Delete"],
            "o_totalprice": ["TopBottom"],
        }
    )
    customer, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    jobs.link_and_pseudonymize(customer, orders, spec, policy, path)
    treated = spark.read.parquet(path)
    return treated.withColumns({"c_acctbal": to_4("c_acctbal"), "o_totalprice": to_4("o_totalprice")})
