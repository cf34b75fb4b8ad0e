"""Driver tables -> the reference's data model.

Each view is written once as a list of ``(name, expression)`` pairs in SQL
that both Spark and DuckDB accept; the Spark side evaluates them with
``selectExpr`` over the joined driver tables, the oracle side wraps the very
same text in a CTE (``oracle_prefix``). Where the two dialects differ (JSON
field access) the expression is given per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal text out to as many tasks as ``tidewater.text.partitions`` says.

    Unset, as on a cluster, the input keeps the splits of its files. A
    session sets it for tables of one row group, which no reader can split.
    """
    n = df.sparkSession.conf.get("tidewater.text.partitions", None)
    return df.repartition(int(n)) if n else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- telemetry
# events -> (timestamp, id, antenna_id, bytes, app)
_JSON_K = {
    "spark": "get_json_object(props, '$.k')",
    "duckdb": "json_extract_string(props, '$.k')",
}


def _telemetry_cols(dialect: str):
    return [
        ("timestamp", "CAST(ts AS TIMESTAMP)"),
        ("id", "CAST(user_id AS STRING)" if dialect == "spark" else "CAST(user_id AS VARCHAR)"),
        ("antenna_id", f"CAST(CAST({_JSON_K[dialect]} AS INT) % 5 AS "
                       + ("STRING)" if dialect == "spark" else "VARCHAR)")),
        ("bytes", "CAST(round(value * 100) AS BIGINT)"),
        ("app", "event_type"),
    ]


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.selectExpr(*[f"{e} AS `{n}`" for n, e in _telemetry_cols("spark")])


def telemetry_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Kafka ``value`` payload: one JSON text per event, epoch seconds."""
    t = telemetry(spark, sf_dir)
    return t.select(F.to_json(F.struct(
        F.unix_timestamp("timestamp").alias("timestamp"), "id", "antenna_id",
        "bytes", "app")).alias("value"))


# -------------------------------------------------------------------- users
_USER_COLS = [
    ("id", {"spark": "CAST(c_custkey AS STRING)", "duckdb": "CAST(c_custkey AS VARCHAR)"}),
    ("name", "c_name"),
    ("email", "concat(lower(c_name), '@example.com')"),
    ("quota", "CAST(round(c_acctbal * 100) AS BIGINT)"),
]


def _pick(expr, dialect):
    return expr[dialect] if isinstance(expr, dict) else expr


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.selectExpr(*[f"{_pick(e, 'spark')} AS `{n}`" for n, e in _USER_COLS])


# ----------------------------------------------------------------- listings
# k = o_orderkey. Fixture values (fixed): dirty postcodes by k % 12, list
# items for amenities and features.
_ZIP = ("CASE k % 12 WHEN 0 THEN '28012' WHEN 1 THEN '28004' WHEN 2 THEN '28005' "
        "WHEN 3 THEN 'Madrid 28004' WHEN 4 THEN '2804' WHEN 5 THEN '2815' "
        "WHEN 6 THEN '280013' WHEN 7 THEN '28002' || chr(10) || '28002' "
        "WHEN 8 THEN '-' WHEN 9 THEN '' WHEN 10 THEN '20013' ELSE NULL END")
_AMEN = ("CASE WHEN k % 13 = 0 THEN NULL ELSE CASE k % 4 WHEN 0 THEN 'Wifi' "
         "WHEN 1 THEN 'Wifi,Kitchen' WHEN 2 THEN 'Wifi,Kitchen,Heating' "
         "ELSE 'Wifi,Kitchen,Heating,Washer' END END")
_FEAT = ("CASE WHEN k % 11 = 0 THEN NULL ELSE CASE k % 3 WHEN 0 THEN 'Host Has Profile Pic' "
         "WHEN 1 THEN 'Host Has Profile Pic,Is Location Exact' "
         "ELSE 'Host Has Profile Pic,Is Location Exact,Instant Bookable' END END")

_LISTING_COLS = [
    ("listing_id", "k"),
    ("price", "round(o_totalprice / 2000, 2)"),
    ("city", "CASE WHEN k % 19 = 0 THEN NULL ELSE r_name END"),
    ("neighbourhood", "CASE WHEN k % 29 = 0 THEN '' ELSE n_name END"),
    ("zipcode", _ZIP),
    ("room_type", "o_orderpriority"),
    ("property_type", "c_mktsegment"),
    ("accommodates", "1 + k % 10"),
    ("bathrooms", "CASE WHEN k % 31 = 0 THEN NULL ELSE 1 + k % 3 END"),
    ("bedrooms", "CASE WHEN k % 17 = 0 THEN NULL ELSE k % 5 END"),
    ("square_feet", "CASE WHEN k % 4 = 0 THEN NULL WHEN k % 7 = 0 THEN 0 "
                    "ELSE 150 + 10 * (k % 120) END"),
    ("amenities", _AMEN),
    ("features", _FEAT),
    ("host_since", {"spark": "CASE WHEN k % 23 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
                    "duckdb": "CASE WHEN k % 23 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END"}),
    ("response_time", "CASE WHEN k % 9 = 0 THEN NULL ELSE o_orderstatus END"),
    ("reviews_per_month", "CASE WHEN k % 8 = 0 THEN NULL ELSE c_acctbal / 1000 END"),
    ("mostly_null", "CASE WHEN k % 10 < 7 THEN NULL ELSE k END"),
    ("constant", "CASE WHEN k % 700 = 0 THEN 'other' ELSE 'none' END"),
]


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions by
    # definition of the schema: broadcasting them is bounded.
    nr = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(F.broadcast(nr), F.col("c_nationkey") == F.col("n_nationkey"))
          .withColumn("k", F.col("o_orderkey")))
    return j.selectExpr(*[f"{_pick(e, 'spark')} AS `{n}`" for n, e in _LISTING_COLS])


# ------------------------------------------------------------------ reviews
def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").selectExpr(
        "doc_id", "text AS review_text", "source",
        "CAST(CASE WHEN quality = 1 THEN 5 ELSE 1 END AS DOUBLE) AS overall")


# ------------------------------------------------------------ vectors, etc.
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.selectExpr("vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding", "label")


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.selectExpr("l_extendedprice AS y", "l_quantity AS x1", "l_discount AS x2")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


# ------------------------------------------------------------ oracle prefix
def oracle_prefix() -> str:
    """CTEs defining the same views in DuckDB over the driver tables."""
    def sel(cols):
        return ", ".join(f"{_pick(e, 'duckdb')} AS \"{n}\"" for n, e in cols)

    return (
        "WITH telemetry AS (SELECT " + sel(_telemetry_cols("duckdb")) + " FROM events), "
        "users AS (SELECT " + sel(_USER_COLS) + " FROM customer), "
        "listings AS (SELECT " + sel(_LISTING_COLS) + " FROM (SELECT *, o_orderkey AS k "
        "FROM orders JOIN customer ON o_custkey = c_custkey "
        "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) j), "
        "reviews AS (SELECT d.doc_id, text AS review_text, source, "
        "CAST(CASE WHEN quality = 1 THEN 5 ELSE 1 END AS DOUBLE) AS overall "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id), "
        "vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding, label FROM embeddings), "
        "houses AS (SELECT l_extendedprice AS y, l_quantity AS x1, l_discount AS x2 FROM lineitem) "
    )
