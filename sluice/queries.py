"""Registered queries of the engine, with equivalent SQL: one for each operator or small group of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions import sqltext
from .operators import checksum as ck
from .operators import duplicates, encode, ranges, sql_sink
from .plans import checkpoint as cp
from .plans import ddl, regions
from .plans.router import Router, TableFilter, TableRoute, route_table
from .sources import manifest
from .staging import with_totals_before

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_REGISTRY: dict[str, tuple] = {}


def _query(sql: str | None):  # noqa: ANN202
    def add(f):  # noqa: ANN001, ANN202
        _REGISTRY[f.__name__] = (f, sql)
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _with_id(df: DataFrame, *keys: str) -> DataFrame:
    """Row ids in the order of the keys, for tables whose physical order SQL cannot see."""
    return with_totals_before(df, list(keys), **{encode.ROW_ID: F.lit(1)}).withColumn(encode.ROW_ID, F.col(encode.ROW_ID) + 1)


# Sources

@_query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_parquet_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "nation")
    upper = df.toDF(*[c.upper() for c in df.columns])
    return upper.toDF(*[c.lower() for c in upper.columns])


@_query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def scan_count_footer(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_read(spark, sf_dir, t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _round_trip(spark: SparkSession, df: DataFrame, kind: str) -> DataFrame:
    """df written as dump text by Spark, and read again by our parser, in memory of the tasks."""
    from .sources.dumps import PARSED, _emit
    from .sources.parse import CsvParser, Dialect, SqlParser

    names = df.columns
    kinds = dict(df.dtypes)
    if kind == "sql":
        text = F.concat(F.lit(f"INSERT INTO `t` ({','.join(map(sqltext.identifier, names))}) VALUES "), sqltext.tuple_literal(list(kinds.items())), F.lit(";\n"))
    else:
        quoted = [F.coalesce(F.concat(F.lit('"'), F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("\\N")) for c in names]
        text = F.concat(F.concat_ws(",", *quoted), F.lit("\n"))

    def parse(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            data = "".join(batch.column("text").to_pylist()).encode()
            rows = SqlParser().rows(data) if kind == "sql" else ((at, None, row) for at, row in CsvParser(Dialect(header=False)).records(data))
            yield from _emit("memory", rows, 0)

    parsed = df.select(text.alias("text")).mapInArrow(parse, PARSED)
    return parsed.select(*[F.get("fields", F.lit(k)).cast("string").cast(kinds[n]).alias(n) for k, n in enumerate(names)])


@_query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, _read(spark, sf_dir, "part"), "csv")


@_query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, _read(spark, sf_dir, "documents"), "csv")


@_query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def sqldump_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, _read(spark, sf_dir, "supplier"), "sql")


@_query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def sqldump_roundtrip_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, _read(spark, sf_dir, "documents"), "sql")


_PATHS = [
    ("a/shop-schema-create.sql", 10), ("a/shop.orders-schema.sql", 20), ("a/shop.orders.0001.sql", 500), ("a/shop.orders.0002.csv", 300), ("shop.items-schema.sql", 5), ("shop.items.parquet", 70),
    ("mysql.user-schema.sql", 5), ("mysql.user.csv", 9), ("shop.v-schema.sql", 4), ("shop.v-schema-view.sql", 6), ("shop.orders-schema-trigger.sql", 8), ("readme.txt", 3), ("SHOP.Extra.SQL", 11), ("shard1.t1.csv", 40), ("shard2.t2.csv", 30),
]
_PATH_VALUES = "(VALUES " + ", ".join(f"('{p}', {s})" for p, s in _PATHS) + ") AS f(path, size)"
_ROUTED_SQL = f"""
  SELECT path, size,
    CASE WHEN regexp_matches(path, '(-schema-trigger|-schema-post)\\.sql$', 'i') THEN 'ignore' WHEN regexp_matches(path, '^(?:[^/]*/)*([^/.]+)-schema-create\\.sql$', 'i') THEN 'schema-schema'
      WHEN regexp_matches(path, '^(?:[^/]*/)*([^/.]+)\\.(.*?)-schema\\.sql$', 'i') THEN 'table-schema' WHEN regexp_matches(path, '^(?:[^/]*/)*([^/.]+)\\.(.*?)-schema-view\\.sql$', 'i') THEN 'view-schema'
      WHEN regexp_matches(path, '^(?:[^/]*/)*([^/.]+)\\.(.*?)(?:\\.([0-9]+))?\\.(sql|csv|parquet)$', 'i') THEN lower(regexp_extract(path, '\\.([A-Za-z]+)$', 1)) ELSE 'ignore' END AS type,
    regexp_extract(path, '([^/.]+?)(-schema-create)?\\.[^/]*$', 1) AS db,
    coalesce(regexp_extract(path, '[^/.]+\\.(.+?)(-schema|-schema-view|\\.[0-9]+)?\\.(sql|csv|parquet)$', 1, 'i'), '') AS tbl
  FROM {_PATH_VALUES}"""


@_query(f"SELECT path, type, db, CASE WHEN type = 'schema-schema' THEN '' ELSE tbl END AS tbl FROM ({_ROUTED_SQL}) WHERE type <> 'ignore'")
def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    router = Router()
    rows = [(p, r.type, r.schema, r.table) for p, _ in _PATHS if (r := router.route(p))]
    return spark.createDataFrame(rows, "path string, type string, db string, tbl string")


@_query(f"SELECT DISTINCT db, tbl FROM ({_ROUTED_SQL}) WHERE type NOT IN ('ignore', 'schema-schema') AND lower(db) NOT IN ('mysql', 'sys', 'information_schema')")
def filter_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    router, keep = Router(), TableFilter()
    rows = sorted({(r.schema, r.table) for p, _ in _PATHS if (r := router.route(p)) and r.type != "schema-schema" and keep.keeps(r.schema, r.table)})
    return spark.createDataFrame(rows, "db string, tbl string")


@_query(f"SELECT path, CASE WHEN db LIKE 'shard%' THEN 'merged' ELSE db END AS db, CASE WHEN db LIKE 'shard%' THEN 'all' ELSE tbl END AS tbl FROM ({_ROUTED_SQL}) WHERE type IN ('sql', 'csv', 'parquet')")
def route_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    router, routes = Router(), [TableRoute("shard*", "t*", "merged", "all")]
    rows = [(p, *route_table(r.schema, r.table, routes)) for p, _ in _PATHS if (r := router.route(p)) and r.type in ("sql", "csv", "parquet")]
    return spark.createDataFrame(rows, "path string, db string, tbl string")


@_query(f"""SELECT db, tbl, CAST(sum(size) AS BIGINT) AS total, count(*) AS n_files, row_number() OVER (ORDER BY sum(size), db, tbl) AS place
  FROM ({_ROUTED_SQL}) WHERE type IN ('sql', 'csv', 'parquet') AND lower(db) <> 'mysql' GROUP BY db, tbl""")
def manifest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest.build([(p, p, s) for p, s in _PATHS], no_schema=True)
    rows = [(t.schema, t.name, t.size, len(t.files)) for t in found.tables if t.files]
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows, 1)], "db string, tbl string, total long, n_files long, place long")


@_query("SELECT * FROM orders")
def union_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "orders")
    shards = [df.where(F.col("o_orderstatus") == s) for s in ("F", "O")] + [df.where("o_orderstatus not in ('F', 'O') or o_orderstatus is null")]
    return shards[0].unionByName(shards[1]).unionByName(shards[2])


# Row ids, planning

@_query("SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS row_id FROM supplier")
def row_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_id(_read(spark, sf_dir, "supplier"), "s_suppkey").select("s_suppkey", F.col(encode.ROW_ID).cast("long").alias("row_id"))


_FILES = [("a.csv", "csv", 1000), ("b.csv", "csv", 2500), ("c.sql", "sql", 1400), ("d.parquet", "parquet", 77)]


@_query("""WITH f(k, path, kind, size) AS (VALUES (1, 'a.csv', 'csv', 1000), (2, 'b.csv', 'csv', 2500), (3, 'c.sql', 'sql', 1400), (4, 'd.parquet', 'parquet', 77)),
  n AS (SELECT *, CASE kind WHEN 'csv' THEN size // 5 WHEN 'sql' THEN size // 7 ELSE size END AS rows_most FROM f)
  SELECT path, CAST(sum(rows_most) OVER (ORDER BY k) - rows_most AS BIGINT) AS row_base, CAST(sum(rows_most) OVER (ORDER BY k) AS BIGINT) AS row_max FROM n""")
def region_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = regions.table_regions([regions.file_regions(p, k, s, 5) for p, k, s in _FILES])
    return spark.createDataFrame([(r.path, r.row_base, r.row_max) for r in plan], "path string, row_base long, row_max long")


@_query(None)
def engine_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = regions.batch_numbers([5.0] * 200, 100, 0.75, 1000)
    return spark.createDataFrame(list(enumerate(numbers)), "region int, batch int")


# Encode

_CUSTOMER = """CREATE TABLE customer (c_custkey BIGINT PRIMARY KEY, c_name VARCHAR(25) NOT NULL, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment CHAR(10), c_note VARCHAR(20) DEFAULT 'none')"""


@_query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'none' AS c_note FROM customer")
def column_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["C_MKTSEGMENT", "c_name", "C_AcctBal", "c_custkey", "c_nationkey"]
    df = _with_id(_read(spark, sf_dir, "customer"), "c_custkey").select(encode.ROW_ID, *names)
    return encode.encode(df, ddl.parse_create_table(_CUSTOMER), source_columns=names).drop(encode.ROW_ID)


@_query("SELECT o_orderkey AS id, 'pending' AS state, 7 AS priority, CAST(TIMESTAMP '2024-01-02 03:04:05' AS TIMESTAMP) AS loaded FROM orders")
def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ddl.parse_create_table("CREATE TABLE t (id BIGINT PRIMARY KEY, state VARCHAR(10) DEFAULT 'pending', priority INT NOT NULL DEFAULT 7, loaded DATETIME DEFAULT CURRENT_TIMESTAMP)")
    df = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(encode.ROW_ID), F.col("o_orderkey").alias("id"))
    return encode.encode(df, spec, source_columns=["id"], task_time="2024-01-02 03:04:05").drop(encode.ROW_ID)


@_query("SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey AS k FROM orders")
def auto_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ddl.parse_create_table("CREATE TABLE t (id BIGINT NOT NULL AUTO_INCREMENT PRIMARY KEY, k BIGINT)")
    df = _with_id(_read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")), "k")
    return encode.encode(df, spec, source_columns=["k"]).drop(encode.ROW_ID)


@_query("SELECT count(*) AS n, count(*) AS n_ids, CAST(1 AS BIGINT) AS n_headers, max(o_orderkey) AS max_low FROM orders")
def auto_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low bits are the row id; the header is one random value for the chunk."""
    spec = ddl.parse_create_table("CREATE TABLE t (id BIGINT AUTO_RANDOM(5) PRIMARY KEY, k BIGINT)")
    df = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(encode.ROW_ID), F.col("o_orderkey").alias("k"))
    rows = encode.encode(df, spec, source_columns=["k"])
    return rows.agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"), F.count_distinct(F.shiftright("id", 58)).alias("n_headers"), F.max(F.col("id").bitwiseAND(F.lit((1 << 58) - 1))).alias("max_low"))


@_query("SELECT CAST(max(o_orderkey) AS BIGINT) AS max_row_id, CAST(max(o_orderkey) AS BIGINT) AS max_auto_increment FROM orders")
def id_rebase(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ddl.parse_create_table("CREATE TABLE t (id BIGINT AUTO_INCREMENT PRIMARY KEY)")
    df = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(encode.ROW_ID), F.col("o_orderkey").alias("id"))
    out = encode.next_ids(encode.encode(df, spec, source_columns=["id"]), spec)
    return out.withColumn("max_auto_increment", F.col("max_auto_increment").cast("long"))


@_query("SELECT a, a + 1 AS b, a + 2 AS c, a + 3 AS d, a + 4 AS e FROM (SELECT CAST(p_size AS INTEGER) AS a FROM part)")
def generated_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ddl.parse_create_table("CREATE TABLE t (a INT, b INT AS (a + 1) VIRTUAL, c INT AS (b + 1) STORED, d INT AS (c + 1), e INT GENERATED ALWAYS AS (d + 1) STORED)")
    df = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias(encode.ROW_ID), F.col("p_size").alias("a"))
    return encode.encode(df, spec, source_columns=["a"]).drop(encode.ROW_ID)


@_query("SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_partkey > 127 THEN 127 ELSE l_partkey END AS TINYINT) AS small FROM lineitem")
def cast_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ddl.parse_create_table("CREATE TABLE t (l_orderkey BIGINT, l_linenumber INT, small TINYINT)")
    df = _read(spark, sf_dir, "lineitem").select(F.lit(0).cast("long").alias(encode.ROW_ID), "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("small"))
    return encode.encode(df, spec, strict=False, source_columns=["l_orderkey", "l_linenumber", "small"]).drop(encode.ROW_ID)


@_query("SELECT l_orderkey, l_linenumber, CAST(l_quantity AS SMALLINT) AS quantity FROM lineitem")
def cast_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ddl.parse_create_table("CREATE TABLE t (l_orderkey BIGINT, l_linenumber INT, quantity SMALLINT NOT NULL)")
    df = _read(spark, sf_dir, "lineitem").select(F.lit(0).cast("long").alias(encode.ROW_ID), "l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").cast("string").alias("quantity"))
    return encode.encode(df, spec, source_columns=["l_orderkey", "l_linenumber", "quantity"]).drop(encode.ROW_ID)


@_query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(o_custkey AS INTEGER) END AS custkey, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END AS priority FROM orders")
def null_to_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ddl.parse_create_table("CREATE TABLE t (o_orderkey BIGINT, custkey INT NOT NULL, priority VARCHAR(20) NOT NULL)")
    gone = lambda c: F.when(F.col("o_orderstatus") != "F", F.col(c))
    df = _read(spark, sf_dir, "orders").select(F.lit(0).cast("long").alias(encode.ROW_ID), "o_orderkey", gone("o_custkey").alias("custkey"), gone("o_orderpriority").alias("priority"))
    return encode.encode(df, spec, strict=False, source_columns=["o_orderkey", "custkey", "priority"]).drop(encode.ROW_ID)


@_query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS t FROM orders")
def bad_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ddl.parse_create_table("CREATE TABLE t (o_orderkey BIGINT, t DATETIME)")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.lit("0000-00-00 00:00:00")).otherwise(F.col("o_orderdate").cast("string"))
    df = _read(spark, sf_dir, "orders").select(F.lit(0).cast("long").alias(encode.ROW_ID), "o_orderkey", text.alias("t"))
    return encode.encode(df, spec, strict=False, source_columns=["o_orderkey", "t"]).drop(encode.ROW_ID)


@_query("SELECT p_partkey, substr(p_name, 1, 6) AS name FROM part")
def truncate_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ddl.parse_create_table("CREATE TABLE t (p_partkey BIGINT, name VARCHAR(6))")
    df = _read(spark, sf_dir, "part").select(F.lit(0).cast("long").alias(encode.ROW_ID), "p_partkey", F.col("p_name").alias("name"))
    return encode.encode(df, spec, strict=False, source_columns=["p_partkey", "name"]).drop(encode.ROW_ID)


@_query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) AS price FROM lineitem")
def decimal_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("price"))


@_query("SELECT n_nationkey, '(' || n_nationkey || ',''' || replace(replace(n_name, '\\', '\\\\'), '''', '''''') || ''',' || n_regionkey || ')' AS row_sql FROM nation")
def sql_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "nation")
    return df.select("n_nationkey", sqltext.tuple_literal(df.dtypes).alias("row_sql"))


# Duplicates

_ORDER = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


def _resolved(spark: SparkSession, sf_dir: str, policy: str) -> DataFrame:
    rows = _read(spark, sf_dir, "lineitem")
    return duplicates.resolve(rows, ["l_orderkey", "l_linenumber"], policy, [F.col(c.strip()) for c in _ORDER.split(",")])


def _winner(way: str) -> str:
    order = ", ".join(f"{c.strip()} {way}" for c in _ORDER.split(","))
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"


@_query(_winner("DESC"))
def dedupe_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir, "replace")


@_query(_winner("ASC"))
def dedupe_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir, "ignore")


@_query("""SELECT event_id, a, b FROM (SELECT event_id, user_id % 5000 AS a, CAST(floor(value * 100) AS BIGINT) AS b FROM events)
  QUALIFY event_id = max(event_id) OVER (PARTITION BY a) AND event_id = max(event_id) OVER (PARTITION BY b)""")
def dedupe_replace_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two unique keys: a row stays if it is the last under both."""
    rows = _read(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 5000).alias("a"), F.floor(F.col("value") * 100).alias("b"))
    return duplicates.resolve_all(rows, [["a"], ["b"]], "replace", [F.col("event_id")])


@_query("""WITH RECURSIVE r AS (SELECT s_suppkey, (s_suppkey * 37) % 101 AS a, (s_suppkey * 53) % 89 AS b, row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier),
  w AS (SELECT CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS s_suppkey, CAST([] AS BIGINT[]) AS used_a, CAST([] AS BIGINT[]) AS used_b, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b, FALSE AS stays
    UNION ALL SELECT n, s_suppkey, CASE WHEN ok THEN list_append(used_a, a) ELSE used_a END, CASE WHEN ok THEN list_append(used_b, b) ELSE used_b END, a, b, ok
    FROM (SELECT r.n, r.s_suppkey, r.a, r.b, w.used_a, w.used_b, NOT list_contains(w.used_a, r.a) AND NOT list_contains(w.used_b, r.b) AS ok FROM w JOIN r ON r.n = w.n + 1))
  SELECT s_suppkey, a, b FROM w WHERE stays""")
def dedupe_ignore_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two unique keys: a row stays if it shares neither with a row before it that stayed."""
    key = F.col("s_suppkey")
    rows = _read(spark, sf_dir, "supplier").select("s_suppkey", (key * 37 % 101).alias("a"), (key * 53 % 89).alias("b"))
    return duplicates.resolve_all(rows, [["a"], ["b"]], "ignore", [key])


@_query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_error_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.conflicts(_read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# Checksums, statistics

_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
_ROW = "concat_ws(chr(1), " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in _KEYS) + ")"
_SUMS = "CAST(sum(strlen(t)) AS BIGINT) AS total_bytes, count(*) AS total_rows, CAST(bit_xor(CAST(('0x' || substr(md5(t), 1, 15)) AS BIGINT)) AS BIGINT) AS checksum"


@_query(f"SELECT {_SUMS} FROM (SELECT {_ROW} AS t FROM lineitem)")
def checksum_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ck.checksum(_read(spark, sf_dir, "lineitem"), _KEYS)


@_query(f"SELECT {_SUMS} FROM (SELECT {_ROW} AS t FROM lineitem)")
def checksum_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ck.merge(ck.checksum(_read(spark, sf_dir, "lineitem"), _KEYS, by=["l_returnflag"]))


@_query(f"SELECT l_returnflag, {_SUMS} FROM (SELECT l_returnflag, {_ROW} AS t FROM lineitem) GROUP BY l_returnflag")
def checksum_by_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ck.checksum(_read(spark, sf_dir, "lineitem"), _KEYS, by=["l_returnflag"])


@_query("SELECT TRUE AS same, count(*) AS total_rows FROM orders")
def checksum_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, cols = _read(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"]
    again = df.repartition(7).select(*cols)
    a, b = ck.checksum(df, cols).alias("a"), ck.checksum(again, cols).alias("b")
    return a.join(b, F.col("a.total_rows") == F.col("b.total_rows"), "left").select(((F.col("a.checksum") == F.col("b.checksum")) & (F.col("a.total_bytes") == F.col("b.total_bytes"))).alias("same"), F.col("a.total_rows").alias("total_rows"))


@_query(None)
def crc64_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ck.checksum(_read(spark, sf_dir, "nation"), hash_with="crc64")


_STATS = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"]


@_query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value FROM lineitem" for c in _STATS))
def analyze_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ck.statistics(_read(spark, sf_dir, "lineitem"), _STATS)


# Ranges, pairs, chunks

@_query("SELECT count(*) AS n_rows, TRUE AS in_order, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders")
def range_partition_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges do not overlap: every partition's smallest key is above the largest of the one before."""
    rows = ranges.range_sorted(_read(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 96 << 23, 1)
    per = rows.groupBy(F.spark_partition_id().alias("p")).agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"), F.count("*").alias("n"))
    per = per.withColumn("before", F.lag("high").over(Window.orderBy("p")))
    return per.agg(F.sum("n").alias("n_rows"), F.min(F.coalesce(F.col("before") < F.col("low"), F.lit(True))).alias("in_order"), F.min("low").alias("low"), F.max("high").alias("high"))


@_query("SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS place FROM orders")
def sort_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_id(_read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey").select("o_orderkey", "o_custkey", F.col(encode.ROW_ID).cast("long").alias("place"))


@_query("""WITH k AS (SELECT l_orderkey AS k, CAST(sum(length(l_returnflag) + 40) AS BIGINT) AS b, count(*) AS n FROM lineitem GROUP BY 1),
  r AS (SELECT *, coalesce(sum(b) OVER w, 0) AS rb, coalesce(sum(n) OVER w, 0) AS rn FROM k WINDOW w AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  SELECT CAST(greatest(floor(rb / 65536), floor(rn / 1000)) AS BIGINT) AS bucket, min(k) AS low, max(k) AS high, CAST(sum(n) AS BIGINT) AS n_keys, CAST(sum(b) AS BIGINT) AS n_bytes FROM r GROUP BY 1""")
def size_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.histogram(_read(spark, sf_dir, "lineitem"), "l_orderkey", F.length("l_returnflag") + 40, 65536, 1000)


@_query("SELECT 'i' AS kind, 2 * count(*) AS n FROM orders UNION ALL SELECT 'r', count(*) FROM orders")
def classify_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = ranges.key_values(_read(spark, sf_dir, "orders"), ["o_orderkey"], {"cust": ["o_custkey"], "day": ["o_orderdate"]})
    return pairs.groupBy(F.substring("key", 1, 1).alias("kind")).agg(F.count("*").alias("n"))


@_query("""SELECT chunk, count(*) AS n_docs, CAST(sum(b) AS BIGINT) AS n_bytes, min(doc_id) AS first_doc FROM (
  SELECT doc_id, b, CAST(floor(coalesce(sum(b) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 100000) AS BIGINT) AS chunk FROM (SELECT doc_id, strlen(text) AS b FROM documents)) GROUP BY chunk""")
def split_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("b"))
    return ranges.byte_chunks(df, "doc_id", F.col("b"), 100_000).groupBy("chunk").agg(F.count("*").alias("n_docs"), F.sum("b").alias("n_bytes"), F.min("doc_id").alias("first_doc"))


@_query("SELECT CAST(count(*) AS BIGINT) AS n_rows, TRUE AS small, TRUE AS shaped FROM supplier")
def sql_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-row REPLACE statements of at most 4 KiB and one row."""
    out = sql_sink.statements(_read(spark, sf_dir, "supplier"), "shop", "supplier", "replace", ["s_suppkey"], 4096)
    shaped = F.col("statement").rlike(r"(?s)^REPLACE INTO `shop`\.`supplier` \(`s_suppkey`,.*\) VALUES \(.*\);$")
    return out.agg(F.sum("n_rows").alias("n_rows"), (F.max(F.octet_length("statement")) < 4096 + 300).alias("small"), F.min(shaped).alias("shaped"))


@_query("SELECT * FROM supplier")
def sql_statements_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statements parsed back into rows."""
    from .sources.dumps import PARSED, _emit
    from .sources.parse import SqlParser

    df = _read(spark, sf_dir, "supplier")

    def parse(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            for text in batch.column("statement").to_pylist():
                yield from _emit("memory", SqlParser().rows(text.encode()), 0)

    parsed = sql_sink.statements(df, "shop", "supplier", "ignore", ["s_suppkey"]).select("statement").mapInArrow(parse, PARSED)
    return parsed.select(*[F.get("fields", F.lit(k)).cast("string").cast(t).alias(n) for k, (n, t) in enumerate(df.dtypes)])


# Checkpoint tables

_T = [("`a`.`x`", "h1", 60), ("`a`.`y`", "h2", 6), ("`a`.`z`", "h3", 180), ("`b`.`w`", "h4", 9), ("`b`.`v`", "h5", 30)]
_B = [("`a`.`x`", -1, 30), ("`a`.`x`", 0, 60), ("`a`.`x`", 1, 120), ("`a`.`y`", -1, 3), ("`a`.`y`", 0, 120), ("`a`.`y`", 3, 6), ("`a`.`z`", 0, 120), ("`b`.`v`", 0, 30)]
_C = [("`a`.`x`", 0, 0, 10), ("`a`.`x`", 1, 0, 10), ("`a`.`z`", 0, 0, 5), ("`b`.`v`", 0, 0, 0)]
_v = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
_WITH = f"WITH t(table_name, hash, status) AS (VALUES {_v(_T)}), e(table_name, batch_id, status) AS (VALUES {_v(_B)}), c(table_name, batch_id, begin_at, pos) AS (VALUES {_v(_C)}) "


def _states(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    return spark.createDataFrame(_T, "table_name string, hash string, status int"), spark.createDataFrame(_B, "table_name string, batch_id int, status int"), spark.createDataFrame(_C, "table_name string, batch_id int, offset long, pos long")


@_query(_WITH + "SELECT table_name, batch_id, status FROM e WHERE status < 120")
def batch_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.pending(_states(spark)[1])


@_query(_WITH + "SELECT DISTINCT t.table_name, e.batch_id FROM t JOIN e USING (table_name) JOIN c ON c.table_name = e.table_name AND c.batch_id = e.batch_id WHERE t.status > 25 AND t.status < 140 AND e.status > 25 AND e.status < 120 AND c.pos > c.begin_at")
def local_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.local_tables(*_states(spark))


@_query(_WITH + "SELECT t.table_name, coalesce(min(e.batch_id), 0) AS min_batch, coalesce(max(e.batch_id), -1) AS max_batch FROM t LEFT JOIN e ON t.table_name = e.table_name WHERE t.status <= 25 GROUP BY t.table_name")
def destroy_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.destroyed(*_states(spark)[:2])


@_query(_WITH + "SELECT table_name, batch_id FROM e WHERE table_name NOT IN (SELECT table_name FROM t WHERE status <= 25)")
def destroy_keeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, batches, _ = _states(spark)
    return batches.join(tables.where(f"status <= {cp.STATUS['max_invalid']}"), "table_name", "left_anti").select("table_name", "batch_id")


@_query(_WITH + "SELECT table_name, hash, CASE WHEN status <= 25 THEN 30 ELSE status END AS status FROM t")
def ignore_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cp.ignored(_states(spark)[0])


@_query(_WITH + "SELECT * FROM e")
def checkpoint_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark)[1].orderBy("table_name", F.desc("batch_id"))


@_query(_WITH + "SELECT t.table_name, CAST(sum(CASE WHEN e.status >= 120 THEN 100 WHEN e.status >= 60 THEN 80 ELSE 0 END) / count(*) AS DOUBLE) AS percent FROM t JOIN e USING (table_name) GROUP BY t.table_name")
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, batches, _ = _states(spark)
    done = F.when(F.col("status") >= cp.STATUS["imported"], 100).when(F.col("status") >= cp.STATUS["all_written"], 80).otherwise(0)
    return tables.select("table_name").join(batches, "table_name").groupBy("table_name").agg((F.sum(done) / F.count("*")).alias("percent"))


# Verification queries and scalar functions

@_query("""SELECT l_returnflag, count(*) AS n, count(l_shipdate) AS n_dates, count(DISTINCT l_partkey) AS n_parts, CAST(sum(l_linenumber) AS BIGINT) AS lines, min(l_orderkey) AS low, max(l_orderkey) AS high, round(avg(l_quantity), 4) AS avg_qty FROM lineitem GROUP BY l_returnflag""")
def verify_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "lineitem").groupBy("l_returnflag")
    return df.agg(F.count("*").alias("n"), F.count("l_shipdate").alias("n_dates"), F.count_distinct("l_partkey").alias("n_parts"), F.sum("l_linenumber").alias("lines"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high"), F.round(F.avg("l_quantity"), 4).alias("avg_qty"))


@_query("SELECT o_orderkey FROM orders WHERE (o_totalprice BETWEEN 1000 AND 50000 AND o_orderstatus <> 'F') OR o_orderdate IS NULL OR (o_custkey NOT BETWEEN 10 AND 900 AND o_orderkey <= 5000)")
def verify_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").between(1000, 50000) & (F.col("o_orderstatus") != "F")
    return _read(spark, sf_dir, "orders").where(price | F.col("o_orderdate").isNull() | (~F.col("o_custkey").between(10, 900) & (F.col("o_orderkey") <= 5000))).select("o_orderkey")


@_query("""SELECT n_nationkey, sha1(n_name) AS sha, hex(n_name) AS hx, rpad(n_name, 12, '*') AS padded, upper(repeat(substr(n_name, 1, 1), 3)) AS rep, n_nationkey & 3 AS low_bits, n_nationkey >> 2 AS high_bits, CAST(pow(n_nationkey, 2) AS DOUBLE) AS squared, trim(n_name) AS trimmed FROM nation""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    return _read(spark, sf_dir, "nation").select(
        "n_nationkey", F.sha1("n_name").alias("sha"), F.hex("n_name").alias("hx"), F.rpad("n_name", 12, "*").alias("padded"), F.upper(F.repeat(F.substring("n_name", 1, 1), F.lit(3))).alias("rep"),
        n.bitwiseAND(F.lit(3)).alias("low_bits"), F.shiftright(n, 2).alias("high_bits"), F.pow(n, F.lit(2)).alias("squared"), F.trim("n_name").alias("trimmed"),
    )


@_query("SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events")
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))


_LINEITEM = "CREATE TABLE lineitem (l_orderkey BIGINT NOT NULL, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT NOT NULL, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag CHAR(1), l_linestatus CHAR(1), l_shipdate DATETIME, PRIMARY KEY (l_orderkey, l_linenumber))"


@_query(f"""SELECT 'lineitem' AS table_name, count(*) AS n_rows, CAST(sum(l_partkey) AS BIGINT) AS part_sum, CAST(bit_xor(CAST(('0x' || substr(md5({_ROW}), 1, 15)) AS BIGINT)) AS BIGINT) AS checksum FROM ({_winner("DESC")})""")
def load_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole path for a table: encode, resolve, sort by range, verify."""
    spec = ddl.parse_create_table(_LINEITEM)
    df = _read(spark, sf_dir, "lineitem")
    rows = encode.encode(df.withColumn(encode.ROW_ID, F.lit(0).cast("long")), spec, source_columns=df.columns)
    rows = duplicates.resolve(rows, spec.primary_key, "replace", [F.col(c.strip()) for c in _ORDER.split(",")])
    rows = rows.repartitionByRange(*[F.col(k) for k in spec.primary_key]).sortWithinPartitions(*spec.primary_key)
    text = ck.row_text(rows, _KEYS)
    return rows.agg(F.lit("lineitem").alias("table_name"), F.count("*").alias("n_rows"), F.sum("l_partkey").alias("part_sum"), F.bit_xor(ck.portable_hash(text)).alias("checksum"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_verified(spark, sf_dir)


def queries() -> dict:
    return {name: f for name, (f, _) in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _REGISTRY.items() if sql}
