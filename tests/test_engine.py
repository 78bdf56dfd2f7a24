import json
import os
import random
import time
import urllib.request

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from sluice import config, control, loader
from sluice.functions import crc64
from sluice.operators import checksum, duplicates, encode, ranges
from sluice.plans import checkpoint as cp
from sluice.plans import ddl
from sluice.streaming import incremental


def encoded(spark, create, names, rows, **settings):
    spec = ddl.parse_create_table(create)
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows, 1)], f"{encode.ROW_ID} long, " + ", ".join(f"`{n}` string" for n in names))
    return encode.encode(df, spec, source_columns=names, **settings).orderBy(encode.ROW_ID).drop(encode.ROW_ID).collect()


SQLMODE = "CREATE TABLE t (id INT PRIMARY KEY, a TIMESTAMP NOT NULL, b TINYINT NOT NULL, c VARCHAR(1) CHARSET utf8mb4 NOT NULL, d SET('x','y') NOT NULL)"


def test_lenient_coercion(spark):
    rows = [("1", "9999-99-99", "999", "two", "d"), ("2", "2000-00-00 00:00:00", "-99999", "ðŸ¤©", "3"), ("3", None, None, "™", "17"), ("4", "2000-01-01 00:00:00", "100", "", "x,y"), ("5", "bad", "abc", None, None)]
    got = encoded(spark, SQLMODE, ["id", "a", "b", "c", "d"], rows, strict=False)
    assert [r.b for r in got] == [127, -128, 0, 100, 0]
    assert [r.c for r in got] == ["t", "ð", "™", "", ""]
    assert [r.d for r in got] == ["", "x,y", "", "x,y", ""]
    assert [r.a is not None for r in got] == [False, False, False, True, False]


@pytest.mark.parametrize("row", [("1", "9999-99-99", "1", "a", "x"), ("1", "2000-01-01", "999", "a", "x"), ("1", "2000-01-01", "1", "two", "x"), ("1", "2000-01-01", None, "a", "x"), ("1", "2000-01-01", "1", "a", "z")])
def test_strict_coercion(spark, row):
    with pytest.raises(Exception, match="(?i)cast|long|null|member"):
        encoded(spark, SQLMODE, ["id", "a", "b", "c", "d"], [row], strict=True)


def test_wide_types(spark):
    create = "CREATE TABLE t (a BIGINT UNSIGNED, b BIGINT, c DECIMAL(21,1), d DOUBLE, e BINARY(4), f ENUM('s','m'), g BIT(2), h CHAR(3), i FLOAT)"
    got = encoded(spark, create, list("abcdefghi"), [("18446744073709551614", "-9223372036854775806", "99999999999999999999.0", "18446744073709551616.0", "ab", "M", "3", "x  ", "1.5")])[0]
    assert (int(got.a), got.b, str(got.c), got.d, bytes(got.e), got.f, got.g, got.h, got.i) == (18446744073709551614, -9223372036854775806, "99999999999999999999.0", 1.8446744073709552e19, b"ab\0\0", "m", 3, "x", 1.5)
    low = encoded(spark, "CREATE TABLE t (a TINYINT UNSIGNED, b DECIMAL(4,2), c ENUM('s','m') NOT NULL)", list("abc"), [("-5", "12345.678", "2"), ("300", "1.239", "q"), ("1.5", "x", None)], strict=False)
    assert [(r.a, str(r.b), r.c) for r in low] == [(0, "99.99", "m"), (255, "1.24", ""), (2, "0.00", "s")]


def test_permutation():
    t = ddl.parse_create_table("CREATE TABLE t (a INT, b INT, c INT)")
    assert encode.permutation(["C", "a", "_db_rowid"], t) == [1, -1, 0, 2] and encode.permutation(None, t) == [0, 1, 2, -1]
    assert encode.permutation(["c", "zz"], t, ignored=["ZZ"]) == [-1, -1, 0, -1]
    with pytest.raises(ValueError, match="unknown columns in header"):
        encode.permutation(["c", "zz"], t)


def test_ids_and_defaults(spark):
    got = encoded(spark, "CREATE TABLE t (id TINYINT AUTO_INCREMENT PRIMARY KEY, x INT DEFAULT 123, y VARCHAR(5) DEFAULT 'a''b', z DATETIME DEFAULT CURRENT_TIMESTAMP, v INT, s INT AS (v * 2) STORED)", ["v"], [("4",), (None,)], task_time="2020-02-03 04:05:06")
    assert [(r.id, r.x, r.y, str(r.z), r.v, r.s) for r in got] == [(1, 123, "a'b", "2020-02-03 04:05:06", 4, 8), (2, 123, "a'b", "2020-02-03 04:05:06", None, None)]
    with pytest.raises(Exception, match="cast"):
        encoded(spark, "CREATE TABLE t (id TINYINT AUTO_INCREMENT PRIMARY KEY, v INT)", ["v"], [("1",)] * 128)
    ids = [r.id for r in encoded(spark, "CREATE TABLE t (id BIGINT AUTO_RANDOM(5) PRIMARY KEY, v INT)", ["v"], [("1",)] * 3)]
    assert len({i >> 58 for i in ids}) == 1 and [i & ((1 << 58) - 1) for i in ids] == [1, 2, 3]


def test_duplicates(spark):
    rows = [(1, 1, "old"), (2, 1, "new"), (3, 2, "only"), (4, None, "n1"), (5, None, "n2")]
    df = spark.createDataFrame(rows, f"{encode.ROW_ID} long, k int, v string")
    assert sorted(r.v for r in duplicates.resolve(df, ["k"], "replace").collect()) == ["n1", "n2", "new", "only"]
    assert sorted(r.v for r in duplicates.resolve(df, ["k"], "ignore").collect()) == ["n1", "n2", "old", "only"]
    with pytest.raises(ValueError, match="Duplicate entry '1' for key 'k'"):
        duplicates.resolve(df, ["k"], "error")
    assert duplicates.resolve(df.where("v <> 'old'"), ["k"], "error").count() == 4


def test_checksums(spark):
    assert int(crc64.of([b"123456789"])[0]) == 0x995DC9BBDF1939FA  # the published check value
    rng = random.Random(1)
    values = [bytes(rng.randrange(256) for _ in range(rng.randrange(40))) for _ in range(50)]

    def plain(b):
        c = 2**64 - 1
        for x in b:
            c ^= x
            for _ in range(8):
                c = c >> 1 ^ (crc64.POLYNOMIAL if c & 1 else 0)
        return c ^ (2**64 - 1)

    assert [int(x) for x in crc64.of(values)] == [plain(v) for v in values]
    df = spark.createDataFrame([(k, v, None) for k, v in enumerate(values)], "k int, b binary, n string")
    for how in ("md5", "crc64"):
        whole = checksum.checksum(df, hash_with=how).first()
        parts = checksum.checksum(df.repartition(5).withColumn("p", F.col("k") % 3), df.columns, by=["p"], hash_with=how)
        assert checksum.merge(parts).first() == whole and whole.total_rows == 50
    checksum.compare(checksum.checksum(df), checksum.checksum(df.repartition(3)))
    with pytest.raises(ValueError, match="checksum mismatched remote vs local"):
        checksum.compare(checksum.checksum(df), checksum.checksum(df.where("k > 0")))
    assert tuple(checksum.checksum(df.limit(0)).first()) == (0, 0, 0)


def test_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit("x" * 10).alias("v"))
    rows = ranges.range_sorted(df, ["k"], 96 << 22, 1000)
    parts = rows.rdd.glom().map(lambda p: [r.k for r in p]).collect()
    assert len(parts) == 4 and [k for p in parts for k in p] == list(range(1000))
    h = ranges.histogram(df, "k", F.lit(10), 1000, 10**9).orderBy("bucket").collect()
    assert [(r.low, r.high, r.n_keys) for r in h[:2]] == [(0, 99, 100), (100, 199, 100)] and sum(r.n_bytes for r in h) == 10_000


def test_checkpoint_store(spark, tmp_path):
    store = cp.Store(spark, str(tmp_path / "cp"))
    state = store.init(cp.TableState("`a`.`b`", "h", "t", batches={0: cp.Batch(chunks=[cp.Chunk("f", 0, 9, 0, 3)])}))
    state.advance("closed", 0)
    state.fail(0)
    store.put(state)
    again = store.get("`a`.`b`")
    assert again == state and again.status == 3 and again.batches[0].status == 9 and cp.status_name(9) == "invalid"
    with pytest.raises(ValueError, match="another definition"):
        store.init(cp.TableState("`a`.`b`", "other", "t"))
    store.dump(str(tmp_path / "dump"))
    assert spark.read.csv(str(tmp_path / "dump" / "chunks"), header=True).count() == 1
    store.ignore_error()
    assert store.get("`a`.`b`").status == 30
    state.status = 3
    store.put(state)
    assert store.destroy_error() == [("`a`.`b`", 0, 0)] and store.tables() == []
    assert cp.Store(spark, None).get("x") is None


def write(root, files):
    os.makedirs(root, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(root, name), "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())


def make(tmp_path, **target):
    c = config.Config()
    c.source.data_source_dir, c.target.dir = str(tmp_path / "in"), str(tmp_path / "out")
    for k, v in target.items():
        setattr(c.target, k, v)
    return c


DUMP = {
    "shop-schema-create.sql": "CREATE DATABASE shop;",
    "shop.items-schema.sql": "CREATE TABLE items (id INT PRIMARY KEY, name VARCHAR(20) NOT NULL, price DECIMAL(8,2), tag VARCHAR(5) DEFAULT 'new');",
    "shop.items.1.sql": "INSERT INTO items (id, name, price) VALUES (1,'a','1.50'),(2,'b''c',NULL);\nINSERT INTO items (name, id) VALUES ('d',3);",
    "shop.items.2.csv": 'Price,ID,name\n9.99,2,"again, \\"q\\"\nline"\n\n5,4,\\N\n',
    "shop.log-schema.sql": "CREATE TABLE log (msg TEXT, n INT);",
    "shop.log.csv": "msg,n\nx,1\nx,2\n",
    "shop.top-schema.sql": "CREATE TABLE top (id INT);",
    "shop.top-schema-view.sql": "CREATE VIEW `top` AS SELECT `id` FROM `shop`.`items` WHERE `id` > 2;",
}


def test_load(spark, tmp_path):
    write(tmp_path / "in", DUMP)
    done = loader.Loader(spark, make(tmp_path)).run_once()
    assert {r["table"]: r["rows"] for r in done} == {"`shop`.`items`": 4, "`shop`.`log`": 2}
    items = {r.id: r for r in spark.read.parquet(str(tmp_path / "out/shop/items")).collect()}
    assert (items[1].name, str(items[1].price), items[1].tag) == ("a", "1.50", "new")
    assert (items[2].name, str(items[2].price)) == ('again, "q"\nline', "9.99") and items[4].name == "" and items[3].price is None
    log = spark.read.parquet(str(tmp_path / "out/shop/log"))
    assert log.columns == [encode.ROW_ID, "msg", "n"] and log.select(encode.ROW_ID).distinct().count() == 2
    assert sorted(r.id for r in spark.table("top").collect()) == [3, 4]
    assert spark.read.parquet(str(tmp_path / "out/_statistics/shop.items")).where("column_name = 'id'").first().max_value == "4"


@pytest.mark.parametrize("policy,name", [("ignore", "b'c"), ("replace", 'again, "q"\nline')])
def test_on_duplicate(spark, tmp_path, policy, name):
    write(tmp_path / "in", DUMP)
    loader.Loader(spark, make(tmp_path, on_duplicate=policy)).run_once()
    assert spark.read.parquet(str(tmp_path / "out/shop/items")).where("id = 2").first().name == name


def test_errors_and_repair(spark, tmp_path):
    write(tmp_path / "in", DUMP)
    with pytest.raises(RuntimeError, match="Duplicate entry '2'"):
        loader.Loader(spark, make(tmp_path, on_duplicate="error")).run_once()
    again = loader.Loader(spark, make(tmp_path))
    with pytest.raises(RuntimeError, match="error-ignore"):
        again.run_once()
    assert [t for t, *_ in again.destroy_error()] == ["`shop`.`items`"]
    assert len(loader.Loader(spark, make(tmp_path)).run_once()) == 2
    write(tmp_path / "in", {"shop.log.csv": "msg,zz\nx,1\n"})
    with pytest.raises(RuntimeError, match="unknown columns in header"):
        loader.Loader(spark, make(tmp_path)).run_once()


def test_resume(spark, tmp_path, monkeypatch):
    rows = {f"d.t.{k}.csv": "a,b\n" + "".join(f"{k * 10 + i},{k}\n" for i in range(10)) for k in range(6)}
    write(tmp_path / "in", {"d-schema-create.sql": "", "d.t-schema.sql": "CREATE TABLE t (a INT PRIMARY KEY, b INT, c DATETIME DEFAULT now())", **rows})
    c = make(tmp_path)
    c.source.batch_size, c.source.batch_import_ratio = 60, 0.0
    first, scans = loader.Loader(spark, c), []
    scan = loader.Loader.scan

    def failing(self, spec, part, when):
        scans.append(part[0].batch)
        if len(scans) == 3:
            raise InterruptedError("lost")
        return scan(self, spec, part, when)

    monkeypatch.setattr(loader.Loader, "scan", failing)
    with pytest.raises(RuntimeError, match="lost"):
        first.run_once()
    done = first.store.get("`d`.`t`")
    assert sum(b.status >= 90 for b in done.batches.values()) == 2
    time.sleep(1.1)
    loader.Loader(spark, c).run_once()
    assert len(scans) == 1 + len(done.batches) and len(set(scans)) == len(done.batches)
    out = spark.read.parquet(str(tmp_path / "out/d/t"))
    assert out.count() == 60 and out.select("c").distinct().count() == 1
    assert not os.path.exists(tmp_path / "out/_checkpoints/`d`.`t`.json")


def test_strict_format_and_parquet(spark, tmp_path):
    write(tmp_path / "in", {"d-schema-create.sql": "", "d.t-schema.sql": "CREATE TABLE t (a INT, b VARCHAR(9))", "d.t.1.csv": "a,b\n" + "".join(f"{i},v{i}\n" for i in range(500)), "d.p-schema.sql": "CREATE TABLE p (k BIGINT PRIMARY KEY, v TEXT)"})
    spark.range(20).select(F.col("id").alias("K"), F.lit("x").alias("V")).coalesce(1).write.parquet(str(tmp_path / "tmp"))
    part = next(p for p in os.listdir(tmp_path / "tmp") if p.endswith(".parquet"))
    os.rename(tmp_path / "tmp" / part, tmp_path / "in" / "d.p.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        c = make(tmp_path)
        c.source.strict_format = True
        loader.Loader(spark, c).run_once()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    t = spark.read.parquet(str(tmp_path / "out/d/t"))
    assert t.count() == 500 and t.select(encode.ROW_ID).distinct().count() == 500 and [r.a for r in t.orderBy(encode.ROW_ID).collect()] == list(range(500))
    assert spark.read.parquet(str(tmp_path / "out/d/p")).agg(F.sum("k")).first()[0] == 190


def test_config():
    c = config.from_toml('task_id = "1"\n[source]\ndata-source-dir = "/a"\nfilter = ["x.*"]\n[source.csv]\nseparator = "|"\n[target]\ndir = "/b"\nsql-mode = "STRICT_TRANS_TABLES,NO_BACKSLASH_ESCAPES"\non-duplicate = "IGNORE"\n[post-restore]\nchecksum = false\n').check()
    assert c.strict and not c.backslash_escapes and c.target.on_duplicate == "ignore" and c.post_restore.checksum == "off" and c.source.csv.dialect().separator == "|"
    with pytest.raises(ValueError, match="unknown configuration key source.typo"):
        config.from_toml("[source]\ntypo = 1\n")
    for bad in ('[target]\non-duplicate = "x"', '[post-restore]\nanalyze = "maybe"', '[source.csv]\nseparator = ""'):
        with pytest.raises(ValueError):
            config.from_toml(bad, config.from_toml('[source]\ndata_source_dir = "a"\n[target]\ndir = "b"')).check()
    args = config.parser().parse_args(["-d", "/in", "--target", "/out", "-f", "a.*", "-f", "!b.*", "--checksum", "off", "--enable-checkpoint", "false"])
    c = config.from_args(args)
    assert c.source.filter == ["a.*", "!b.*"] and c.post_restore.checksum == "off" and not c.checkpoint.enable


def test_queue():
    q = control.TaskQueue()
    a, b, c = (q.push(config.Config()) for _ in range(3))
    assert q.move(c, True) and q.ids() == [c, a, b] and q.move(c, False) and q.remove(a) and not q.remove(a)
    assert q.pop()[0] == b and q.ids() == [c] and q.pop()[0] == c and q.pop(0.01) is None


def test_server(spark, tmp_path):
    write(tmp_path / "in", {k: v for k, v in DUMP.items() if "top" not in k})
    server = control.Server(spark)
    server.start()

    def ask(method, path, body=""):
        request = urllib.request.Request(f"http://127.0.0.1:{server.port}{path}", body.encode() or None, method=method)
        with urllib.request.urlopen(request) as r:
            text = r.read().decode()
        return json.loads(text) if text[:1] in "{[" else text

    try:
        task = ask("POST", "/tasks", f'[source]\ndata-source-dir = "{tmp_path}/in"\n[target]\ndir = "{tmp_path}/out"\n')
        assert task == {"id": 1}
        for _ in range(300):
            if server.done:
                break
            time.sleep(0.1)
        assert "sluice_tasks_done 1" in ask("GET", "/metrics") and ask("GET", "/tasks")["failed"] == {} and ask("PUT", "/pause") == {"paused": False}
        assert ask("PUT", "/loglevel", '{"level": "debug"}') == {"level": "DEBUG"} == ask("GET", "/loglevel")
        with pytest.raises(urllib.error.HTTPError):
            ask("GET", "/progress/table?t=x")
        with pytest.raises(urllib.error.HTTPError):
            ask("POST", "/tasks", "[nope]\n")
    finally:
        server.close()


def test_incremental(spark, tmp_path):
    spec = ddl.parse_create_table("CREATE TABLE t (k INT PRIMARY KEY, v VARCHAR(5))")
    put = lambda rows: spark.createDataFrame(rows, "K int, V string").write.mode("append").parquet(str(tmp_path / "in"))
    load = lambda: incremental.load_available(spark, str(tmp_path / "in"), spec, str(tmp_path / "out"), str(tmp_path / "cp"))
    put([(1, "a"), (2, "b")])
    load()
    put([(2, "c")])
    load()
    load()
    got = {r.k: r.v for r in incremental.loaded(spark, str(tmp_path / "out"), ["k"]).collect()}
    assert got == {1: "a", 2: "c"} and incremental.loaded(spark, str(tmp_path / "out")).count() == 3


def test_statements(spark):
    from sluice.operators import sql_sink
    from sluice.sources.parse import SqlParser

    df = spark.createDataFrame([(k, f"v'{k}\\\n") for k in range(200)], "k int, v string").repartition(3)
    out = sql_sink.statements(df, "a", "b", "ignore", ["k"], 500).collect()
    assert all(r.statement.startswith("INSERT IGNORE INTO `a`.`b` (`k`,`v`) VALUES (") and len(r.statement) < 600 for r in out) and len(out) > 5
    back = [row for r in out for _, _, row in SqlParser().rows(r.statement.encode())]
    assert sorted((int(k), v.decode()) for k, v in back) == [(k, f"v'{k}\\\n") for k in range(200)]


def test_catalog(spark):
    from sluice.sources import catalog

    spark.sql("CREATE DATABASE IF NOT EXISTS cat_db")
    spec = ddl.parse_create_table("CREATE TABLE t (a BIGINT UNSIGNED PRIMARY KEY, b DECIMAL(6,2), c VARCHAR(3), UNIQUE KEY u (b, c))")
    spark.sql("DROP TABLE IF EXISTS cat_db.t")
    spark.sql(ddl.spark_create_table(spec, "cat_db.t"))
    got = catalog.tables(spark, "cat_db")["t"]
    assert [c.name for c in got.columns] == ["a", "b", "c"] and [c.spark_type() for c in got.columns] == ["decimal(20,0)", "decimal(6,2)", "string"]
    assert got.primary_key == ["a"] and got.uniques == [["b", "c"]]
    assert catalog.variables({"SQL_MODE": "X", "other": "1"})["sql_mode"] == "X" and catalog.variables()["time_zone"] == "UTC"
    spark.sql("DROP TABLE cat_db.t")


def test_logs(caplog):
    from sluice import logs

    logs.redact(True)
    logs.log.warning("row %s of %d has 'se''cret'", "x", 17)
    logs.redact(False)
    assert caplog.records[-1].getMessage() == "row x of ? has ?"
    tries = []

    def work(error):
        tries.append(1)
        if len(tries) < 3:
            raise error
        return "done"

    assert logs.retried(lambda: work(OSError("lost"))) == "done" and len(tries) == 3
    tries.clear()
    with pytest.raises(ValueError):
        logs.retried(lambda: work(ValueError("bad")))
    assert len(tries) == 1


def test_read_lines_headers_by_file(spark, tmp_path):
    from sluice.sources import dumps
    from sluice.sources.parse import Dialect

    (tmp_path / "a 1.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n3,4\n")
    rows = dumps.read_lines(spark, [str(tmp_path / "a 1.csv"), str(tmp_path / "b.csv")], dialect=Dialect()).collect()
    assert sorted(sorted((c, bytes(v)) for c, v in zip(r["columns"], r.fields)) for r in rows) == [[("x", b"1"), ("y", b"2")], [("x", b"4"), ("y", b"3")]]


@pytest.mark.parametrize("policy, want", [("replace", {(2, 2, 3), (None, 5, 4)}), ("ignore", {(1, 1, 1), (2, 2, 3), (None, 5, 4)})])
def test_several_unique_keys(spark, policy, want):
    """The rows that are left are those of a table into which all were put one by one."""
    rows = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (2, 2, 3), (None, 5, 4)], "pk int, u int, _row_id long")
    out = duplicates.resolve_all(rows, [["pk"], ["u"]], policy)
    assert {(r.pk, r.u, r._row_id) for r in out.collect()} == want


def test_checkpoint_survives_a_half_done_exchange(spark, tmp_path):
    store = cp.Store(spark, str(tmp_path / "c"))
    store.put(cp.TableState("`a`.`b`", "h", "t"))
    file = tmp_path / "c" / "`a`.`b`.json"
    file.rename(str(file) + ".next")  # the old file was deleted, the new one not yet in its place
    for crc in (tmp_path / "c").glob(".*.crc"):
        crc.unlink()
    assert store.tables() == ["`a`.`b`"]
    state = store.get("`a`.`b`")
    assert state.hash == "h" and file.exists()
    state.advance("closed")
    store.put(state)
    assert store.get("`a`.`b`").status == cp.STATUS["closed"] and store.tables() == ["`a`.`b`"]
    store.remove()
    assert store.tables() == [] and store.get("`a`.`b`") is None


def test_a_failed_move_leaves_the_old_table(spark, tmp_path):
    task = loader.Loader(spark, config.Config(config.Source(data_source_dir=str(tmp_path)), config.Target(dir=str(tmp_path / "t"))))
    (tmp_path / "t" / "s" / "x").mkdir(parents=True)
    (tmp_path / "t" / "s" / "x" / "old").write_text("1")
    with pytest.raises((OSError, Py4JJavaError)):
        task._move(str(tmp_path / "none"), str(tmp_path / "t" / "s" / "x"))
    assert (tmp_path / "t" / "s" / "x" / "old").exists()
    (tmp_path / "new").mkdir()
    (tmp_path / "new" / "fresh").write_text("2")
    task._move(str(tmp_path / "new"), str(tmp_path / "t" / "s" / "x"))
    assert [f.name for f in (tmp_path / "t" / "s" / "x").iterdir()] == ["fresh"] and not (tmp_path / "new.old").exists()
