import pytest

from sluice.plans import ddl, regions
from sluice.plans.router import Routed, Router, Rule, TableFilter, TableRoute, route_table
from sluice.sources import manifest


def test_default_routes():
    r = Router()
    assert r.route("a/b/my-schema-create.sql") == Routed("my", "", "schema-schema")
    assert r.route("x/db.tbl-schema.sql") == Routed("db", "tbl", "table-schema")
    assert r.route("db.tbl-schema-view.sql") == Routed("db", "tbl", "view-schema")
    assert r.route("db.tbl.0012.CSV") == Routed("db", "tbl", "csv", "0012") and r.route("db.tbl.x.parquet") == Routed("db", "tbl.x", "parquet")
    assert r.route("db.t-schema-trigger.sql") is None and r.route("notes.md") is None


def test_own_routes():
    r = Router([Rule(r"^(?P<schema>\w+)/(?P<tbl>\w+)_(\d+)\.(csv|sql)$", "$schema", "${tbl}_$$", "$4", "$3")], defaults=False)
    assert r.route("s/t_01.csv") == Routed("s", "t_$", "csv", "01") and r.route("s/t.csv") is None
    with pytest.raises(ValueError, match="sub pattern"):
        Rule("(a)", "$2", "", "csv")
    with pytest.raises(ValueError, match="not supported"):
        Rule(r"(.*)\.csv\.(gz)", "s", "$1", "csv", "", "$2").route("a.csv.gz")


def test_filter_and_table_routes():
    f = TableFilter()
    assert f.keeps("Shop", "t") and not f.keeps("mysql", "user") and not f.keeps("information_schema", "x")
    g = TableFilter(["shop.*", "!shop.tmp?", "shop.tmp1"])
    assert g.keeps("shop", "a") and not g.keeps("shop", "tmp2") and g.keeps("shop", "tmp1") and not g.keeps("other", "a")
    routes = [TableRoute("s*", "t*", "m", "all"), TableRoute("s*", "", "n")]
    assert route_table("s1", "t9", routes) == ("m", "all") and route_table("s1", "x", routes) == ("n", "x") and route_table("q", "t", routes) == ("q", "t")
    with pytest.raises(ValueError):
        route_table("s1", "t1", [*routes, TableRoute("s1", "t1", "other", "x")])


def files(*names):
    return [(n, n, 10 * (k + 1)) for k, n in enumerate(names)]


def test_manifest():
    m = manifest.build(files("a-schema-create.sql", "a.x-schema.sql", "a.x.2.csv", "a.x.1.csv", "a.y-schema.sql", "mysql.u-schema.sql", "a.v-schema.sql", "a.v-schema-view.sql"))
    assert [(t.name, t.size) for t in m.tables] == [("y", 0), ("x", 70)] and [f.path for f in m.tables[1].files] == ["a.x.1.csv", "a.x.2.csv"] and [v.name for v in m.views] == ["v"]
    for bad in (("a.x.csv",), ("a.x-schema.sql",), ("a-schema-create.sql", "d/a-schema-create.sql"), ("a-schema-create.sql", "a.v-schema-view.sql")):
        with pytest.raises(ValueError):
            manifest.build(files(*bad))
    m = manifest.build(files("s1-schema-create.sql", "s1.t1-schema.sql", "s1.t1.csv", "s2.t2-schema.sql", "s2.t2.csv"), routes=[TableRoute("s*", "t*", "m", "u")])
    assert [(t.schema, t.name, len(t.files)) for t in m.tables] == [("m", "u", 2)] and list(m.schemas) == ["m"]


def test_regions():
    plan = regions.table_regions([regions.file_regions("a", "csv", 100, 4), regions.file_regions("b", "sql", 60, 4), regions.file_regions("c", "parquet", 7, 4)])
    assert [(r.row_base, r.row_max) for r in plan] == [(0, 25), (25, 35), (35, 42)]
    cut = regions.file_regions("a", "csv", 100, 2, iter(range(7, 100, 7)), 30, 7, ("x", "y"))
    assert [(r.offset, r.end) for r in cut] == [(7, 42), (42, 77), (77, 100)] and cut[0].columns == ("x", "y")


def test_batches():
    assert regions.batch_numbers([1.0] * 10, 100) == [0] * 10
    numbers = regions.batch_numbers([5.0] * 7200, 100, 0.75, 1000)  # 36,000 bytes
    sizes = [5 * numbers.count(k) for k in range(max(numbers) + 1)]
    assert sum(sizes) == 36000 and sizes[0] <= 100 and all(b >= a for a, b in zip(sizes, sizes[1:-1])) and len(sizes) < 360
    assert len(set(regions.batch_numbers([1.0] * 1000, 100, 0.75, 4))) > 4


DDL = """/*!40101 SET NAMES binary*/;
CREATE TABLE IF NOT EXISTS `db`.`t` (
  `id` bigint(20) unsigned NOT NULL AUTO_INCREMENT COMMENT 'a, b (c)',
  a TINYINT(4) DEFAULT '-3', b DECIMAL(6,4), c SET('x','y,z'), d VARCHAR(9) NOT NULL DEFAULT 'it''s', e DATETIME DEFAULT now() ON UPDATE now(),
  f INT AS (a + 1) STORED, g BINARY(4), h BIGINT AUTO_RANDOM(3), i INT DEFAULT -5,
  PRIMARY KEY (`id`), UNIQUE KEY `u` (`d`(3), a), KEY k (b), CONSTRAINT fk FOREIGN KEY (a) REFERENCES z(q)
) ENGINE=InnoDB;"""


def test_ddl():
    t = ddl.parse_create_table(DDL)
    assert t.name == "t" and [c.name for c in t.columns] == ["id", "a", "b", "c", "d", "e", "f", "g", "h", "i"]
    assert t.primary_key == ["id"] and t.uniques == [["d", "a"]] and not t.implicit_row_id()
    assert [c.spark_type() for c in t.columns] == ["decimal(20,0)", "tinyint", "decimal(6,4)", "string", "string", "timestamp_ntz", "int", "binary", "bigint", "int"]
    by = {c.name: c for c in t.columns}
    assert by["c"].members == ["x", "y,z"] and by["f"].generated == "a + 1" and by["f"].stored and by["h"].auto_random == 3 and by["i"].default == "-5" and by["id"].auto_increment and not by["d"].nullable
    assert by["id"].bounds() == (0, 2**64 - 1) and by["a"].bounds() == (-128, 127)
    assert "primary_key" in ddl.spark_create_table(t, "db.t")
    with pytest.raises(ValueError):
        ddl.parse_create_table("CREATE TABLE t (a DECIMAL(65,30))").columns[0].spark_type()


def test_charsets():
    assert ddl.decode("é".encode()) == "é" and ddl.decode("中文".encode("gb18030")) == "中文" and ddl.decode("中文".encode("gb18030"), "gb18030") == "中文"
    with pytest.raises(ValueError):
        ddl.decode("中文".encode("gb18030"), "utf8mb4")
