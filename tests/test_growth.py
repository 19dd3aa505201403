import csv
import datetime as dt
import random

import pyarrow as pa
from pyspark.sql import functions as F

from checks import etl
from checks.etl import csv_files
from tests.conftest import ROWS, changed, write_csv
from tillstar.operators import dedup, facts
from tillstar.operators.dedup import first_per_key, remove_duplicates, row_order
from tillstar.schemas import RAW, RAW_COLUMNS
from tillstar.sources import commerce, files
from tillstar.sources.records import _cut


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landing_files_are_written_by_the_tasks_that_read(spark, tmp_path):
    rows = [changed(ROWS[k % 3], Row_ID=str(k), Product_Name=f'"A", {k}\nnext' if k % 2 else None, City="\r" if k == 4 else f"é {k}") for k in range(40)]
    csv_files(spark.createDataFrame(rows, RAW).repartition(5), str(tmp_path / "in"))
    got, files = [], list((tmp_path / "in").glob("part-*"))
    assert len(files) == 5  # three before, however many rows
    for path in files:
        with open(path, newline="", encoding="utf-8") as source:
            head, *lines = csv.reader(source)
        assert tuple(head) == RAW_COLUMNS
        got += lines
    assert sorted(got) == sorted(["" if v is None else v for v in r] for r in rows)


def test_lines_without_quotes_are_cut_without_looking_at_each(monkeypatch):
    looked = []
    monkeypatch.setattr("tillstar.sources.records.ends_inside", lambda line, inside: looked.append(line) or False)
    lines = [b"a,b", *(b"%d,x" % k for k in range(50)), b'"q",x']
    n = len(lines)
    rows = pa.RecordBatch.from_arrays([pa.array(["f"] * n), pa.array([0] * n, pa.int64()), pa.array(lines, pa.binary()), pa.array([False] * n), pa.nulls(n, pa.int64())],
                                      ["path", "block", "value", "state", "owner"])
    out = [r for b in _cut(iter([rows])) for r in b.column("record").to_pylist()]
    assert sorted(out) == sorted(lines[1:]) and looked == [b'"q",x']


def test_rows_without_duplicates_stay_where_they_are(spark):
    rows = [changed(ROWS[k % 3], Row_ID=str(k), Order_ID=f"O{k // 2}") for k in range(30)]
    unique = spark.createDataFrame(rows, RAW).repartition(3)
    assert "Window" not in plan(remove_duplicates(unique))
    twice = unique.unionByName(spark.createDataFrame([changed(r, Row_ID=str(99 - k)) for k, r in enumerate(rows[:10])], RAW))
    null = spark.createDataFrame([changed(ROWS[0], Row_ID=str(k), Order_ID=None) for k in (200, 201)], RAW)
    kept = remove_duplicates(twice.unionByName(null)).collect()
    assert sorted(r["Row ID"] for r in kept) == sorted([*(str(k) for k in range(30)), "200"])


def test_few_bits_of_a_key_are_shuffled_and_none_is_taken_for_another(spark, monkeypatch):
    counted, store = [], dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df: counted.append(store(df)) or counted[-1])
    rows = [changed(ROWS[k % 3], Row_ID=str(k), Order_ID=None if k % 7 == 0 else f"O{k % 20}", Product_ID=f"P{k % 4}") for k in range(60)]
    lines = spark.createDataFrame(rows, RAW).repartition(3)
    firsts = {}
    for row in rows:  # in the order of their ids
        firsts.setdefault((row[RAW_COLUMNS.index("Order ID")], row[RAW_COLUMNS.index("Product ID")]), row[0])
    assert sorted(r["Row ID"] for r in remove_duplicates(lines).collect()) == sorted(firsts.values())
    hashes = [r[0] for r in counted[0].collect()]
    assert len(hashes) > 10 and all(0 <= h < 1 << 40 for h in hashes)  # of 64 bits before
    monkeypatch.setattr(dedup, "_KEY_BITS", 2)  # now different keys share their bits
    assert sorted(r["Row ID"] for r in remove_duplicates(lines).collect()) == sorted(firsts.values())
    assert len(counted[1].collect()) <= 4


def test_first_of_each_key_thinned_before_the_sort(spark, monkeypatch):
    monkeypatch.setattr("tillstar.operators.dedup._HELD", 20)
    draw = random.Random(5)
    rows = [(draw.choice(["a", "b", None]), draw.choice([None, "x"]), draw.choice([str(draw.randrange(90)), f"r{k}", None]), k) for k in range(300)]
    df = spark.createDataFrame(rows, "`Place` string, `Of` string, `Row ID` string, n int").repartition(3)
    both = [first_per_key(df, ("Place", "Of"), [*row_order(df), (F.col("n"), True)], combine) for combine in (False, True)]
    assert "MapInArrow" in plan(both[1])
    plain, thinned = ({tuple(r) for r in b.collect()} for b in both)
    assert plain == thinned and len(plain) == 6


def test_customers_join_the_orders_and_not_the_lines(spark, tmp_path):
    kinds = {"lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp",
             "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string", "part": "p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double",
             "customer": "c_custkey long, c_name string, c_mktsegment string, c_nationkey long", "nation": "n_nationkey long, n_name string, n_regionkey long", "region": "r_regionkey long, r_name string"}
    day = dt.datetime(1997, 3, 4)
    rows = {"lineitem": [(1, 1, 1, 1, 2.0, 10.0, 0.1, day), (9, 1, 1, 1, 2.0, 10.0, 0.1, day)], "orders": [(1, 7, day, "1-URGENT")], "part": [(1, "pine", "T", "B", 3.0)],
            "customer": [(7, "Nora", "S", 2)], "nation": [(2, "N", 3)], "region": [(3, "R")]}
    for name, kind in kinds.items():
        spark.createDataFrame(rows[name], kind).write.parquet(str(tmp_path / f"{name}.parquet"))
    lines = commerce.raw_order_lines(spark, str(tmp_path))
    assert [(r["Customer Name"], r["Region"], r["Sales"]) for r in lines.collect()] == [("Nora", "R", "10.00")]
    joins = lines._jdf.queryExecution().optimizedPlan().toString().splitlines()
    indent = {key: next(len(x) - len(x.lstrip(" :+-|")) for x in joins if "Join" in x and key in x) for key in ("o_orderkey", "c_custkey")}
    assert indent["c_custkey"] > indent["o_orderkey"]  # below the join with the lines


def test_names_of_nations_and_regions_are_not_shuffled_with_the_orders(spark, tmp_path):
    day = dt.datetime(1997, 3, 4)
    tables = {"lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp",
                           [(order, 1, 1, 1, 2.0, 10.0, 0.1, day) for order in (1, 2, 3, 4, None)]),
              "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string", [(k, k + 6, day, "1-URGENT") for k in (1, 2, 3)]),
              "part": ("p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double", [(1, "pine", "T", "B", 3.0)]),
              "customer": ("c_custkey long, c_name string, c_mktsegment string, c_nationkey long", [(7, "Nora", "S", 2), (8, "Ivo", "S", None), (9, "Ada", "S", 4)]),
              "nation": ("n_nationkey long, n_name string, n_regionkey long", [(2, "N", 3), (2, "N", 3), (4, "M", 5)]), "region": ("r_regionkey long, r_name string", [(3, "R")])}
    for name, (kind, rows) in tables.items():
        spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / f"{name}.parquet"))
    lines = commerce.raw_order_lines(spark, str(tmp_path))
    assert [(r["Customer Name"], r["Country"], r["Region"]) for r in lines.collect()] == [("Nora", "N", "R")] * 2
    joins = lines._jdf.queryExecution().optimizedPlan().toString().splitlines()
    indent = {key: next(len(x) - len(x.lstrip(" :+-|")) for x in joins if "Join" in x and key in x) for key in ("o_orderkey", "n_nationkey", "r_regionkey")}
    assert max(indent["n_nationkey"], indent["r_regionkey"]) < indent["o_orderkey"]  # above the join with the lines


def test_a_load_stores_texts_of_rejected_lines_only(spark):
    found = spark.createDataFrame([(None, "1", "O1", "C1", "Nora"), ("region", "2", "O2", "C2", "Ivo")], "reject_reason string, `Row ID` string, `Order ID` string, `Customer ID` string, `Customer Name` string")
    kept = facts.kept_of(found)
    assert kept.columns == ["reject_reason", "Row ID", "Order ID", "Customer ID"]
    assert sorted(tuple(r) for r in kept.collect() if r[0] is None) == [(None, None, "O1", None)]
    assert [tuple(r)[1:] for r in kept.where("reject_reason IS NOT NULL").collect()] == [("2", "O2", "C2")]


def test_both_sets_of_lines_come_from_one_join(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(commerce, "raw_order_lines", lambda s, d: asked.append(d) or spark.createDataFrame([changed(ROWS[0], Order_ID="1", Customer_ID="2", Product_ID="3")], RAW))
    monkeypatch.setattr(etl, "intact", etl.stored("intact", lambda s, d: commerce.raw_order_lines(s, d)))
    good, raw = etl.intact_silver(spark, str(tmp_path)).first(), etl.raw(spark, str(tmp_path)).first()
    assert asked == [str(tmp_path)] and raw["Customer Name"] == " \tNora Lind  " and good["Customer Name"] == "Nora Lind"


def test_lines_keep_their_order_without_a_sort(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [changed(r, Product_Name="two\nlines") for r in ROWS])
    read = files.read_raw(spark, path)
    assert "Sort" not in plan(read).replace("SortMergeJoin", "") and read.count() == 3


def test_mixed_files_are_written_by_the_tasks_that_read(spark, tmp_path, monkeypatch):
    rows = [changed(ROWS[k % 3], Row_ID=f"{k}-1") for k in range(40)]
    monkeypatch.setattr(etl, "raw", lambda s, d: spark.createDataFrame(rows, RAW).repartition(5))
    etl.mixed_files(spark, "", str(tmp_path / "in"), None)
    assert len(list((tmp_path / "in").glob("part-*"))) == 10  # two of each encoding before, however many rows
    got = files.read_raw(spark, str(tmp_path / "in"), null_words=("",))
    assert sorted(r["Row ID"] for r in got.collect()) == sorted(r[0] for r in rows)


def test_amounts_as_text(spark):
    cents = [0, 5, -5, 99, -100, 123456, -98765432101, 999_999_999_999]
    shown = spark.createDataFrame([(c,) for c in cents], "_sales long").select(commerce._cents_text("_sales"), commerce._money("_sales").cast("string"))
    assert all(a == b for a, b in shown.collect()) and shown.where("_sales IS NULL").count() == 0


def test_a_landing_of_large_tables_is_written_without_a_stored_copy(spark, tmp_path, monkeypatch):
    day = dt.datetime(1997, 3, 4)
    for name, schema, rows in (
        ("lineitem", "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp",
         [(k // 3, k % 5, 1, k % 3, 2.0, 10.5 + k, 0.05, day) for k in range(30)]),
        ("orders", "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string", [(k, k % 4, day, "1-URGENT") for k in range(10)]),
        ("customer", "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string", [(k, f"C{k}", 1, "AUTO") for k in range(4)]),
        ("part", "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double", [(k, f'"P", {k}', "B", "T", 3.5) for k in range(5)]),
        ("nation", "n_nationkey int, n_name string, n_regionkey int", [(1, "N", 1)]), ("region", "r_regionkey int, r_name string", [(1, "R")]),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    folder = str(tmp_path)
    monkeypatch.setattr(etl, "FEW_BYTES", 0)
    monkeypatch.setattr(etl, "_STORED", {})
    csv_files(etl.raw_once(spark, folder), str(tmp_path / "in"))
    assert not etl._STORED
    got = files.read_raw(spark, str(tmp_path / "in"), null_words=("",)).select(*RAW_COLUMNS).collect()
    assert sorted(map(str, got)) == sorted(map(str, etl.raw(spark, folder).collect())) and len(got) == 30
    assert etl._STORED and "Join" not in plan(etl.raw_once(spark, folder))  # at hand now
