"""Landings, partition replacement, quarantine, layouts and inference on small and awkward tables."""

from __future__ import annotations

import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanloom import sources
from loanloom.sources import catalog, clustering, landing, partitions
from loanloom.sources.inference import inferred_types, narrowest
from loanloom.streaming import counts
from tests.test_plans import plan_of


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


# --- landing --------------------------------------------------------------------------------


def reader(spark, seen):
    def read(paths):
        seen.append(sorted(os.path.basename(p) for p in paths))
        return spark.read.schema("id int, t string").csv(paths)

    return read


def test_only_new_and_changed_files_are_read(spark, folder):
    seen, table = [], f"{folder}/table"
    put(f"{folder}/in/a b.csv", "1,x\n2,y\n")
    put(f"{folder}/in/deep/c.csv", "3,z\n")
    land = lambda: sources.land_new(spark, f"{folder}/in", table, reader(spark, seen))
    assert land().count() == 2
    put(f"{folder}/in/d.csv", "4,w\n")
    assert [r.source_file.rsplit("/", 1)[1] for r in land().collect()] == ["d.csv"]
    assert land().count() == 0
    put(f"{folder}/in/a b.csv", "1,changed\n9,new\n")
    os.remove(f"{folder}/in/d.csv")
    land()
    assert seen == [["a b.csv", "c.csv"], ["d.csv"], ["a b.csv"]]
    landed = sources.landed_rows(spark, table)
    assert rows_of(landed.select("id", "t", "landing")) == [
        (1, "changed", 3), (3, "z", 1), (4, "w", 2), (9, "new", 3)
    ]
    assert landed.where("id = 3").first().source_file.endswith("/in/deep/c.csv")
    assert sources.ledger(spark, table).count() == 4


def test_a_landing_that_stopped_before_its_commit_is_repeated(spark, folder, monkeypatch):
    seen, table = [], f"{folder}/table"
    put(f"{folder}/in/a.csv", "1,x\n")
    sources.land_new(spark, f"{folder}/in", table, reader(spark, seen))
    put(f"{folder}/in/b.csv", "2,y\n")

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(landing.Folders, "move", stop)
        with pytest.raises(KeyboardInterrupt):
            sources.land_new(spark, f"{folder}/in", table, reader(spark, seen))
    assert os.path.exists(f"{table}/rows/landing=2")
    assert rows_of(sources.landed_rows(spark, table).select("id")) == [(1,)]
    sources.land_new(spark, f"{folder}/in", table, reader(spark, seen))
    assert rows_of(sources.landed_rows(spark, table).select("id", "landing")) == [(1, 1), (2, 2)]
    assert seen[1] == seen[2] == ["b.csv"]


def test_nothing_to_land(spark, folder):
    os.makedirs(f"{folder}/in")
    assert sources.land_new(spark, f"{folder}/in", f"{folder}/t", reader(spark, [])).count() == 0
    with pytest.raises(ValueError, match="nothing has been landed"):
        sources.landed_rows(spark, f"{folder}/t")


def test_later_files_may_have_more_columns(spark, folder):
    for i, columns in enumerate(("id int", "id int, more string")):
        put(f"{folder}/in/{i}.csv", "1,a\n" if i else "1\n")
        sources.land_new(spark, f"{folder}/in", f"{folder}/t", lambda p, c=columns: spark.read.schema(c).csv(p))
    assert rows_of(sources.landed_rows(spark, f"{folder}/t").select("id", "more", "landing")) == [
        (1, "a", 2), (1, None, 1)
    ]


# --- partitions -----------------------------------------------------------------------------

DDL = "id int, p string, q int"


@pytest.fixture
def parted(spark, folder):
    rows = [(1, "a", 1), (2, "a", 2), (3, "b/c d", 1), (4, None, 1), (5, "é=", 2)]
    path = f"{folder}/parted"
    spark.createDataFrame(rows, DDL).write.partitionBy("p", "q").parquet(path)
    return path


def read_parted(spark, path):
    return rows_of(sources.read_table(spark, path, schema=StructType.fromDDL(DDL)))


def data_files(path):
    return set(glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_replace_the_partitions_that_have_rows(spark, parted):
    before = data_files(parted)
    new = spark.createDataFrame([(30, "b/c d", 1), (40, None, 1), (50, "new", 7)], DDL)
    done = sources.replace_partitions(new, parted, ["p", "q"])
    assert [partitions.partition_values(f) for f in done] == [(None, "1"), ("b/c d", "1"), ("new", "7")]
    assert read_parted(spark, parted) == sorted(
        [(1, "a", 1), (2, "a", 2), (30, "b/c d", 1), (40, None, 1), (5, "é=", 2), (50, "new", 7)], key=str
    )
    assert len(before & data_files(parted)) == 3  # the others keep their files
    assert not [n for n in os.listdir(parted) if n.startswith("_replaced")]


def test_replace_by_condition_empties_what_has_no_new_rows(spark, parted):
    new = spark.createDataFrame([(20, "a", 2)], DDL)
    sources.replace_partitions(new, parted, ["p", "q"], "p = 'a' or p = 'é='")
    assert read_parted(spark, parted) == sorted([(20, "a", 2), (3, "b/c d", 1), (4, None, 1)], key=str)
    sources.replace_partitions(new.limit(0), parted, ["p", "q"], "p is null")
    assert read_parted(spark, parted) == sorted([(20, "a", 2), (3, "b/c d", 1)], key=str)


def test_a_row_outside_of_the_condition_changes_nothing(spark, parted):
    before, files = read_parted(spark, parted), data_files(parted)
    for bad in [(7, "b", 1), (7, None, 1)]:
        with pytest.raises(Exception, match="row outside"):
            sources.replace_partitions(spark.createDataFrame([(6, "a", 1), bad], DDL), parted, ["p", "q"], "p = 'a'")
    assert (read_parted(spark, parted), data_files(parted)) == (before, files)


def test_a_failed_move_is_undone(spark, parted, monkeypatch):
    before, files, real, n = read_parted(spark, parted), data_files(parted), partitions.Folders.move, []

    def third_fails(self, source, target):
        n.append(1)
        if len(n) == 3:
            raise OSError("no")
        real(self, source, target)

    monkeypatch.setattr(partitions.Folders, "move", third_fails)
    with pytest.raises(OSError):
        sources.replace_partitions(spark.createDataFrame([(9, "a", 1), (9, "a", 2)], DDL), parted, ["p", "q"])
    assert (read_parted(spark, parted), data_files(parted)) == (before, files)


def test_a_plan_may_read_what_it_replaces_and_a_new_table_is_made(spark, parted, folder):
    table = sources.read_table(spark, parted, schema=StructType.fromDDL(DDL))
    sources.replace_partitions(table.where("p = 'a'").withColumn("id", F.col("id") + 100), parted, ["p", "q"])
    assert (101, "a", 1) in read_parted(spark, parted) and (3, "b/c d", 1) in read_parted(spark, parted)
    table = sources.read_table(spark, parted, schema=StructType.fromDDL(DDL))
    sources.replace_partitions(table, f"{folder}/fresh", ["q"])
    assert len(read_parted(spark, f"{folder}/fresh")) == 5


# --- quarantine -----------------------------------------------------------------------------


def quarantine_schema():
    schema = StructType.fromDDL("id int, amount double, t string")
    schema["id"].nullable = False
    return schema


def test_bad_rows_go_aside_with_their_reasons(spark, folder):
    schema = quarantine_schema()
    rows = spark.createDataFrame(
        [(1, 5.0, "x"), (None, 5.0, "y"), (3, -1.0, None), (None, None, "z"), (5, 0.0, "")], "id int, amount double, t string"
    )
    told = sources.write_or_quarantine(rows, f"{folder}/t", f"{folder}/q", schema, {"negative amount": "amount >= 0"}, "one")
    assert told == {"read": 5, "written": 2, "quarantined": 3}
    good = sources.read_table(spark, f"{folder}/t")
    assert good.columns == ["id", "amount", "t"] and rows_of(good.select("id")) == [(1,), (5,)]
    bad = sources.read_quarantine(spark, f"{folder}/q", schema)
    assert rows_of(bad.select("id", "t", "batch", "violation")) == sorted([
        (None, "y", "one", "id is null"), (3, None, "one", "negative amount"),
        (None, "z", "one", "id is null; negative amount"),
    ], key=str)
    # the same batch again replaces its rows, another one adds to them
    fine = rows.where("id = 1")
    assert sources.write_or_quarantine(fine, f"{folder}/t", f"{folder}/q", schema, batch="one")["written"] == 1
    assert sources.read_quarantine(spark, f"{folder}/q", schema).count() == 0
    none = rows.where("id is null")
    assert sources.write_or_quarantine(none, f"{folder}/t", f"{folder}/q", schema, batch="two") == {
        "read": 2, "written": 0, "quarantined": 2
    }
    assert sources.read_table(spark, f"{folder}/t").count() == 0
    assert sources.read_quarantine(spark, f"{folder}/q", schema).count() == 2


def test_quarantine_of_an_empty_table_and_of_wrong_columns(spark, folder):
    schema = quarantine_schema()
    empty = spark.createDataFrame([], "id int, amount double, t string")
    assert sources.write_or_quarantine(empty, f"{folder}/t", f"{folder}/q", schema)["read"] == 0
    assert sources.read_table(spark, f"{folder}/t").count() == 0
    with pytest.raises(ValueError, match="missing column amount"):
        sources.write_or_quarantine(empty.drop("amount"), f"{folder}/t", f"{folder}/q", schema)
    assert sources.read_quarantine(spark, f"{folder}/none", schema).count() == 0


def test_a_failing_write_leaves_table_and_quarantine(spark, folder):
    schema = quarantine_schema()
    rows = spark.createDataFrame([(1, 1.0, "x"), (None, 1.0, "y")], "id int, amount double, t string")
    sources.write_or_quarantine(rows, f"{folder}/t", f"{folder}/q", schema, batch="b")
    failing = rows.withColumn("t", F.when(F.col("t") == "y", F.raise_error(F.lit("broken"))).otherwise("n"))
    with pytest.raises(Exception, match="broken"):
        sources.write_or_quarantine(failing, f"{folder}/t", f"{folder}/q", schema, batch="b")
    assert rows_of(sources.read_table(spark, f"{folder}/t").select("t")) == [("x",)]
    assert sources.read_quarantine(spark, f"{folder}/q", schema).count() == 1
    assert sorted(os.listdir(folder)) == ["q", "t"]


def test_the_quarantine_is_one_scan(spark, folder):
    from loanloom.sources.quarantine import violations

    spark.range(9).selectExpr("cast(id as int) id", "1.5D amount", "'x' t").write.parquet(f"{folder}/in")
    rows = spark.read.parquet(f"{folder}/in").withColumn("violation", violations(quarantine_schema()))
    text = plan_of(rows)
    assert text.split("\n\n")[0].count("Scan parquet") == 1 and "Exchange" not in text


# --- layout ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def points(spark):
    rnd = random.Random(1)
    rows = [
        ("HOT" if rnd.random() < 0.33 else f"state {rnd.randrange(60):02d}", rnd.lognormvariate(8, 2), i, None)
        for i in range(40_000)
    ]
    rows += [(None, None, -1, None), ("", float("nan"), -2, "x"), ("", float("inf"), -3, "x")] * 5
    return spark.createDataFrame(rows, "state string, amount double, id int, more string")


def groups_read(path, state, low, high):
    """Row groups whose statistics do not rule out the filter, and all of them."""
    read = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            total += 1
            s, a = (meta.row_group(g).column(names.index(c)).statistics for c in ("state", "amount"))
            if not (s and s.has_min_max and (s.max < state or s.min > state)) and not (
                a and a.has_min_max and (a.max < low or a.min > high)
            ):
                read += 1
    return read, total


def test_filters_on_two_columns_skip_most_row_groups(spark, points, folder):
    sources.write_clustered(points, f"{folder}/z", ["state", "amount"], parts=64)
    back = sources.read_table(spark, f"{folder}/z")
    assert back.exceptAll(points).count() == 0 and back.count() == points.count()
    for state, low, high in (("state 31", 100, 1e9), ("HOT", 3000, 4000), ("state 05", 0, 1e9)):
        read, total = groups_read(f"{folder}/z", state, low, high)
        assert total == 64 and 0 < read < total / 4
    # either column alone prunes too
    assert groups_read(f"{folder}/z", "HOT", 3000, 4000)[0] < 16
    points.repartition(64).write.parquet(f"{folder}/plain")
    read, total = groups_read(f"{folder}/plain", "HOT", 3000, 4000)
    assert read == total


def test_a_hot_combination_is_dealt_over_files(spark, folder):
    rows = spark.range(30_000).selectExpr("id", "1 as a", "'same' as b")
    sources.write_clustered(rows, f"{folder}/hot", ["a", "b"], parts=8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{folder}/hot/*.parquet")]
    assert sum(sizes) == 30_000 and max(sizes) < 9_000


def test_the_key_interleaves_quantiles(spark):
    rows = spark.range(256).selectExpr("id % 16 as x", "id div 16 as y")
    keyed = clustering.z_key(rows, ["x", "y"], bits=2)
    for r in keyed.collect():
        a, b = min(r.x // 4, 3), min(r.y // 4, 3)
        # borders are values of the column: a value at a border starts its part
        want = ((a >> 1) << 3) | ((b >> 1) << 2) | ((a & 1) << 1) | (b & 1)
        if r.x % 4 in (1, 2) and r.y % 4 in (1, 2):
            assert r.z == want
    with pytest.raises(ValueError):
        clustering.z_key(rows, ["x", "y"], bits=40)
    with pytest.raises(ValueError, match="no order"):
        clustering.z_key(rows.withColumn("x", F.array("x")), ["x"])


def test_layout_of_an_empty_table_and_other_types(spark, folder):
    rows = spark.sql("select date'2024-01-01' d, timestamp'2024-01-01 10:00' t, true b, 1.5BD n")
    for i, df in enumerate((rows, rows.limit(0))):
        sources.write_clustered(df, f"{folder}/t{i}", ["d", "t", "b", "n"], parts=2, bits=4)
        assert sources.read_table(spark, f"{folder}/t{i}").count() == df.count()


# --- catalog --------------------------------------------------------------------------------


def test_bucketed_tables_join_and_group_without_an_exchange(spark):
    import __spark_entry__ as entry

    text = plan_of(entry.bucketed_join(spark, "/root/testdata/sf0.001"))
    assert "Exchange" not in text and "SortMergeJoin" in text
    assert text.count("SelectedBucketsCount: 8 out of 8") == 2


def test_a_bucket_is_one_file_and_tables_are_replaced(spark, folder):
    df = spark.range(1000).selectExpr("id", "id % 3 as g")
    for size in (1000, 10):
        table = sources.create_bucketed_table(df.limit(size), "layout", "b", ["id"], 4, ["id"], f"{folder}/db")
        assert table.count() == size and len(table.inputFiles()) <= 4
    assert [t.name for t in spark.catalog.listTables("layout")] == ["b"]


def test_a_failing_query_leaves_the_older_table(spark, folder):
    df = spark.range(5)
    sources.create_table_as(df, "layout", "kept", location=f"{folder}/db")
    bad = df.select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    for make in (
        lambda: sources.create_table_as(bad, "layout", "kept"),
        lambda: sources.create_bucketed_table(bad, "layout", "kept", ["id"], 2),
    ):
        with pytest.raises(Exception, match="broken"):
            make()
        assert spark.table("layout.kept").count() == 5
    assert not [t.name for t in spark.catalog.listTables("layout") if "__new" in t.name]
    assert sources.create_table_as(spark.table("layout.kept").limit(2), "layout", "kept").count() == 2
    assert catalog is not None


# --- inference --------------------------------------------------------------------------------


@pytest.mark.parametrize("text,kind", [
    ("1", "int"), (" -7 ", "int"), ("3000000000", "bigint"), ("99999999999999999999", "double"), ("1.", "double"),
    (".5", "double"), ("1e9", "double"), ("NaN", "string"), ("1d", "string"), ("2024-02-30", "string"),
    ("2024-2-3", "date"), ("2024-02-03 10:00:00", "timestamp"), ("2024-02-03T10:00:00Z", "timestamp"),
    ("TRUE", "boolean"), ("yes", "string"), ("", None), ("  ", None), (None, None), ("1 2", "string"), ("2024", "int"),
])
def test_narrowest_type_of_a_text(spark, text, kind):
    assert spark.createDataFrame([(text,)], "v string").select(narrowest(F.col("v"))).first()[0] == kind


def test_inferred_types_and_their_misfits(spark):
    rows = [(str(i), str(i / 2), "2024-01-01", None, "a", "1" if i % 2 else "x") for i in range(10)]
    rows[4] = ("n/a", "7", "2024-01-01 05:00:00", " ", "1", "1")
    rows[6] = ("later", "8", "2024-01-01", "", "a", "x")
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string").coalesce(1)
    got = {r.column_name: tuple(r)[1:] for r in inferred_types(df).collect()}
    assert got == {
        "a": ("string", "int", 10, 2, "n/a"), "b": ("double", "double", 10, 0, None),
        "c": ("timestamp", "timestamp", 10, 0, None), "d": (None, None, 0, 0, None),
        "e": ("string", "string", 10, 1, "1"), "f": ("string", "int", 10, 4, "x"),
    }
    assert {tuple(r)[1:] for r in inferred_types(df.limit(0)).collect()} == {(None, None, 0, 0, None)}
    assert inferred_types(spark.range(3)).count() == 0
    text = plan_of(inferred_types(df, ["a"]))
    assert text.count("Arguments: SinglePartition") <= 1


# --- counts over arriving rows ------------------------------------------------------------------


def batch(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k string").groupBy("k").agg(F.count(F.lit(1)).alias("count"))


def test_repeated_batches_count_once(spark, folder):
    state, want = f"{folder}/state", {}
    rnd = random.Random(3)
    with pytest.raises(ValueError):
        counts.current_counts(spark, state, ["k"])
    batches = [[rnd.choice(["a", "b", None, "hot", "hot"]) for _ in range(rnd.randint(0, 9))] for _ in range(9)]
    for n, values in enumerate(batches):
        for v in values:
            want[v] = want.get(v, 0) + 1
        for again in {n, max(0, n - 1), 0}:  # late and repeated batches
            counts.merge_batch(batch(spark, batches[again]), state, again, ["k"], compact_after=4)
        assert dict(map(tuple, counts.current_counts(spark, state, ["k"]).collect())) == want
    assert len(os.listdir(state)) <= 8


def test_a_stop_while_merging_counts_nothing_twice(spark, folder, monkeypatch):
    state = f"{folder}/state"
    for n in range(3):
        counts.merge_batch(batch(spark, ["a", "b"]), state, n, ["k"])

    def stop(*_):
        raise KeyboardInterrupt

    real = counts.Folders.delete
    with monkeypatch.context() as m:
        m.setattr(counts.Folders, "delete", lambda self, p: stop() if "batch=" in p else real(self, p))
        with pytest.raises(KeyboardInterrupt):
            counts.compact(spark, state, ["k"])
    assert {"upto=2", "batch=0"} <= set(os.listdir(state))
    assert rows_of(counts.current_counts(spark, state, ["k"])) == [("a", 3), ("b", 3)]
    counts.merge_batch(batch(spark, ["a"]), state, 1, ["k"])
    assert rows_of(counts.current_counts(spark, state, ["k"])) == [("a", 3), ("b", 3)]
