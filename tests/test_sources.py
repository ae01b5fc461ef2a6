from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from loanloom.samples.lending import CUTOFF, RawTables
from loanloom.sources import bronze
from loanloom.sources.export import export_answer
from loanloom.sources.layers import Layers, shared_folder

from conftest import FOLDER


def test_csv_keeps_text_and_checks_its_header(spark, tmp_path):
    path = tmp_path / "raw_x.csv"
    path.write_text('a,b\n 01 ,"say ""hi"", ok"\n,2\n', encoding="utf-8")
    df = bronze.read_extract(spark, str(path), ["a", "b"])
    assert [tuple(r) for r in df.collect()] == [(" 01 ", 'say "hi", ok'), (None, "2")]
    with pytest.raises(Exception, match="(?i)header"):
        bronze.read_extract(spark, str(path), ["a", "c"]).collect()


def test_extracts_must_be_complete(spark, tmp_path):
    raw = RawTables(spark, FOLDER)
    for name in bronze.EXTRACTS:
        assert raw[name].columns == list(bronze.EXTRACTS[name])
    bronze.write_csv(raw["raw_fx_rates"], str(tmp_path / "raw_fx_rates.csv"))
    with pytest.raises(FileNotFoundError, match="raw_loans"):
        bronze.read_extracts(spark, str(tmp_path))


def test_layers_replace_and_prune(spark):
    layers = Layers(spark)
    assert layers.root.startswith(shared_folder(spark))
    first = spark.createDataFrame([(1, date(2024, 1, 31))], "a int, cutoff_date date")
    second = spark.createDataFrame(
        [(2, date(2024, 2, 29)), (3, CUTOFF)], "a int, cutoff_date date"
    )
    layers.write(first, "silver", "t", ["cutoff_date"])
    stored = layers.write(second, "silver", "t", ["cutoff_date"])
    assert sorted(r.a for r in stored.collect()) == [2, 3]
    one = stored.where(stored.cutoff_date == CUTOFF)
    assert [r.a for r in one.collect()] == [3]
    assert "PartitionFilters: [isnotnull" in one._jdf.queryExecution().toString()


def test_layers_keep_the_table_when_a_write_fails(spark):
    layers = Layers(spark)
    with pytest.raises(FileNotFoundError, match="silver.t"):
        layers.current("silver", "t")
    old = layers.write(spark.range(3), "silver", "t")
    broken = spark.range(2).selectExpr("raise_error('stop') as id")
    with pytest.raises(Exception, match="stop"):
        layers.write(broken, "silver", "t")
    assert layers.read(old.schema, "silver", "t").count() == 3
    new = layers.write(old.where("id > 0"), "silver", "t")
    assert (old.count(), new.count()) == (3, 2)
    layers.write(spark.range(7), "silver", "t")
    folder = Path(layers.path("silver", "t"))
    assert len(list(folder.glob("v-*"))) == 2
    layers.close()
    assert not Path(layers.root).exists()


def test_readers_pass_over_a_pointer_without_content(spark, tmp_path):
    """A writer that died between creating its pointer and writing it."""
    layers = Layers(spark, str(tmp_path))
    old = layers.write(spark.range(3), "silver", "t")
    (tmp_path / "silver" / "t" / f"_pointer-{2:012d}").touch()
    assert layers.read(old.schema, "silver", "t").count() == 3
    new = layers.write(spark.range(5), "silver", "t")
    assert new.count() == 5 and layers.read(old.schema, "silver", "t").count() == 5


def test_two_writers_leave_each_other_alone(spark, tmp_path):
    """One writes and publishes while the other's job still runs."""
    one, two = Layers(spark, str(tmp_path)), Layers(spark, str(tmp_path))
    one.write(spark.range(1), "silver", "t")
    publish = one._publish

    def late(layer, name, version):
        for n in (2, 3, 4):
            two.write(spark.range(n), "silver", "t")
        publish(layer, name, version)

    one._publish = late
    last = one.write(spark.range(7), "silver", "t")
    assert last.count() == 7 and two.read(last.schema, "silver", "t").count() == 7
    # The number that both wanted is taken once.
    two._numbers = lambda layer, name: [4]
    two.write(spark.range(9), "silver", "t")
    del two._numbers
    assert two.read(last.schema, "silver", "t").count() == 9


def test_bucketed_tables_meet_without_a_shuffle(spark):
    layers = Layers(spark)
    rows = spark.range(1000).selectExpr("id % 100 as k", "id as v")
    left = layers.write_bucketed(rows, "silver", "a", "k")
    right = layers.write_bucketed(rows, "silver", "b", "k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    sums = left.groupBy("k").agg({"v": "sum"}).join(right, "k")
    assert "Exchange" not in sums._jdf.queryExecution().executedPlan().toString()
    assert sums.count() == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(list(Path(layers.current("silver", "a")).glob("part-*"))) <= 8
    assert spark.read.parquet(layers.current("silver", "b")).count() == 1000
    tables = list(layers._bucketed)
    layers.close()
    assert not any(spark.catalog.tableExists(t) for t in tables)
    assert not Path(layers.root).exists()


def test_close_leaves_a_given_folder(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    layers.write(spark.range(3), "silver", "t")
    layers.close()
    assert spark.read.parquet(layers.current("silver", "t")).count() == 3


def test_answer_is_one_ordered_file(spark, tmp_path):
    df = spark.range(20).repartition(4)
    path = tmp_path / "answer"
    export_answer(df, str(path), ["id"])
    files = list(path.glob("part-*"))
    assert len(files) == 1
    assert files[0].read_text().split() == ["id", *map(str, range(20))]


def test_partitioned_write_neither_shuffles_nor_sorts(spark, monkeypatch):
    """What a partitioned table takes of disk is the table, whatever its size."""
    layers, plans = Layers(spark), []
    save = Layers._written

    def seen(self, df, name, how):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        save(self, df, name, how)

    monkeypatch.setattr(Layers, "_written", seen)
    open_files = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(open_files)
    rows = spark.range(0, 3000, 1, 3).selectExpr("id", "cast(id % 150 as int) as month")
    stored = layers.write(rows, "silver", "t", ["month"])
    assert "Repartition" not in plans[0] and "Rebalance" not in plans[0]
    assert spark.conf.get(open_files) == before
    # More values than files that may be open at once.
    assert stored.count() == 3000 and stored.where("month = 149").count() == 20
    folder = Path(layers.current("silver", "t"))
    assert len(list(folder.glob("month=7/part-*"))) == 3
    layers.close()


def test_extracts_are_expanded_in_a_fixed_number_of_pieces(spark):
    """Pieces that adaptive execution joins to one more than the cores leave these idle."""
    for name in ("raw_applications_cdc", "raw_loans", "raw_installments", "raw_payments"):
        plan = RawTables(spark, FOLDER)[name]._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_COL" not in plan


def test_open_files_of_a_partitioned_write_hold_little(spark):
    """A task has a file a month open, so none may hold its rows till it is closed."""
    layers = Layers(spark)
    rows = spark.range(0, 400_000, 1, 1).selectExpr(
        "xxhash64(id) as a", "xxhash64(id, 1) as b", "cast(id % 2 as int) as month"
    )
    layers.write(rows, "silver", "t", ["month"])
    files = list(Path(layers.current("silver", "t")).glob("month=*/part-*.parquet"))
    assert len(files) == 2
    for file in files:
        held = pq.ParquetFile(file).metadata
        sizes = [held.row_group(i).total_byte_size for i in range(held.num_row_groups)]
        assert sum(sizes) > 3_000_000 and max(sizes) < 1_000_000
    layers.close()
