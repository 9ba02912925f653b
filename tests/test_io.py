"""File sources and sinks: CSV tree scans with fallback, optional and
fault-tolerant multi-source loads, the required-column report, partitioned
parquet with partition pruning, model save / load and the run log."""

import pytest
from pyspark.sql import functions as F

from cadence.sources import files, sinks
from cadence.sources import fixtures as fx


@pytest.fixture(scope="module")
def landing(spark, sf, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    (root / "a" / "b").mkdir(parents=True)
    pdf = fx.tracks_raw(spark, sf).toPandas()
    pdf.iloc[: len(pdf) // 2].to_csv(root / "a" / "dataset.csv", index=False)
    pdf.iloc[len(pdf) // 2:].to_csv(root / "a" / "b" / "dataset.csv", index=False)
    pdf.head(5).to_csv(root / "other.csv", index=False)
    return str(root), len(pdf)


def test_csv_tree_by_name(spark, landing):
    root, n = landing
    df = files.read_csv_tree(spark, root, "dataset.csv")
    assert df.count() == n
    assert "danceability" in df.columns


def test_csv_fallback_and_optional(spark, landing):
    root, n = landing
    assert files.read_csv_tree(spark, root, "nothing_here.csv").count() == n + 5
    with pytest.raises(FileNotFoundError):
        files.read_csv_tree(spark, root, "nothing_here.csv", fallback_glob=None)
    empty = files.read_csv_tree(spark, root, "nothing_here.csv", fallback_glob=None, required=False,
                                schema="track_id string, track_name string")
    assert empty.count() == 0 and empty.columns == ["track_id", "track_name"]


def test_load_sources_skips_bad_source(spark, landing):
    root, n = landing

    def broken():
        raise OSError("unreadable")

    union, report = files.load_sources([
        lambda: files.read_csv_tree(spark, root, "dataset.csv"),
        broken,
        lambda: files.read_csv_tree(spark, root, "x.csv", fallback_glob=None, required=False),
        lambda: files.read_csv_tree(spark, root, "other.csv").drop("tempo"),
    ])
    rep = {r["source"]: r for r in report.collect()}
    assert rep[1]["status"] == "loaded" and rep[1]["missing_columns"] is None
    assert rep[2]["status"].startswith("failed")
    assert rep[3]["status"] == "absent"
    assert rep[4]["missing_columns"] == "tempo"
    counts = {r[0]: r[1] for r in union.groupBy("source_priority").count().collect()}
    assert counts == {1: n, 4: 5}
    with pytest.raises(RuntimeError):
        files.load_sources([broken])


def test_partitioned_parquet_prunes(spark, sf, tmp_path):
    from __spark_entry__ import queries
    split = queries()["temporal_split"](spark, sf)
    path = str(tmp_path / "split")
    sinks.write_table(split, path, partition_by=["split"])
    back = spark.read.parquet(path)
    assert back.count() == split.count()
    one = back.where(F.col("split") == "test")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert one.count() == split.where(F.col("split") == "test").count()


def test_model_save_load(spark, tmp_path):
    from pyspark.ml.feature import PCA, PCAModel
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0, 3.0]),), (Vectors.dense([2.0, 1.0, 0.0]),),
                                (Vectors.dense([0.0, 1.0, 5.0]),)], ["features"])
    m = PCA(k=2, inputCol="features", outputCol="p").fit(df)
    path = str(tmp_path / "pca")
    sinks.save_model(m, path)
    sinks.save_model(m, path)  # overwrite
    back = sinks.load_model(PCAModel, path)
    assert back.pc.toArray().tolist() == m.pc.toArray().tolist()


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    sinks.log_run(spark, path, "r1", {"ndcg@10": 0.5}, {"k": 10})
    sinks.log_run(spark, path, "r2", {"ndcg@10": 0.6, "recall@10": 0.2})
    log = spark.read.parquet(path)
    assert log.count() == 4
    assert log.where("kind = 'metric'").count() == 3


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('track_id,artists,track_name\n1,"[""A"", \'B\']","two\nlines"\n2,"x, y",plain\n')
    rows = files.read_csv_tree(spark, str(tmp_path), "t.csv").orderBy("source_row").collect()
    assert [(r.track_id, r.artists, r.track_name) for r in rows] == [
        (1, '["A", \'B\']', "two\nlines"), (2, "x, y", "plain")]


def test_first_row_of_a_file_wins(spark, tmp_path):
    from cadence.operators.clean import dedupe_tracks, union_sources
    (tmp_path / "t.csv").write_text("track_id,track_name\n1,first\n1,second\n2,other\n")
    df = union_sources([files.read_csv_tree(spark, str(tmp_path), "t.csv")])
    for n in (1, 5):
        kept = dedupe_tracks(df.repartition(n)).collect()
        assert sorted(r.track_name for r in kept) == ["first", "other"]


def test_csv_with_given_types(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "t.csv").write_text("track_id,Energy,key,track_name\n007,0.5,3,one\n8,1,,two\n")
    (tmp_path / "t.csv").write_text('track_id,Energy,key,track_name\nabc,loud,4.5,"a, b"\n')
    df = files.read_csv_tree(spark, str(tmp_path), "t.csv", types=files.TRACK_TYPES, multi_line=False)
    assert dict(df.dtypes)["Energy"] == "double" and dict(df.dtypes)["key"] == "int"
    rows = {r.track_id: (r.Energy, r.key, r.track_name) for r in df.collect()}
    assert rows == {"007": (0.5, 3, "one"), "8": (1.0, None, "two"), "abc": (None, None, "a, b")}
    (tmp_path / "u").mkdir()
    (tmp_path / "u" / "t.csv").write_text("track_id,track_name,Energy,key\n9,three,0.1,1\n")
    with pytest.raises(Exception):
        files.read_csv_tree(spark, str(tmp_path), "t.csv", types=files.TRACK_TYPES).collect()


def test_two_files_of_one_folder(spark, tmp_path):
    (tmp_path / "tracks.csv").write_text("track_id,track_name\n1,a\n")
    (tmp_path / "history.csv").write_text("user,track\nu,1\nv,1\n")
    tracks, history = files.read_tracks_and_history(spark, str(tmp_path), "tracks.csv", "history.csv")
    assert tracks.count() == 1 and history.count() == 2 and "user" in history.columns
