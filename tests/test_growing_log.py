"""Chunks that come late, twice or at once; writers that die; labels whose ranks stay."""

import threading

import pytest
from compare import assert_close
from pyspark.sql import functions as F

from leavewatch.operators.label_dictionary import LabelDictionary
from leavewatch.operators.session_store import SessionStore
from leavewatch.operators.users import user_features
from leavewatch.sources.manifest import Manifest
from leavewatch.sources.published import publish_table, read_published, sweep_published
from leavewatch.sources.shared_storage import fresh_path


def store(spark, **options):
    return SessionStore(spark, fresh_path(spark, "sessions"), **{"buckets": 4} | options)


def same(found, expected):
    assert_close(found.select(*expected.columns).toPandas(), expected.toPandas(), ["userId"])


# ---- manifests --------------------------------------------------------------

def test_a_version_is_made_once(spark):
    manifest = Manifest(spark, fresh_path(spark, "manifest"))
    assert manifest.read() == (0, {})
    assert manifest.swap(1, {"a": 1}) and not manifest.swap(1, {"a": 2})
    assert manifest.read() == (1, {"a": 1})
    assert manifest.change(lambda state: None) == (1, {"a": 1})
    assert manifest.change(lambda state: {"a": state["a"] + 1}) == (2, {"a": 2})


def test_no_change_is_lost_between_writers(spark):
    path = fresh_path(spark, "manifest")

    def work():
        for _ in range(5):
            Manifest(spark, path).change(lambda state: {"n": state.get("n", 0) + 1})

    threads = [threading.Thread(target=work) for _ in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert Manifest(spark, path).read() == (20, {"n": 20})


# ---- published tables --------------------------------------------------------

def test_readers_see_the_old_table_or_the_new(spark, monkeypatch):
    path = fresh_path(spark, "published")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    assert publish_table(spark.range(3), path) == 1
    before = read_published(spark, path)

    def dies(self, version, state):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "swap", dies)  # after the rows are stored, before they count
        with pytest.raises(RuntimeError, match="killed"):
            publish_table(spark.range(10), path)
    assert read_published(spark, path).count() == 3
    broken = spark.range(5).select((1 / (F.col("id") - F.col("id"))).alias("id"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        publish_table(broken, path)
    assert read_published(spark, path).count() == 3
    assert publish_table(spark.range(10), path) == 2  # the retry
    assert read_published(spark, path).count() == 10 and before.count() == 3
    assert len(sweep_published(spark, path)) == 3
    assert read_published(spark, path).count() == 10


# ---- session store -----------------------------------------------------------

def test_late_and_repeated_chunks(spark, clean_log, features):
    kept = store(spark)
    chunks = {f"c{i}": clean_log.where(F.abs(F.hash("ts", "userId")) % 5 == i) for i in range(5)}
    for name in ("c1", "c4", "c0"):
        assert kept.add_chunk(name, chunks[name])
    assert not kept.add_chunk("c4", chunks["c4"])
    kept.refresh()
    some = clean_log.where((F.abs(F.hash("ts", "userId")) % 5).isin(0, 1, 4))
    same(kept.features(), user_features(some))
    assert kept.add_chunk("c2", chunks["c2"]) and kept.add_chunk("c3", chunks["c3"])
    kept.refresh()
    assert not kept.add_chunk("c3", chunks["c3"])
    assert kept.refresh() == []
    same(kept.features(), features)


def test_a_late_chunk_rewrites_only_the_buckets_of_its_users(spark, clean_log, features):
    kept = store(spark, buckets=16)
    late = (F.col("userId") == "8") & (F.col("ts") % 2 == 0)
    kept.add_chunk("most", clean_log.where(~late))
    kept.refresh()
    before = kept.manifest.read()[1]["tables"]
    kept.add_chunk("late", clean_log.where(late))
    touched = kept.refresh()
    after = kept.manifest.read()[1]["tables"]
    assert len(touched) == 1 and {b for b in after if after[b] != before.get(b)} == {str(touched[0])}
    same(kept.features(), features)


def test_empty_chunks_and_tables(spark, clean_log, features):
    kept = store(spark)
    with pytest.raises(FileNotFoundError):
        kept.features()
    assert kept.add_chunk("none", clean_log.limit(0)) and kept.refresh() == []
    kept.add_chunk("all", clean_log)
    kept.refresh()
    same(kept.features(), features)


def test_a_writer_that_dies_changes_nothing(spark, clean_log, features, monkeypatch):
    kept = store(spark)
    half = F.abs(F.hash("ts")) % 2 == 0
    kept.add_chunk("a", clean_log.where(half))
    kept.refresh()
    state = kept.manifest.read()

    def dies(self, version, state):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "swap", dies)
        with pytest.raises(RuntimeError):
            kept.add_chunk("b", clean_log.where(~half))
    assert kept.manifest.read() == state
    kept.add_chunk("b", clean_log.where(~half))
    with monkeypatch.context() as patch:
        patch.setattr(Manifest, "swap", dies)
        with pytest.raises(RuntimeError):
            kept.refresh()
    same(kept.features(), user_features(clean_log.where(half)))
    kept.refresh()
    same(kept.features(), features)


def test_other_bucket_count_is_an_error(spark, clean_log):
    kept = store(spark)
    kept.add_chunk("a", clean_log.limit(5))
    with pytest.raises(ValueError, match="4 buckets"):
        SessionStore(spark, kept.manifest.path, buckets=8).refresh()


# ---- label dictionary ----------------------------------------------------------

def dictionary(spark):
    return LabelDictionary(spark, fresh_path(spark, "labels"))


def log(spark, labels, more=()):
    rows = [(a, b) for a, b in zip(labels, [*more, *[None] * len(labels)])]
    return spark.createDataFrame(rows, "a string, b string")


def ranks(found, column="a"):
    return {r["label"]: (r["label_rank"], r["n_events"], r["added_in"]) for r in found.read().where(F.col("column") == column).collect()}


def test_ranks_stay_and_counts_add_up(spark):
    found = dictionary(spark)
    assert ranks(found) == {}
    assert found.add_chunk("one", log(spark, ["b", "a", "c", "c", None], ["x"]), ["a", "b"])
    first = {"c": (0, 2, "one"), "a": (1, 1, "one"), "b": (2, 1, "one")}
    assert ranks(found) == first and ranks(found, "b") == {"x": (0, 1, "one")}
    assert found.add_chunk("two", log(spark, ["z", "y", "y", "b", "b", "b"], ["w", "x"]), ["a", "b"])
    second = {"c": (0, 2, "one"), "a": (1, 1, "one"), "b": (2, 4, "one"), "y": (3, 2, "two"), "z": (4, 1, "two")}
    assert ranks(found) == second and ranks(found, "b") == {"x": (0, 2, "one"), "w": (1, 1, "two")}
    assert not found.add_chunk("two", log(spark, ["q"]), ["a", "b"]) and ranks(found) == second
    assert found.add_chunk("three", log(spark, []), ["a", "b"]) and ranks(found) == second
    rows = log(spark, ["z", None, "never", "c"]).select("a")
    assert {r["a"]: r["a_rank"] for r in found.encoded(rows, "a").collect()} == {"z": 4, None: None, "never": None, "c": 0}


def test_two_writers_never_give_one_rank_twice(spark):
    found, errors = dictionary(spark), []

    def work(i):
        try:
            LabelDictionary(spark, found.manifest.path).add_chunk(f"w{i}", log(spark, ["shared", f"own{i}", f"own{i}", f"more{i}"]), ["a"])
        except Exception as error:  # noqa: BLE001 - shown by the test
            errors.append(error)

    threads = [threading.Thread(target=work, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    got = ranks(found)
    assert sorted(rank for rank, *_ in got.values()) == list(range(9)) and got["shared"][1] == 4


def test_any_number_of_labels(spark):
    found = dictionary(spark)
    many = spark.range(30_000).select(F.concat(F.lit("l"), F.col("id") % 20_000).alias("a"))
    found.add_chunk("one", many, ["a"])
    found.add_chunk("two", many.select(F.concat("a", F.lit("x")).alias("a")), ["a"])
    stats = found.read().agg(F.count("label"), F.countDistinct("label_rank"), F.max("label_rank"), F.sum("n_events")).head()
    assert tuple(stats) == (40_000, 40_000, 39_999, 60_000)
