import os
from collections import namedtuple
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from scenarios import KEYS, at, expected, frame, main, recon, rows_of
from test_upsert import random_events

from siltline.functions.columns import key_slot, names_of_bits
from siltline.operators.state import absorb
from siltline.operators.upsert import ORDER
from siltline.operators.widening import wider
from siltline.sources.workspace import files_in, publish_text, read_text, scratch, shared_folder
from siltline.streaming import target
from siltline.streaming.derived import KeptAggregate
from siltline.streaming.target import ConcurrentCommit, KeyedTable


@pytest.fixture
def root(spark):
    return scratch(spark, "table")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_merges_reads_and_changes(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=3)
    with pytest.raises(ValueError, match="no rows yet"):
        table.read()
    first = [main("10:00", "x", 1), main("10:00", "k", 2, key=(1, 11)), main("10:00", "q", key=(1, 12))]
    second = [recon("12:00", True, "11:59"), main("09:00", "late", 9, key=(1, 11)), main("11:00", "n", key=(2, 1))]
    assert table.merge(frame(spark, first)) == 1
    assert table.merge(frame(spark, second)) == 2
    assert rows_of(table.read()) == expected(first + second)
    assert set(table.read().columns) == {*KEYS, "a", "b", "ACTIVE_FLAG", "DT_REMOVED"}

    changes = table.changes(since=2).collect()
    got = sorted((r.k1, r.k2, r.a, r.ACTIVE_FLAG, r["_change_type"]) for r in changes)
    assert got == [
        (1, 10, "x", False, "update_postimage"),
        (1, 10, "x", True, "update_preimage"),
        (2, 1, "n", True, "insert"),
    ]
    assert {r["_commit_version"] for r in changes} == {2}
    assert all(r["_commit_timestamp"] for r in changes)
    assert table.changes(until=1).count() == 3
    assert table.changes(since=3).count() == 0
    counts = {r.version: (r.events, r.rejected, r.inserted, r.updated, r.rows) for r in table.commits().collect()}
    assert counts == {1: (3, 0, 3, 0, 3), 2: (3, 0, 1, 1, 4)}


def test_only_touched_buckets_are_rewritten(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=8)
    table.merge(frame(spark, [main("10:00", "x", key=(1, k)) for k in range(40)]))
    table.merge(frame(spark, [main("11:00", "y", key=(1, 7))]))
    attempt = table.commits().where("version = 2").first().attempt
    assert len(os.listdir(f"{root}/data/attempt={attempt}/silt_kind=state")) == 1
    assert sorted(a.partition("-")[0] for a in set(table.layout().held_by.values())) == ["v1", "v2"]
    assert table.read().count() == 40


def test_random_batches_equal_one_pass(spark, root):
    events = random_events(11, count=200, keys=8)
    table = KeyedTable(spark, root, KEYS, buckets=2, hot_rows=20)
    for part in (events[120:], events[:60], events[60:120], events[:60]):
        table.merge(frame(spark, part))
    assert rows_of(table.read()) == expected(events)
    assert table.changes(since=4).count() == 0  # the replay changed nothing


def test_replay_and_crash(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=2)
    one, two = frame(spark, [main("10:00", "x")]), frame(spark, [main("11:00", "y")])
    assert table.merge(one, writer="q", epoch=0) == 1
    assert table.merge(one, writer="q", epoch=0) == 1  # replay of a published epoch
    # a commit that wrote data but died before its manifest
    table._write(two, table.layout(), [0, 1], "v2-dead")
    assert rows_of(table.read())[(1, 10)][0] == "x"
    assert table.changes().count() == 1
    assert table.merge(two, writer="q", epoch=1) == 2
    assert rows_of(table.read())[(1, 10)][0] == "y"
    assert table.merge(one, writer="other", epoch=0) == 3  # another writer counts for itself


def test_rejects_are_kept_apart(spark, root):
    bad = (1, 10, "bad", 9, True, None, None, 0, at("10:00"), 0)
    table = KeyedTable(spark, root, KEYS, buckets=2)
    table.merge(frame(spark, [main("10:00", "x"), bad]))
    table.merge(frame(spark, [bad]))  # nothing to merge, still a commit
    assert rows_of(table.read()) == {(1, 10): ("x", None, True, None)}
    assert table.rejects().count() == 2
    table.merge(frame(spark, [main("12:00", "y")]))
    frame(spark, [bad]).write.parquet(f"{root}/rejects/attempt=v4-dead")  # left behind by a commit that died
    assert table.rejects().count() == 2
    assert [(r.events, r.rejected) for r in table.commits().orderBy("version").collect()] == [(1, 1), (0, 1), (1, 0)]


def test_no_rejects_is_an_empty_frame(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=2)
    assert table.rejects().count() == 0
    table.merge(frame(spark, [main("10:00", "x")]))
    assert table.rejects().count() == 0


def test_fresh_buckets_do_not_lose_columns(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=16)
    table.merge(frame(spark, [main("10:00", "x", 1)]))
    other = next(k for k in range(11, 99) if bucket_of(spark, table, (1, k)) != bucket_of(spark, table, (1, 10)))
    table.merge(frame(spark, [main("10:00", "n", key=(1, other))]).drop("b"))  # only a bucket without rows
    assert "b" in table.read().columns
    table.merge(frame(spark, [main("11:00", "y")]).drop("b"))
    table.merge(frame(spark, [main("12:00", None, None)]))
    assert rows_of(table.read()) == {(1, 10): ("y", 1, True, None), (1, other): ("n", None, True, None)}


def bucket_of(spark, table, key):
    return frame(spark, [main("10:00", "x", key=key)]).selectExpr(table._bucket()).first()[0]


def test_a_column_keeps_its_type(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=2)
    table.merge(frame(spark, [main("10:00", "x", 1)]))
    with pytest.raises(ValueError, match="b is"):
        table.merge(frame(spark, [main("10:00", "x", 1)]).withColumn("b", F.col("b").cast("string")))
    assert table.layout().version == 1


def test_a_column_widens_and_narrower_feeds_still_fit(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=4)
    rows = frame(spark, [main("10:00", "x", 1, key=(1, k)) for k in range(8)])
    bad = frame(spark, [(1, 99, "bad", 9, True, None, None, 0, at("10:00"), 0)])
    whole = lambda df, kind: df.withColumn("b", F.col("b").cast(kind))
    table.merge(whole(rows.unionByName(bad), "int"))
    assert table.read().schema["b"].dataType.simpleString() == "int"
    big = frame(spark, [main("11:00", "x", 1 << 40, key=(1, 3))])
    table.merge(big.unionByName(bad))
    table.merge(whole(frame(spark, [main("12:00", None, 7, key=(1, 4)), main("09:00", "late", 5, key=(1, 3))]), "smallint"))
    table.merge(whole(bad, "tinyint"))
    assert table.read().schema["b"].dataType.simpleString() == "bigint"
    assert {r.k2: r.b for r in table.read().collect()} == {k: 1 for k in range(8)} | {3: 1 << 40, 4: 7}
    # files of before and after are one feed, and so are the rejects
    images = [(r.k2, r.b, r["_change_type"]) for r in table.changes(since=2).collect()]
    assert sorted(images) == [
        (3, 1, "update_preimage"), (3, 1 << 40, "update_postimage"), (4, 1, "update_preimage"), (4, 7, "update_postimage")
    ]
    assert table.changes().where("_change_type = 'insert'").count() == 8
    assert sorted((r.version, r.b) for r in table.rejects().collect()) == [(1, 9), (2, 9), (4, 9)]


def test_a_key_takes_narrower_values_but_does_not_widen(spark, root):
    narrow = frame(spark, [main("11:00", "y", key=(1, 10))]).withColumn("k2", F.col("k2").cast("int"))
    table = KeyedTable(spark, f"{root}/wide", KEYS, buckets=8)
    table.merge(frame(spark, [main("10:00", "x", 1)]))
    table.merge(narrow)  # finds the row that the wider key placed
    assert rows_of(table.read()) == {(1, 10): ("y", 1, True, None)}
    table = KeyedTable(spark, f"{root}/narrow", KEYS, buckets=8)
    table.merge(narrow)
    with pytest.raises(ValueError, match="k2 is int, not bigint"):
        table.merge(frame(spark, [main("10:00", "x", 1)]))
    assert table.layout().version == 1


def test_totals_follow_a_group_that_widens(spark, root):
    table = KeyedTable(spark, f"{root}/table", KEYS, buckets=2)
    kept = KeptAggregate(table, f"{root}/totals", ("b",))
    table.merge(frame(spark, [main("10:00", "x", 1), main("10:00", "x", 1, key=(1, 11))]).withColumn("b", F.expr("cast(b AS int)")))
    kept.refresh()
    table.merge(frame(spark, [main("11:00", "x", 1 << 40)]))
    kept.refresh()
    assert {(r.b, r.rows) for r in kept.read().collect()} == {(1, 1), (1 << 40, 1)}


KINDS = "tinyint smallint int bigint float double string decimal(6,2) decimal(12,4) decimal(38,0) decimal(10,9)".split()


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("tinyint", "bigint", "bigint"), ("smallint", "int", "int"), ("float", "double", "double"),
        ("decimal(6,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(6,2)", "decimal(10,9)", "decimal(13,9)"),
        ("decimal(38,0)", "decimal(6,2)", None), ("int", "double", None), ("bigint", "string", None),
        ("bigint", "decimal(38,0)", None),
    ],
)
def test_the_common_type(a, b, want):
    one, two = (StructType.fromDDL(f"c {k}")["c"].dataType for k in (a, b))
    for got in (wider(one, two), wider(two, one)):
        assert (got.simpleString() if got else None) == want


def test_the_common_type_is_a_least_upper_bound():
    kinds = [StructType.fromDDL(f"c {k}")["c"].dataType for k in KINDS]
    for a in kinds:
        assert wider(a, a) == a
        for b in kinds:
            up = wider(a, b)
            assert up is None or (wider(a, up) == up and wider(b, up) == up)


def test_one_version_is_published_once(spark, root):
    """A second writer that saw the same state fails, and what the first one published stays readable."""
    bad = (1, 10, "bad", 9, True, None, None, 0, at("10:00"), 0)
    table = KeyedTable(spark, root, KEYS, buckets=2)
    table.merge(frame(spark, [main("10:00", "x", 1, key=(1, k)) for k in range(20)]))
    stale = table.layout()
    table.merge(frame(spark, [main("11:00", "y", 2, key=(1, k)) for k in range(20)] + [bad]))
    before = rows_of(table.read()), sorted(map(str, table.changes().collect())), table.rejects().collect()
    for events in ([main("12:00", "z", 3, key=(1, k)) for k in range(15)], [bad]):
        with pytest.raises(ConcurrentCommit, match="version 2"):
            table._commit(frame(spark, events), stale, {})
        after = rows_of(table.read()), sorted(map(str, table.changes().collect())), table.rejects().collect()
        assert after == before and len(before[0]) == 20
    assert table.commits().count() == 2
    assert len(os.listdir(f"{root}/data")) == 2  # the loser took its files along
    assert table.merge(frame(spark, [main("12:00", "z", key=(1, 3))])) == 3


def test_racing_writers_lose_nothing(spark, root):
    """Four writers on one table: each merges again until it wins; all their rows are there at the end."""
    tables = [KeyedTable(spark, root, KEYS, buckets=2) for _ in range(4)]

    def work(i):
        for step in range(2):
            while True:
                try:
                    tables[i].merge(frame(spark, [main("10:00", f"{i}.{step}", key=(i, step))]))
                    break
                except ConcurrentCommit:
                    pass

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(work, range(4)))
    assert {k: v[0] for k, v in rows_of(tables[0].read()).items()} == {(i, s): f"{i}.{s}" for i in range(4) for s in range(2)}
    assert tables[0].versions() == list(range(1, 9))


def test_what_a_dying_writer_leaves_behind_is_no_version(spark, root):
    """Death at any point before the manifest is there: the table reads as before, and the next commit keeps all rows."""
    table = KeyedTable(spark, root, KEYS, buckets=4)
    table.merge(frame(spark, [main("10:00", "x", 1, key=(1, k)) for k in range(30)]))
    before = rows_of(table.read())
    os.makedirs(f"{root}/manifest/version=2/_temporary/0")  # an unfinished write
    os.makedirs(f"{root}/data/attempt=v2-dead/_temporary")
    with open(f"{root}/manifest/.000000000002.json.dead", "w") as half:  # a manifest that was not renamed
        half.write('{"version": 2, "held')
    assert table.versions() == [1] and table.layout().version == 1
    assert rows_of(table.read()) == before
    assert table.merge(frame(spark, [main("11:00", "y", key=(1, 7))])) == 2
    assert rows_of(table.read()) == before | {(1, 7): ("y", 1, True, None)}
    assert table.changes(since=2).count() == 2


def test_an_unreadable_manifest_is_an_error_not_an_empty_table(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=2)
    table.merge(frame(spark, [main("10:00", "x")]))
    os.rename(table._manifest(1), f"{root}/kept")
    os.remove(f"{root}/manifest/.000000000001.json.crc")
    with open(table._manifest(1), "w") as broken:
        broken.write('{"version": 1')
    for use in (table.layout, table.read, lambda: table.merge(frame(spark, [main("11:00", "y")]))):
        with pytest.raises(ValueError, match="Expecting"):
            use()
    os.replace(f"{root}/kept", table._manifest(1))
    assert rows_of(table.read())[(1, 10)][0] == "x"


def test_small_files_appear_whole_and_once(spark, root):
    publish_text(spark, f"{root}/note", "one é")
    with pytest.raises(FileExistsError):
        publish_text(spark, f"{root}/note", "two")
    assert read_text(spark, f"{root}/note") == "one é"
    assert [n for n in files_in(spark, root) if not n.startswith(".note.crc")] == ["note"]
    assert files_in(spark, f"{root}/none") == []


def test_changes_cost_what_changed(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=2)
    table.merge(frame(spark, [main("10:00", "x", key=(1, k)) for k in range(50)]))
    table.merge(frame(spark, [main("11:00", "y", key=(1, 7))]))
    files = table.changes(since=2).inputFiles()
    assert files and all("attempt=v2-" in f and "/silt_kind=update_" in f for f in files)
    read = spark.read.option("basePath", f"{root}/data").parquet(*files)
    assert read.count() == 2


def test_followers_see_published_commits_once_and_in_order(spark, root):
    table = KeyedTable(spark, f"{root}/t", KEYS, buckets=2)
    seen = []

    def note(changes, version):
        seen.append((version, sorted(r["_change_type"] for r in changes.collect())))

    table.merge(frame(spark, [main("10:00", "x"), main("10:00", "z", key=(2, 2))]))
    table.merge(frame(spark, [main("11:00", "y")]))
    table._write(frame(spark, [main("12:00", "dead")]), table.layout(), [0, 1], "v3-dead")  # never published
    table.follow(note, f"{root}/c").awaitTermination()
    assert seen == [(1, ["insert", "insert"]), (2, ["update_postimage", "update_preimage"])]
    table.merge(frame(spark, [main("12:00", "w")]))
    table.follow(note, f"{root}/c").awaitTermination()
    assert seen[2:] == [(3, ["update_postimage", "update_preimage"])]


def test_a_merge_is_as_wide_as_buckets_and_splits(spark, root):
    events = frame(spark, [main("10:00", "x", key=(1, k)) for k in range(40)])
    rows = absorb(None, events, KEYS, bucket="cast(pmod(k2, 5) AS int)", splits=3, partitions=15)
    rows.collect()
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(silt_bucket" in text and ", 15), REPARTITION_BY_NUM" in text


def test_a_new_column_appears_later(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=2)
    narrow = frame(spark, [main("10:00", "x", 1), main("10:00", "z", 3, key=(9, 9))]).drop("b")
    table.merge(narrow)
    table.merge(frame(spark, [main("11:00", None, 2)]))
    assert rows_of(table.read()) == {(1, 10): ("x", 2, True, None), (9, 9): ("z", None, True, None)}
    table.merge(narrow)  # an old producer without the column does not erase it
    assert rows_of(table.read())[(1, 10)] == ("x", 2, True, None)


def test_bucket_count_is_fixed(spark, root):
    KeyedTable(spark, root, KEYS, buckets=2).merge(frame(spark, [main("10:00", "x")]))
    with pytest.raises(ValueError, match="2 buckets"):
        KeyedTable(spark, root, KEYS, buckets=4).merge(frame(spark, [main("10:00", "x")]))


def test_without_tracking_only_inserts_are_reported(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=2, track_changes=False)
    table.merge(frame(spark, [main("10:00", "x")]))
    table.merge(frame(spark, [main("11:00", "y"), main("11:00", "n", key=(1, 11))]))
    assert rows_of(table.read()) == {(1, 10): ("y", None, True, None), (1, 11): ("n", None, True, None)}
    counts = [(r.inserted, r.updated) for r in table.commits().orderBy("version").collect()]
    assert counts == [(1, 0), (1, 0)]
    assert sorted((r.a, r["_change_type"]) for r in table.changes().collect()) == [("n", "insert"), ("x", "insert")]


def test_all_null_events_keep_their_key(spark, root):
    table = KeyedTable(spark, root, KEYS, buckets=2)
    nothing = recon("12:00", False)
    table.merge(frame(spark, [nothing]))
    table.merge(frame(spark, [nothing, recon("12:30", None)]))
    assert rows_of(table.read()) == {(1, 10): (None, None, None, None)}
    table.merge(frame(spark, [main("10:00", "x")]))
    assert rows_of(table.read()) == {(1, 10): ("x", None, True, None)}
    assert [c for c in table.read().columns if c in ORDER] == []
    assert table.commits().agg(F.sum("inserted")).first()[0] == 1


def test_a_full_bucket_without_a_hot_key_is_not_searched(spark, root, monkeypatch):
    """The scan that counts tells it from slots far smaller than a bucket."""
    searched, real = [], target.condense_hot_keys
    monkeypatch.setattr(target, "condense_hot_keys", lambda *args: searched.append(1) or real(*args))
    table = KeyedTable(spark, root, KEYS, buckets=3, hot_rows=20)
    many = [main("10:00", "x", key=(k % 5, k)) for k in range(300)]
    table.merge(frame(spark, many))
    assert not searched and table.layout().totals["events"] == 300
    hot = [main("11:00", f"y{i}", i, key=(2, 7), tie=i) for i in range(30)]
    table.merge(frame(spark, [*many, *hot]))
    assert searched == [1] and rows_of(table.read()) == expected([*many, *hot])
    assert sum(len(r.held_by) for r in table.commits().collect()) == 6  # buckets are named as before


def test_names_of_bits_cover_every_mask(spark):
    names = [f"c{i}'" for i in range(130)]
    masks = [sum(1 << i for i in range(63) if (i + 63 * m) % 3 == 0) for m in range(3)]
    row = spark.range(1).selectExpr(*[f"{m}L AS __own{i}" for i, m in enumerate(masks)])
    got = row.selectExpr(f"{names_of_bits('__own', names)} AS n").first().n
    assert got == names[::3]
    assert row.selectExpr(f"{names_of_bits('__own', names[:4])} AS n").first().n == [names[0], names[3]]


def test_rows_into_empty_buckets_are_written_once(spark, root):
    """They are their own images in the change feed, beside later commits that write images of their own."""
    table = KeyedTable(spark, root, KEYS, buckets=64)
    first = [main("10:00", "x", 1), main("10:00", "k", 2, key=(1, 11)), recon("12:00", False, key=(None, 12))]
    table.merge(frame(spark, first))
    attempt = table.commits().first().attempt
    assert [f for f in os.listdir(f"{root}/data/attempt={attempt}") if f.startswith("silt_kind")] == ["silt_kind=state"]
    table.merge(frame(spark, [main("11:00", "y"), main("11:00", "n", key=(2, 1))]))
    got = {(r.k1, r.k2, r.a, r["_change_type"], r["_commit_version"]) for r in table.changes().collect()}
    assert got == {
        (1, 10, "x", "insert", 1), (1, 11, "k", "insert", 1), (None, 12, None, "insert", 1),
        (1, 10, "x", "update_preimage", 2), (1, 10, "y", "update_postimage", 2), (2, 1, "n", "insert", 2),
    }
    assert [c for c in table.changes().columns if c.startswith("__")] == []
    assert [(r.inserted, r.updated, r.rows) for r in table.commits().orderBy("version").collect()] == [(3, 0, 3), (1, 1, 4)]


def test_each_part_of_a_full_load_has_its_own_task(spark, root):
    """A hash of so few numbers would put several parts into one task and leave others empty."""
    events = frame(spark, [main("10:00", "x", key=(1, k)) for k in range(600)])
    rows = absorb(None, events, KEYS, bucket=key_slot(KEYS, 12), splits=2, partitions=24, every_bucket=True)
    parts = rows.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count_distinct("silt_bucket").alias("n"))
    assert [r.n for r in parts.collect()] == [1] * 24
    table = KeyedTable(spark, root, KEYS, buckets=12, splits=2)
    table.merge(events)
    attempt = table.commits().first().attempt
    files = [len([f for f in os.listdir(p) if f.startswith("part-")]) for p in table.bucket_paths().values() if attempt in p]
    assert files == [2] * 12 and table.read().count() == 600


@pytest.mark.parametrize("cells", [1, 200])
def test_rounds_of_buckets_equal_one_merge(spark, root, cells):
    batches = [random_events(seed, count=60, keys=9) for seed in (5, 6, 7)]
    whole, parts = KeyedTable(spark, f"{root}/a", KEYS, buckets=6), KeyedTable(spark, f"{root}/b", KEYS, buckets=6, round_cells=cells)
    for batch in batches:
        for table in (whole, parts):
            table.merge(frame(spark, batch))
    shown = lambda df: sorted(map(repr, df.drop("_commit_timestamp").collect()))
    assert rows_of(parts.read()) == rows_of(whole.read()) == expected(sum(batches, []))
    assert shown(parts.changes()) == shown(whole.changes())
    counts = ("version", *target.COUNTS, "rows")
    assert shown(parts.commits().select(*counts)) == shown(whole.commits().select(*counts))
    assert parts.layout().schema == whole.layout().schema


def test_a_round_without_old_rows_keeps_its_inserts(spark, root):
    """One bucket is there already, so the commit writes images; the other round meets no old row."""
    keys = {key_slot_of(spark, (1, k)): (1, k) for k in range(40)}
    table = KeyedTable(spark, root, KEYS, buckets=2, round_cells=1)
    table.merge(frame(spark, [main("10:00", "x", key=keys[0])]))
    table.merge(frame(spark, [main("11:00", "y", key=k) for k in keys.values()]))
    got = sorted((r.k1, r.k2, r["_change_type"]) for r in table.changes(since=2).collect())
    both = [(*keys[0], "update_postimage"), (*keys[0], "update_preimage")]
    assert got == sorted([*both, (*keys[1], "insert")])


def key_slot_of(spark, key, buckets=2):
    return frame(spark, [main("10:00", "x", key=key)]).selectExpr(key_slot(KEYS, buckets)).first()[0]


def test_rounds_hold_whole_buckets():
    row = namedtuple("row", "b good bad crowd")
    counts = [row(3, 5, 0, 2), row(0, 4, 1, 4), row(1, 0, 7, 0), row(2, 6, 0, 3), row(5, 90, 0, 9), row(7, 1, 0, 1)]
    assert target.rounds(counts, 10) == [([0, 2], 4), ([3], 2), ([5], 9), ([7], 1)]
    assert target.rounds(counts, 1000) == [([0, 2, 3, 5, 7], 9)]
    assert target.rounds([], 10) == []
