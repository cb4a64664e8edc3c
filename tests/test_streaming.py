import os

from conftest import write_text
from quarry.streaming import current_counts, start_word_count


def test_running_word_count_over_new_files(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    write_text(os.path.join(src, "a.txt"), "to be or not\n  to be\n")
    q = start_word_count(spark, src, os.path.join(scratch, "ckpt"), sink="memory", name="wc_test")
    try:
        q.processAllAvailable()
        assert dict(spark.table("wc_test").collect()) == {"to": 2, "be": 2, "or": 1, "not": 1}
        write_text(os.path.join(src, "b.txt"), "not\tto\n")
        q.processAllAvailable()
        assert dict(spark.table("wc_test").collect()) == {"to": 3, "be": 2, "or": 1, "not": 2}
    finally:
        q.stop()


def test_file_sink_writes_changed_words_per_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    write_text(os.path.join(src, "a.txt"), "x y x\n")
    out = os.path.join(scratch, "out")
    q = start_word_count(spark, src, os.path.join(scratch, "ckpt"), path=out)
    try:
        q.processAllAvailable()
        write_text(os.path.join(src, "b.txt"), "y z\n")
        q.processAllAvailable()
    finally:
        q.stop()
    # the second batch rewrites only the words it changed
    assert dict(current_counts(spark, out).collect()) == {"x": 2, "y": 2, "z": 1}


def test_batches_are_compacted(spark, scratch):
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(src)
    q = start_word_count(spark, src, os.path.join(scratch, "ckpt"), path=out, compact_every=2)
    try:
        for i in range(6):
            write_text(os.path.join(src, f"{i}.txt"), f"all w{i} w{i % 2}\n")
            q.processAllAvailable()
            assert dict(current_counts(spark, out).collect())["all"] == i + 1
    finally:
        q.stop()
    folders = sorted(os.listdir(out))
    # the last compacted folder and the one before it, and the batches between them
    assert [f for f in folders if f.startswith("upto=")] == ["upto=3", "upto=5"]
    assert [f for f in folders if f.startswith("batch=")] == ["batch=4", "batch=5"]
    assert dict(current_counts(spark, out).collect()) == {"all": 6, "w0": 4, "w1": 4, "w2": 1, "w3": 1, "w4": 1, "w5": 1}


def test_a_repeated_compaction_changes_nothing(spark, scratch):
    from quarry.streaming.wordcount import compact

    for n, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 5)]]):
        spark.createDataFrame(rows, "word string, occurrences long").write.parquet(f"{scratch}/batch={n}")
    for _ in range(2):
        compact(spark, scratch, 1)
        assert dict(current_counts(spark, scratch).collect()) == {"a": 2, "b": 1, "c": 5}
