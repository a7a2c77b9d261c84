from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import mixing, pii, quality_gbt
from meterline.llm.common import table
from meterline.session import SMALL_BUFFERS, VECTORED, cut
from tests.llm.conftest import FOLDER, rows_of
from tests.llm.test_duplicates import plain
from tests.llm.test_mixing_and_packing import check_packed, filled


def test_stages_equal_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    before, kept = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, FOLDER)
        path = str(tmp_path / name)
        out.write.parquet(path)
        kept.append(before.collect())
        before = spark.read.parquet(path)
    packed = before.collect()
    good = {r.doc_id for r in quality_gbt.score_quality(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept[1]} == good
    roots = plain([(r.doc_id, r.text) for r in kept[1]], corpus_pipeline.WIDTH, corpus_pipeline.PERCENT)
    assert {r.doc_id for r in kept[2]} == {i for i, (_, root) in roots.items() if root == i}
    again = spark.createDataFrame(kept[3], docs.schema)
    assert all(r.n_email + r.n_ip + r.n_card + r.n_phone == 0 for r in pii.personal_data(again).collect())
    assert {r.doc_id for r in kept[3]} == {r.doc_id for r in kept[2]}
    copies = {r.doc_id: r.copies for r in mixing.mix_table(again).collect()}
    assert Counter(r.doc_id for r in kept[4]) == Counter({i: n for i, n in copies.items() if n})
    check_packed(packed, [(r.doc_id, r.text) for r in kept[4]], 1.01)
    sizes = Counter()
    for r in kept[3]:
        sizes[r.source] += len(r.text.encode().split())
    assert abs(sum(filled(dict(sizes)).values()) - 1.5 * sum(sizes.values())) < 1
    assert all(set(rows[0].asDict()) == set(docs.columns) for rows in kept)


def test_run_gives_the_last_stage(spark):
    columns = corpus_pipeline.run(spark, FOLDER).columns
    assert columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows_of("documents")


def test_every_stage_takes_an_empty_table(spark, none, tmp_path):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, FOLDER)
        assert out.count() == 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == none.columns


def test_the_pipeline_runs_on_empty_and_on_odd_tables(spark, none, odd, tmp_path):
    for name, docs in (("none", none), ("odd", odd)):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(str(tmp_path / name / "labels.parquet"))
        packed = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert (len(packed) == 0) == (name == "none")
        places = {}
        for r in packed:
            places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in places.values():
            assert sum(n for _, n in parts) <= 4096 and sorted(parts)[0][0] == 0


def outside(spark) -> int:
    """Bytes of buffers outside the heap that Java knows of."""
    java = spark._jvm.java.lang
    pools = java.management.ManagementFactory.getPlatformMXBeans(java.Class.forName("java.lang.management.BufferPoolMXBean"))
    return next(p.getMemoryUsed() for p in pools if p.getName() == "direct")


def unsaid(spark) -> None:
    """The session as it is before an operator says how Parquet is read and written."""
    for key in SMALL_BUFFERS:
        if spark.conf.get(key, None) is not None:
            spark.conf.unset(key)


def hashes(n):
    """``n`` times 64 characters that do not compress to less than half."""
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.sha2(F.concat_ws("-", "id", i).cast("binary"), 256)), "")


def test_reading_a_long_column_keeps_no_buffer_of_its_length(spark, tmp_path):
    unsaid(spark)
    rows = spark.range(10_000).select(F.col("id").alias("doc_id"), hashes(F.lit(64)).alias("text"))
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    before = outside(spark)
    read = table(spark, str(tmp_path), "documents")
    assert read.agg(F.sum(F.length("text"))).first()[0] == 10_000 * 64 * 64
    assert outside(spark) - before < 20_000_000  # the column has 40 MB and does not compress


def test_pages_of_rows_by_size_stay_short(spark):
    unsaid(spark)
    # 3,000 short rows, from which the writer would guess how long it may go on, and 1,500 long ones
    n = F.when(F.col("id") < 3000, 1).otherwise(256).cast("int")
    before = outside(spark)
    held = cut(spark.range(4500).repartition(1).sort("id").coalesce(1).select("id", hashes(n).alias("text")), "by size")
    assert held.agg(F.sum(F.length("text"))).first()[0] == 3000 * 64 + 1500 * 64 * 256
    assert outside(spark) - before < 10_000_000


def test_an_explicit_choice_stays(spark):
    unsaid(spark)
    spark.conf.set(VECTORED, "true")
    try:
        cut(spark.range(3)).collect()
        assert spark.conf.get(VECTORED) == "true"
    finally:
        unsaid(spark)
