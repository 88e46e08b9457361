"""Executed plans where inputs are above the broadcast threshold: alignments and tracks stay where they are."""

import re

import pytest
from pyspark.sql import functions as F

from spantrack import queries
from spantrack.operators import fragments, ordering, ratio, signal
from spantrack.plans import samples
from spantrack.sources import tracks, views, writers

DATA = "/root/testdata/sf0.1"


def executed(frame) -> str:
    """The final adaptive plan after the frame has run."""
    plan = frame._jdf.queryExecution().executedPlan()
    frame._jdf.queryExecution().toRdd().count()
    text = plan.toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["frag_pe", "signal_norm_30", "signal_scaled", "ratio_floor", "siq_signal", "spike_signal"])
def test_large_side_stays(spark, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200000")
    try:
        plan = executed(queries.queries()[name](spark, DATA))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Final Plan" in plan or name == "frag_pe"
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert not [k for k in keys if len(re.findall(r"#", k)) < 3], keys
    assert len(keys) <= 1 and "SortMergeJoin" not in plan and "BuildLeft" not in plan
    for part in plan.split("BroadcastExchange")[1:]:  # what is broadcast is a local table
        assert re.search(r"LocalTableScan", part.split("\n", 2)[1]) or "Project" in part.split("\n", 2)[1], part[:300]


def scans(plan: str) -> int:
    return plan.count("FileScan parquet") - plan.count("ReusedExchange")


class Shuffles:
    """Rows that each task of a frame's last run read from shuffles, by stage, as Spark's own status store has them."""

    def __init__(self, spark):
        self.store = spark.sparkContext._jsc.sc().statusStore()
        self.seen = {s.stageId() for s in self._stages()}

    def _stages(self):
        found = self.store.stageList(None, False, False, self._doubles(), None)
        return [found.apply(i) for i in range(found.size())]

    def _doubles(self):
        from pyspark import SparkContext

        return SparkContext._gateway.new_array(SparkContext._jvm.double, 0)

    def uneven(self, least: int) -> list[tuple[int, int, float]]:
        """(stage, most rows of a task, mean) of new stages that read ``least`` rows or more from a shuffle."""
        out = []
        for stage in self._stages():
            if stage.stageId() not in self.seen and stage.shuffleReadRecords() >= least:
                tasks = self.store.taskList(stage.stageId(), stage.attemptId(), 10_000)
                rows = [tasks.apply(i).taskMetrics().get().shuffleReadMetrics().recordsRead() for i in range(tasks.size())]
                out.append((stage.stageId(), max(rows), sum(rows) / len(rows)))
        return out


def test_names_that_begin_alike(spark):
    """All names share 20 characters and a third of the records one name: no task reads twice the mean."""
    n = 40_000
    name = F.concat(F.lit("A00123:45:HXXXXXX:1:"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")))
    records = spark.range(n).select(F.lit("s").alias("sample"), name.alias("qname"), (F.col("id") % 5).cast("int").alias("flag"))
    before, shuffles = spark.conf.get("spark.sql.shuffle.partitions"), Shuffles(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        got = fragments.numbered_by_name(records).select("qname", "flag", "place").collect()
        uneven = shuffles.uneven(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(r.place for r in got) == list(range(1, n + 1))
    ordered = sorted(got, key=lambda r: r.place)
    assert [(r.qname, r.flag) for r in ordered] == sorted((r.qname, r.flag) for r in got)
    assert uneven and all(most < 2 * mean for _, most, mean in uneven), uneven


def test_ranks_of_a_hot_place(spark):
    rows = spark.range(6000).select(F.lit("s").alias("sample"), F.lit("I").alias("chrom"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 50).cast("long").alias("bin_start"))
    got = ordering.ranked(rows, ["sample"], ["chrom", "bin_start"], [F.col("bin_start").asc()], "place").collect()
    starts = sorted(r.bin_start for r in got)
    assert all(r.place == starts.index(r.bin_start) + 1 for r in got[::37])
    assert len({(r.bin_start, r.place) for r in got}) == len(set(starts))


def test_a_place_with_most_fragments(spark):
    """90 percent of the fragments in one place: one scan, and no task reads twice the mean."""
    n = 40_000
    hot = F.col("id") % 10 != 0
    frags = spark.range(n).select(
        F.lit("s").alias("sample"), F.lit("I").alias("chrom"), F.when(hot, 5).otherwise(F.col("id")).cast("long").alias("frg_start"), F.when(hot, 105).otherwise(F.col("id") + 100).cast("long").alias("frg_end"),
        F.lit(100).alias("frg_len"), F.lit("+").alias("strand"), F.concat(F.lit("q"), F.col("id").cast("string")).alias("qname"), (F.col("id") % 40).cast("int").alias("mapq"), F.lit(0).alias("flag"),
    )
    before, shuffles = spark.conf.get("spark.sql.shuffle.partitions"), Shuffles(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        marked = fragments.mark_duplicates(frags)
        got = marked.select("qname", "flag").collect()
        uneven = shuffles.uneven(n)
        plan = executed(marked)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    kept = {r.qname for r in got if r.flag == 0}
    best = min((-(i % 40), f"q{i}") for i in range(n) if i % 10)[1]
    assert kept == {best} | {f"q{i}" for i in range(0, n, 10)}
    assert plan.count("Range (") == 1 and "Join" not in plan
    assert uneven and all(most < 2 * mean for _, most, mean in uneven), uneven


def test_duplicates_in_one_scan(spark):
    plan = executed(queries.queries()["frag_markdup"](spark, DATA))
    assert plan.count("FileScan") == 1 and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["frag_pe", "frag_fixed_len", "frag_primary"])
def test_fragments_are_compiled(spark, name):
    """No method of the generated code is above the 8,000 bytes from which the JVM doesn't compile it, and no filter takes names apart."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = queries.queries()[name](spark, DATA)._jdf.queryExecution()
        code = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:([0-9]+)", code)]
    assert sizes and max(sizes) < 8000, sizes
    assert "split(" not in plan.executedPlan().toString()


def test_streamed_files_get_more_with_the_table(spark, tmp_path, monkeypatch):
    """Twenty tasks read the table, so that twenty files arrive, three a batch: no fixed number of tasks takes all rows."""
    views.table(spark, "/root/testdata/sf0.001", "lineitem").repartition(20).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(queries, "_written", lambda spark, name: str(tmp_path / name))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(p.stat().st_size for p in tmp_path.glob("lineitem.parquet/*.parquet"))))
    try:
        got = queries.queries()["signal_streamed"](spark, str(tmp_path)).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == signal.bin_signal(fragments.fragments(views.alignments(spark, str(tmp_path)), views.contigs(spark)), 30, "norm").count()
    assert len(list(tmp_path.glob("stream/in/*.parquet"))) == 20 and len(list(tmp_path.glob("stream/out/bins/batch=*"))) == 7


def test_lines_before_a_marker_stay(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(queries.queries()["gff_before_marker"](spark, DATA))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_ratio_and_companion_are_one_sort(spark, tmp_path):
    """What the write ran: one scan's computation, one range exchange and one sort for both files."""
    track = ratio.ratio_of(ratio.paired_signal(fragments.fragments(views.alignments(spark, DATA), views.contigs(spark)), 50, "unadj"), log2=True)
    seen = spark._jsparkSession.sharedState().statusStore()
    count = seen.executionsCount()
    writers.write_ratio(track, str(tmp_path / "r"))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = seen.executionsList()
    new = [runs.apply(i).physicalPlanDescription() for i in range(int(count), runs.size())]
    writes = [x for x in new if "InsertIntoHadoopFsRelationCommand" in x]
    assert len(writes) == 1
    final = writes[0].split("== Initial Plan ==")[0]
    tree = final.split("\n\n")[0]
    assert len(re.findall(r"[-+ ]Sort ", tree)) == 1 and tree.count("Scan parquet") == 1 and tree.count("Exchange") == 4, tree  # dealt to cores, bins, the sort's range, contigs


def test_stored_tracks_merge_where_they_lie(spark):
    plan = executed(queries.queries()["track_merge_stored"](spark, DATA))
    assert "Exchange" not in plan and "Bucketed: true" in plan and "SortMergeJoin" in plan


def test_regions_prune_folders_and_row_groups(spark, tmp_path):
    track = signal.bin_signal(fragments.fragments(views.alignments(spark, DATA), views.contigs(spark)), 10, "unadj")
    tracks.save_by_contig(track, str(tmp_path / "t"))
    regions = spark.createDataFrame([("a", "II", 100, 900), ("b", "X", 5000, 6000)], "region string, chrom string, start long, end long")
    found = tracks.stored_region_max(spark, str(tmp_path / "t"), regions)
    want = signal.region_max(track, regions)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    plan = executed(found)
    scan = next(x for x in plan.splitlines() if "FileScan parquet" in x)
    assert re.search(r"PartitionFilters: \[.*chrom.*IN", scan) and "GreaterThanOrEqual(bin_end," in scan and "LessThan(bin_start," in scan
    more = [(f"r{i}", "V" if i % 2 else "VI", 10 * i + 1, 10 * i + 30) for i in range(tracks.STATED_REGIONS + 5)]
    many = spark.createDataFrame(more, regions.schema)
    found = tracks.stored_region_max(spark, str(tmp_path / "t"), many)
    scan = next(x for x in executed(found).splitlines() if "FileScan parquet" in x)
    assert re.search(r"PartitionFilters: \[.*chrom.*IN", scan)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, signal.region_max(track, many).collect()))


def test_scaled_ratio_reads_alignments_twice(spark):
    """Once for all figures while the frame is built, once for the tracks."""
    seen = spark._jsparkSession.sharedState().statusStore()
    count = seen.executionsCount()
    out = samples.siq_signal(views.alignments(spark, DATA), views.contigs(spark), views.group_measurements(spark, DATA).withColumnRenamed("grp", "pair"))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = seen.executionsList()
    built = [runs.apply(i).physicalPlanDescription() for i in range(int(count), runs.size())]
    assert sum("lineitem" in x for x in built) == 1
    assert executed(out).count("FileScan parquet") == 1


def test_run_length_statistics_make_no_bases(spark):
    plan = executed(queries.queries()["coverage_stats"](spark, DATA))
    assert plan.count("Generate") <= 4 and not re.search(r"sequence\(start", plan)
