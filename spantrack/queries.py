"""Queries over the driver's tables, one per operator or small group, each with its SQL.

The SQL is another formulation, not a translation: the bins that a fragment touches
are listed by number, ratios come from conditional sums over finished tracks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spantrack.functions.scalars import fixed, roman_number
from spantrack.operators import factors, fragments, genome, matching, ratio, signal
from spantrack.plans import samples as plans
from spantrack.sources import folders, readers, tracks, views, writers
from spantrack.streaming import tracks as streamed

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__], _sql[f.__name__] = f, sql
        return f

    return add


def _list(values: tuple) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


RAW = f"""raw AS (
 SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS qname,
  l_returnflag AS grp, CASE WHEN l_linestatus = 'O' THEN 'IP' ELSE 'in' END AS assay,
  {_list(views.CONTIGS)}[(l_partkey * 31 + l_orderkey) % 19 + 1] AS chrom,
  (l_partkey * 7919 + l_orderkey * 104729 + l_linenumber * 1299709) % 20000 AS pos,
  CAST(l_quantity AS INTEGER) * 4 + 50 AS tlen, {_list(views.FLAGS)}[(l_orderkey + l_linenumber) % 10 + 1] AS flag,
  CAST(round(l_discount * 100) AS INTEGER) AS mapq FROM lineitem)"""
ALN = f"{RAW}, aln AS (SELECT assay || '_' || grp AS sample, grp, assay, qname, flag, chrom, pos, pos + 50 AS ref_end, tlen, 50 AS aln_len, mapq FROM raw)"


def _frags(length: str = "CASE WHEN flag & 1 <> 0 THEN tlen ELSE aln_len END", where: str = "flag & 2048 = 0") -> str:
    return f"""{ALN},
 kept AS (SELECT *, CAST({length} AS INTEGER) AS frg_len FROM aln WHERE flag & 4 = 0 AND {where} AND (flag & 1 = 0 OR (flag & 2 <> 0 AND tlen > 0))),
 placed AS (SELECT *, CASE WHEN flag & 1 = 0 AND flag & 16 <> 0 THEN ref_end - frg_len ELSE pos END AS s FROM kept WHERE frg_len > 0),
 frags AS (SELECT sample, chrom, greatest(s, 0) AS frg_start, least(s + frg_len, {views.CONTIG_LENGTH}) AS frg_end, frg_len,
   CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand, qname, mapq, flag
  FROM placed WHERE least(s + frg_len, {views.CONTIG_LENGTH}) > greatest(s, 0))"""


FRAGS = _frags()
FRAG_COLUMNS = "sample, qname, chrom, frg_start, frg_end, frg_len, strand"


def _track(width: int, method: str, frags: str = FRAGS, end: str = "frg_end") -> str:
    value = {"unadj": "CAST(sum(bases) AS DOUBLE)", "frag": "sum(bases / CAST(frg_len AS DOUBLE))", "norm": "sum(bases / CAST(frg_len AS DOUBLE)) / any_value(n)"}[method]
    return f"""{frags},
 n AS (SELECT sample, count(*) AS n FROM frags GROUP BY sample),
 touched AS (SELECT sample, chrom, frg_len, frg_start AS s, {end} AS e, unnest(generate_series(frg_start // {width}, ({end}) // {width})) AS k FROM frags),
 pieces AS (SELECT sample, chrom, frg_len, k, least(e, k * {width} + {width - 1}) - greatest(s, k * {width}) + 1 AS bases FROM touched),
 track AS MATERIALIZED (SELECT sample, chrom, k * {width} AS bin_start, k * {width} + {width} AS bin_end, {value} AS signal FROM pieces JOIN n USING (sample) GROUP BY sample, chrom, k)"""


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.alignments(spark, sf_dir)


def _fragments(spark: SparkSession, sf_dir: str, length=None, **filters) -> DataFrame:
    return fragments.fragments(_aligned(spark, sf_dir), views.contigs(spark), length, **filters)


def _track_of(spark: SparkSession, sf_dir: str, width: int, method: str) -> DataFrame:
    return signal.bin_signal(_fragments(spark, sf_dir), width, method)


def _places(frags: DataFrame) -> DataFrame:
    return frags.select("sample", "qname", "chrom", "frg_start", "frg_end", "frg_len", "strand")


# Fragments.


@query(f"WITH {FRAGS} SELECT {FRAG_COLUMNS} FROM frags WHERE flag & 1 <> 0")
def frag_pe(spark, sf_dir):
    aligned = _aligned(spark, sf_dir).where(fragments.has(fragments.PAIRED))
    return _places(fragments.fragments(aligned, views.contigs(spark)))


@query(f"WITH {FRAGS} SELECT {FRAG_COLUMNS} FROM frags WHERE flag & 1 = 0")
def frag_se(spark, sf_dir):
    aligned = _aligned(spark, sf_dir).where(~fragments.has(fragments.PAIRED))
    return _places(fragments.fragments(aligned, views.contigs(spark)))


@query(f"WITH {_frags('CASE WHEN mapq > 5 THEN 120 WHEN flag & 1 <> 0 THEN tlen ELSE aln_len END', 'flag & 2048 = 0 AND flag & 1024 = 0')} SELECT {FRAG_COLUMNS} FROM frags")
def frag_fixed_len(spark, sf_dir):
    return _places(_fragments(spark, sf_dir, F.when(F.col("mapq") > 5, 120), allow_duplicate=False))


@query(f"WITH {_frags(where='TRUE')} SELECT sample, count(*) AS frg_tot, CAST(sum(frg_end - frg_start) AS BIGINT) AS bases, CAST(sum(CASE WHEN frg_end - frg_start < frg_len THEN 1 ELSE 0 END) AS BIGINT) AS n_clamped FROM frags GROUP BY sample")
def frag_clamped(spark, sf_dir):
    clamped = F.count_if(F.col("frg_end") - F.col("frg_start") < F.col("frg_len")).alias("n_clamped")
    return _fragments(spark, sf_dir, allow_supplementary=True).groupBy("sample").agg(F.count("*").alias("frg_tot"), F.sum(F.col("frg_end") - F.col("frg_start")).alias("bases"), clamped)


@query(f"""WITH {_frags(where="flag & 2048 = 0 AND flag & 256 = 0").replace("% 10 + 1] AS flag", "% 10 + 1] | CASE WHEN (l_orderkey + l_partkey) % 4 = 0 THEN 256 ELSE 0 END AS flag")} SELECT {FRAG_COLUMNS} FROM frags""")
def frag_primary(spark, sf_dir):
    """Fragments of primary records only, where every fourth or so is a secondary one."""
    return _places(fragments.fragments(views.alignments(spark, sf_dir, secondary=True), views.contigs(spark), allow_secondary=False))


MATES = f"""{RAW}, mates AS (
 SELECT assay || '_' || grp AS sample, qname, 99 AS flag, chrom, pos, 50 AS aln_len, mapq FROM raw
 UNION ALL SELECT assay || '_' || grp, qname, 147, chrom, pos + tlen - 50, 50, mapq FROM raw)"""


@query(f"WITH {MATES} SELECT sample, qname, any_value(chrom) AS chrom, min(pos) AS frg_start, max(pos) + 49 AS frg_end, max(pos) + 49 - min(pos) + 1 AS frg_len FROM mates GROUP BY sample, qname HAVING count(*) = 2 AND count(DISTINCT chrom) = 1")
def frag_mate_join(spark, sf_dir):
    return fragments.join_mates(views.mates(spark, sf_dir))


# Both records of a lineitem are known from its row, so that nothing has to be joined.
@query(f"""WITH {RAW} SELECT assay || '_' || grp AS sample, qname, 99 AS flag, pos, chrom AS mate_chrom, pos + tlen - 50 AS mate_pos, CAST(greatest(pos, pos + tlen - 50) + 50 - least(pos, pos + tlen - 50) AS INTEGER) AS tlen FROM raw
 UNION ALL SELECT assay || '_' || grp, qname, 147, pos + tlen - 50, chrom, pos, CAST(least(pos, pos + tlen - 50) - greatest(pos, pos + tlen - 50) - 50 AS INTEGER) FROM raw""")
def frag_fixmate(spark, sf_dir):
    return fragments.fix_mates(views.mates(spark, sf_dir)).select("sample", "qname", "flag", "pos", "mate_chrom", "mate_pos", "tlen")


@query(f"""WITH {FRAGS.replace("% 20000 AS pos", "% 20000 // 500 * 500 AS pos")}, k AS (SELECT *, row_number() OVER (PARTITION BY sample, chrom, frg_start, frg_end, strand ORDER BY mapq DESC, qname) AS n FROM frags)
 SELECT sample, qname, chrom, frg_start, frg_end, CASE WHEN n = 1 THEN flag ELSE flag | 1024 END AS flag FROM k""")
def frag_markdup(spark, sf_dir):
    coarse = F.col("pos") - F.col("pos") % 500
    aligned = _aligned(spark, sf_dir).withColumn("pos", coarse).withColumn("ref_end", F.col("pos") + 50)
    return fragments.mark_duplicates(fragments.fragments(aligned, views.contigs(spark))).select("sample", "qname", "chrom", "frg_start", "frg_end", "flag")


# Counts.

COUNTED = "flag IN (99, 1123, 163, 1187)"


@query(f"WITH {ALN} SELECT sample, count(*) FILTER (WHERE {COUNTED}) AS paired, count(*) FILTER (WHERE flag IN (0, 1024, 16, 1040)) AS single, count(*) FILTER (WHERE {COUNTED} AND flag & 4 = 0) AS tally FROM aln GROUP BY sample")
def count_align(spark, sf_dir):
    counts = [F.count_if(c).alias(n) for n, c in (("paired", fragments.counted()), ("single", fragments.counted("single")), ("tally", fragments.mapped_tally()))]
    return _aligned(spark, sf_dir).groupBy("sample").agg(*counts)


@query(f"WITH {ALN} SELECT sample, count(*) FILTER (WHERE {COUNTED}) AS depth, round(avg(tlen) FILTER (WHERE {COUNTED} AND tlen > 0), 6) AS length FROM aln GROUP BY sample")
def frag_len_mean(spark, sf_dir):
    return factors.depths(_aligned(spark, sf_dir)).withColumn("length", F.round("length", 6))


@query(f"""WITH {ALN}, t AS (SELECT sample || '_' || chrom AS sample, CASE WHEN chrom LIKE 'SP%' THEN 0 ELSE tlen END AS tlen, CASE WHEN chrom = 'SP_III' THEN 0 ELSE flag END AS flag FROM aln),
 d AS (SELECT sample, count(*) FILTER (WHERE {COUNTED}) AS depth, avg(tlen) FILTER (WHERE {COUNTED} AND tlen > 0) AS length FROM t GROUP BY sample)
 SELECT sample, 'no countable alignments' AS problem FROM d WHERE depth = 0 UNION ALL SELECT sample, 'no positive template length' FROM d WHERE length IS NULL""")
def dq_depths(spark, sf_dir):
    spike = F.col("chrom").startswith("SP")
    split = _aligned(spark, sf_dir).select(F.concat_ws("_", "sample", "chrom").alias("sample"), F.when(spike, 0).otherwise(F.col("tlen")).alias("tlen"), F.when(F.col("chrom") == "SP_III", 0).otherwise(F.col("flag")).alias("flag"))
    return factors.depth_errors(factors.depths(split))


@query(f"WITH {FRAGS} SELECT sample, count(*) AS n, round(avg(frg_len), 6) AS mean_length FROM frags GROUP BY sample")
def bed_len_mean(spark, sf_dir):
    return factors.bed_lengths(_fragments(spark, sf_dir)).withColumn("mean_length", F.round("mean_length", 6))


@query(f"WITH {ALN} SELECT sample, qname, flag, mapq FROM aln WHERE mapq >= 3 AND (flag & 1 = 0 OR flag & 2 <> 0)")
def mapq_filter(spark, sf_dir):
    return _aligned(spark, sf_dir).where(fragments.quality_at_least(3, True)).select("sample", "qname", "flag", "mapq")


@query(f"WITH {ALN} SELECT sample, count(*) FILTER (WHERE {COUNTED} AND chrom NOT LIKE 'SP%') AS main, count(*) FILTER (WHERE {COUNTED} AND chrom LIKE 'SP%') AS spike FROM aln GROUP BY sample")
def organism_split(spark, sf_dir):
    return factors.organism_counts(_aligned(spark, sf_dir))


@query(f"""WITH {ALN}, named AS (SELECT sample, CASE chrom WHEN 'I' THEN 'SP_II_TG' WHEN 'II' THEN 'SP_MTR' WHEN 'III' THEN 'SP_Mito' WHEN 'IV' THEN 'Mito' ELSE chrom END AS chrom FROM aln), n AS (SELECT sample, chrom, count(*) AS n FROM named GROUP BY ALL)
 SELECT sample, {', '.join(f"CAST(sum(n) FILTER (WHERE chrom IN ({chrom_list})) AS BIGINT) AS {name}" for name, chrom_list in (
    ('spike', "'SP_I', 'SP_II', 'SP_III'"), ('spike_tg', "'SP_I', 'SP_II', 'SP_III', 'SP_II_TG'"), ('spike_mtr', "'SP_I', 'SP_II', 'SP_III', 'SP_MTR'"), ('spike_mito', "'SP_I', 'SP_II', 'SP_III', 'SP_Mito'"),
    ('spike_all', "'SP_I', 'SP_II', 'SP_III', 'SP_II_TG', 'SP_MTR', 'SP_Mito'")))},
 CAST(sum(n) FILTER (WHERE chrom NOT LIKE 'SP%' AND chrom <> 'Mito') AS BIGINT) AS main, CAST(sum(n) FILTER (WHERE chrom NOT LIKE 'SP%') AS BIGINT) AS main_mito FROM n GROUP BY sample""")
def organism_contigs(spark, sf_dir):
    """Records on either organism's contigs, with and without the optional ones."""
    renamed = {"I": "SP_II_TG", "II": "SP_MTR", "III": "SP_Mito", "IV": "Mito"}
    named = _aligned(spark, sf_dir).replace(renamed, subset="chrom")
    on = {"spike": fragments.on_spike(), "spike_tg": fragments.on_spike(tg=True), "spike_mtr": fragments.on_spike(mtr=True), "spike_mito": fragments.on_spike(mito=True), "spike_all": fragments.on_spike(True, True, True), "main": fragments.on_main(), "main_mito": fragments.on_main(True)}
    return named.groupBy("sample").agg(*[F.count_if(x).alias(name) for name, x in on.items()])


@query(f"WITH {ALN} SELECT sample, CASE WHEN bool_or(flag & 1 = 1) THEN 'paired' ELSE 'single' END AS layout FROM aln GROUP BY sample")
def seq_layout(spark, sf_dir):
    return fragments.layouts(_aligned(spark, sf_dir))


@query(f"WITH {ALN} SELECT DISTINCT chrom FROM aln WHERE chrom NOT LIKE 'SP%'")
def contig_distinct(spark, sf_dir):
    return genome.contigs_present(_aligned(spark, sf_dir).where(fragments.on_main(True)))


# Signals.

TRACK = "sample, chrom, bin_start, bin_end"


@query(f"WITH {_track(10, 'unadj')} SELECT {TRACK}, signal FROM track")
def signal_unadj_10(spark, sf_dir):
    return _track_of(spark, sf_dir, 10, "unadj")


@query(f"WITH {_track(10, 'frag')} SELECT {TRACK}, round(signal, 6) AS signal FROM track")
def signal_frag_10(spark, sf_dir):
    return _track_of(spark, sf_dir, 10, "frag").withColumn("signal", F.round("signal", 6))


@query(f"WITH {_track(30, 'norm')} SELECT {TRACK}, round(signal * 1e6, 3) AS signal FROM track")
def signal_norm_30(spark, sf_dir):
    return _track_of(spark, sf_dir, 30, "norm").withColumn("signal", F.round(F.col("signal") * 1e6, 3))


@query(f"WITH {_track(10, 'norm', end='frg_end - 1')} SELECT {TRACK}, round(signal * 1e6, 3) AS signal FROM track")
def signal_norm_half_open(spark, sf_dir):
    track = signal.bin_signal(_fragments(spark, sf_dir), 10, "norm", closed_end=False)
    return track.withColumn("signal", F.round(F.col("signal") * 1e6, 3))


@query(f"WITH {_track(1, 'unadj')} SELECT {TRACK}, signal FROM track")
def coverage_1bp(spark, sf_dir):
    return signal.coverage(_fragments(spark, sf_dir))


@query(f"""WITH {_track(20, 'frag')}, f AS (SELECT sample, count(*) FILTER (WHERE {COUNTED}) / 1000.0 AS factor FROM aln WHERE assay = 'IP' GROUP BY sample)
 SELECT {TRACK}, round(signal * coalesce(factor, 1.0), 5) AS signal FROM track LEFT JOIN f USING (sample)""")
def signal_scaled(spark, sf_dir):
    chosen = factors.depths(_aligned(spark, sf_dir)).where(F.col("sample").startswith("IP_")).select("sample", (F.col("depth") / 1000).alias("factor"))
    return signal.scaled(_track_of(spark, sf_dir, 20, "frag"), chosen).withColumn("signal", F.round("signal", 5))


@query(f"WITH {_track(10, 'norm')} SELECT sample, round(sum(signal), 9) AS total, sum(signal) BETWEEN 0.98 AND 1.02 AS is_unity FROM track GROUP BY sample")
def track_unity(spark, sf_dir):
    return signal.unity(_track_of(spark, sf_dir, 10, "norm")).withColumn("total", F.round("total", 9))


@query(f"WITH {_track(10, 'frag')} SELECT sample, round(min(signal), 6) AS min, round(max(signal), 6) AS max, round(avg(signal), 6) AS avg, round(sum(signal), 4) AS sum FROM track GROUP BY sample")
def track_stats(spark, sf_dir):
    out = signal.statistics(_track_of(spark, sf_dir, 10, "frag"))
    return out.withColumns({c: F.round(c, 4 if c == "sum" else 6) for c in ("min", "max", "avg", "sum")})


REGIONS = f"""contigs AS (SELECT unnest({_list(views.CONTIGS)}) AS c, {views.CONTIG_LENGTH} AS chrom_len),
 given AS (SELECT unnest({_list(views.REGIONS)}) AS region),
 split AS (SELECT region, regexp_extract(region, '^(?:chr)?([IVX]+|[0-9]+)(?::([0-9]+)-([0-9]+))?$', ['name', 'a', 'b']) AS m FROM given),
 named AS (SELECT region, CASE WHEN m.name = '' OR (m.name NOT SIMILAR TO '[0-9]+' AND NOT list_contains({_list(views.MAIN)}, m.name)) THEN NULL
   WHEN m.name SIMILAR TO '[0-9]+' THEN coalesce({_list(views.MAIN)}[TRY_CAST(m.name AS INTEGER)], m.name) ELSE m.name END AS chrom, m.a, m.b FROM split),
 sized AS (SELECT region, chrom, chrom_len, CASE WHEN a = '' AND chrom IS NOT NULL THEN 1 ELSE TRY_CAST(a AS BIGINT) END AS start, CASE WHEN a = '' AND chrom IS NOT NULL THEN chrom_len ELSE TRY_CAST(b AS BIGINT) END AS stop
  FROM named LEFT JOIN contigs ON chrom = c),
 regions AS (SELECT *, CASE WHEN chrom IS NULL THEN 'format' WHEN chrom_len IS NULL THEN 'contig' WHEN start IS NULL OR stop IS NULL OR start < 1 THEN 'start'
  WHEN stop < start THEN 'order' WHEN stop > chrom_len THEN 'bounds' END AS error FROM sized)"""


@query(f"WITH {_track(10, 'unadj')}, {REGIONS} SELECT region, sample, max(signal) AS max_signal FROM track JOIN regions r ON track.chrom = r.chrom AND error IS NULL AND bin_start < stop AND bin_end >= start GROUP BY region, sample")
def region_max(spark, sf_dir):
    parsed = signal.parse_regions(views.regions(spark), views.contigs(spark)).where("error IS NULL")
    return signal.region_max(_track_of(spark, sf_dir, 10, "unadj"), parsed)


@query(f"WITH {ALN}, {REGIONS} SELECT r.region, r.error, count(sample) AS n FROM regions r LEFT JOIN aln ON aln.chrom = r.chrom AND r.error IS NULL AND pos < stop AND pos + 1 >= start GROUP BY ALL")
def region_counts(spark, sf_dir):
    parsed = signal.parse_regions(views.regions(spark), views.contigs(spark))
    places = _aligned(spark, sf_dir).select("chrom", F.col("pos").alias("bin_start"), (F.col("pos") + 1).alias("bin_end"))
    found = signal.in_region(places, parsed.where("error IS NULL")).groupBy("region").agg(F.count("*").alias("n"))
    return parsed.select("region", "error").join(found, "region", "left").select("region", "error", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


# Ratios.

# Both signals of a pair by one grouping of all samples' bins; a side that has no bin is 0.
BOTH = """merged AS (SELECT substr(sample, 4) AS pair, chrom, bin_start, min(bin_end) AS bin_end,
  coalesce(sum(CASE WHEN sample LIKE 'IP%' THEN signal END), 0.0) AS ip, coalesce(sum(CASE WHEN sample LIKE 'in%' THEN signal END), 0.0) AS control FROM track GROUP BY 1, 2, 3)"""
PLACE = "pair, chrom, bin_start, bin_end"
DEPTHS = f"d AS (SELECT grp AS pair, count(*) FILTER (WHERE {COUNTED} AND assay = 'in') AS dep_in, count(*) FILTER (WHERE {COUNTED} AND assay = 'IP') AS dep_ip, avg(tlen) FILTER (WHERE {COUNTED} AND tlen > 0 AND assay = 'in') AS len_in, avg(tlen) FILTER (WHERE {COUNTED} AND tlen > 0 AND assay = 'IP') AS len_ip FROM aln GROUP BY grp)"


def _ratio(value: str, digits: int = 6) -> str:
    return f"SELECT {PLACE}, round({value}, {digits}) AS value, CASE WHEN r IS NULL THEN 'nan' WHEN r = 0 AND is_log THEN 'neginf' ELSE 'finite' END AS kind FROM q"


def _ratio_of(spark: SparkSession, sf_dir: str, width: int, method: str, figures: DataFrame | None = None, log2: bool = False) -> DataFrame:
    return ratio.ratio_of(ratio.paired_signal(_fragments(spark, sf_dir), width, method), figures, log2)


@query(f"WITH {_track(10, 'unadj')}, {BOTH}, q AS (SELECT *, FALSE AS is_log, CASE WHEN control <> 0 THEN ip / control END AS r FROM merged) {_ratio('r')}")
def ratio_plain(spark, sf_dir):
    return ratio.with_kind(_ratio_of(spark, sf_dir, 10, "unadj")).withColumn("value", F.round("value", 6))


@query(f"WITH {_track(10, 'norm')}, {BOTH}, q AS (SELECT *, FALSE AS is_log, ip / greatest(control, 10.0 / 12157095) AS r FROM merged) {_ratio('r')}")
def ratio_floor(spark, sf_dir):
    floors = _figures(spark, sf_dir).select("pair", factors.floor_value(F.col("dep_in"), 10, mode="norm").alias("floor"))
    return ratio.with_kind(_ratio_of(spark, sf_dir, 10, "norm", floors)).withColumn("value", F.round("value", 6))


@query(f"WITH {_track(20, 'unadj')}, {BOTH}, q AS (SELECT *, TRUE AS is_log, CASE WHEN control <> 0 THEN ip / control END AS r FROM merged) {_ratio('CASE WHEN r > 0 THEN log2(r) END')}")
def ratio_log2(spark, sf_dir):
    return ratio.with_kind(_ratio_of(spark, sf_dir, 20, "unadj", log2=True)).withColumn("value", F.round("value", 6))


@query(f"WITH {_track(20, 'frag')}, {BOTH} SELECT {PLACE}, round(log2(ip / control), 6) AS value FROM merged WHERE control <> 0 AND ip > 0")
def ratio_track(spark, sf_dir):
    return ratio.finite(_ratio_of(spark, sf_dir, 20, "frag", log2=True)).withColumn("value", F.round("value", 6))


@query(f"WITH {_track(30, 'norm')}, {BOTH}, {DEPTHS}, q AS (SELECT merged.*, TRUE AS is_log, dep_ip / dep_in AS f, CASE WHEN control <> 0 THEN ip / control END AS r FROM merged JOIN d USING (pair)) {_ratio('CASE WHEN r > 0 THEN log2(r) * f END')}")
def ratio_scaled(spark, sf_dir):
    chosen = _figures(spark, sf_dir).select("pair", (F.col("dep_ip") / F.col("dep_in")).alias("factor"))
    return ratio.with_kind(_ratio_of(spark, sf_dir, 30, "norm", chosen, True)).withColumn("value", F.round("value", 6))


@query(f"WITH {_track(50, 'unadj')}, {BOTH} SELECT {PLACE}, ip, control FROM merged")
def track_merge(spark, sf_dir):
    return ratio.merge(*ratio.pair_tracks(_track_of(spark, sf_dir, 50, "unadj")))


def _figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.pair_figures(_aligned(spark, sf_dir))


# Factors.

MEASURED = "m AS (SELECT ['A', 'N', 'R'][p_partkey % 3 + 1] AS pair, min(p_retailprice) / 100 AS mass_ip, max(p_retailprice) / 10 AS mass_in, 300.0 AS vol_all, 20.0 AS vol_in FROM part GROUP BY 1)"
ALPHA = {
    "5": "mass_ip / mass_in * (vol_in / vol_all) * (CAST(dep_in AS DOUBLE) / dep_ip) * (len_in / len_ip)",
    "5nd": "mass_ip / mass_in * (vol_in / vol_all) * (len_in / len_ip)",
    "6": "mass_ip / (660 * len_ip * (vol_all - vol_in)) / dep_ip / (mass_in / (660 * len_in * vol_in) / dep_in)",
    "6nd": "mass_ip / (660 * len_ip * (vol_all - vol_in)) / (mass_in / (660 * len_in * vol_in))",
}


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.group_measurements(spark, sf_dir).withColumnRenamed("grp", "pair")


def _alpha(equation: str) -> None:
    def run(spark, sf_dir):
        table = plans.alpha_table(_aligned(spark, sf_dir), _measured(spark, sf_dir), equation)
        return table.select("pair", F.round("alpha", 9).alias("alpha"), "eqn")

    run.__name__ = f"alpha_{equation}"
    query(f"WITH {ALN}, {DEPTHS}, {MEASURED} SELECT pair, round({ALPHA[equation]}, 9) AS alpha, '{equation}' AS eqn FROM d JOIN m USING (pair)")(run)


for _equation in factors.EQUATIONS:
    _alpha(_equation)

FLOORS = ", ".join([f"round(dep_in * {float(b)} / {factors.GENOME_SIZE - b}, 9) AS dm_fr_{b}" for b in factors.FLOOR_BINS] + [f"round({float(b)} / {factors.GENOME_SIZE - b} * 1e6, 9) AS dm_nm_{b}" for b in factors.FLOOR_BINS])


def _rounded_floors(table: DataFrame) -> DataFrame:
    return table.withColumns({c: F.round(F.col(c) * (1e6 if "_nm_" in c else 1.0), 9) for c in factors.FLOORS})


@query(f"""WITH {ALN}, {DEPTHS}, {MEASURED} SELECT pair, 'IP_' || pair AS fil_ip, 'in_' || pair AS fil_in, round({ALPHA['6nd']}, 9) AS alpha, '6nd' AS eqn,
 round(mass_ip, 6) AS mass_ip, round(mass_in, 6) AS mass_in, vol_all::DOUBLE AS vol_all, vol_in::DOUBLE AS vol_in, dep_ip, dep_in, round(len_ip, 6) AS len_ip, round(len_in, 6) AS len_in, {FLOORS} FROM d JOIN m USING (pair)""")
def alpha_table(spark, sf_dir):
    table = plans.alpha_table(_aligned(spark, sf_dir), _measured(spark, sf_dir))
    return _rounded_floors(table.withColumns({c: F.round(c, 9 if c == "alpha" else 6) for c in ("alpha", "mass_ip", "mass_in", "len_ip", "len_in")}))


SPIKED = f"s AS (SELECT grp AS pair, {', '.join(f'count(*) FILTER (WHERE {COUNTED} AND assay = {chr(39)}{a}{chr(39)} AND chrom {o} {chr(39)}SP%{chr(39)}) AS num_{n}' for n, a, o in (('mp', 'IP', 'NOT LIKE'), ('sp', 'IP', 'LIKE'), ('mn', 'in', 'NOT LIKE'), ('sn', 'in', 'LIKE')))} FROM aln GROUP BY grp)"
SPIKE = "(CAST(num_sn AS DOUBLE) / (num_mn + num_sn)) / (CAST(num_sp AS DOUBLE) / (num_mp + num_sp))"


@query(f"WITH {ALN}, {SPIKED} SELECT pair, round({SPIKE}, 9) AS spike FROM s")
def spike_factor(spark, sf_dir):
    return plans.spike_table(_aligned(spark, sf_dir)).select("pair", F.round("spike", 9).alias("spike"))


@query(f"""WITH {ALN}, {SPIKED} SELECT pair, 'IP_' || pair || '.sc' AS main_ip, 'IP_' || pair || '.sp' AS spike_ip, 'in_' || pair || '.sc' AS main_in, 'in_' || pair || '.sp' AS spike_in,
 round({SPIKE}, 9) AS spike, num_mp, num_sp, num_mn, num_sn, {FLOORS.replace('dep_in', 'num_mn')} FROM s""")
def spike_table(spark, sf_dir):
    return _rounded_floors(plans.spike_table(_aligned(spark, sf_dir)).withColumn("spike", F.round("spike", 9)))


@query(f"WITH {ALN}, {DEPTHS} SELECT pair, dep_in, {FLOORS} FROM d")
def depth_floor_grid(spark, sf_dir):
    return _rounded_floors(factors.with_floors(_figures(spark, sf_dir).select("pair", "dep_in"), "dep_in"))


@query(f"""WITH {ALN}, f AS (SELECT sample, count(*) FILTER (WHERE {COUNTED}) / 7.0 AS sf FROM aln GROUP BY sample), m AS (SELECT max(sf) AS top FROM f WHERE sample NOT LIKE 'in_%')
 SELECT sample, round(sf, 6) AS sf, CASE WHEN sample LIKE 'in_%' THEN 1.0 ELSE round(sf / top, 6) END AS scaled FROM f, m""")
def relativize(spark, sf_dir):
    table = factors.depths(_aligned(spark, sf_dir)).select("sample", (F.col("depth") / 7).alias("sf"))
    return factors.relative(table).withColumn("sf", F.round("sf", 6))


MAIN_ONLY = FRAGS.replace("WHERE flag & 4 = 0", "WHERE chrom NOT LIKE 'SP%' AND flag & 4 = 0")


@query(f"WITH {_track(30, 'norm', MAIN_ONLY)}, {BOTH}, {DEPTHS}, {MEASURED} SELECT {PLACE}, round(ip / greatest(control, 30.0 / 12157075) * ({ALPHA['6nd']}), 6) AS value FROM merged JOIN d USING (pair) JOIN m USING (pair)")
def siq_signal(spark, sf_dir):
    out = plans.siq_signal(_aligned(spark, sf_dir), views.contigs(spark), _measured(spark, sf_dir))
    return out.withColumn("value", F.round("value", 6))


@query(f"WITH {_track(30, 'norm', MAIN_ONLY)}, {BOTH}, {SPIKED} SELECT {PLACE}, round(ip / greatest(control, 30.0 / 12157075) * ({SPIKE}), 6) AS value FROM merged JOIN s USING (pair)")
def spike_signal(spark, sf_dir):
    return plans.spike_signal(_aligned(spark, sf_dir), views.contigs(spark)).withColumn("value", F.round("value", 6))


@query(f"WITH {_track(30, 'norm', MAIN_ONLY)}, {SPIKED} SELECT {TRACK}, round(signal * {SPIKE} * 1e6, 4) AS signal FROM track JOIN s ON sample = 'IP_' || pair")
def spike_signal_plain(spark, sf_dir):
    """RAT6 without an input track: each IP's normalised signal times its spike-in factor."""
    aligned = _aligned(spark, sf_dir).where(fragments.on_main() & F.col("sample").startswith("IP_"))
    track = signal.bin_signal(fragments.fragments(aligned, views.contigs(spark)), 30, "norm")
    chosen = plans.spike_table(_aligned(spark, sf_dir)).select(F.concat(F.lit("IP_"), "pair").alias("sample"), F.col("spike").alias("factor"))
    return signal.scaled(track, chosen).withColumn("signal", F.round(F.col("signal") * 1e6, 4))


# Samples and measurements.

SHEET = f"""parts AS (SELECT p_partkey AS k, {_list(views.STATES)}[p_partkey % 5 + 1] AS state, {_list(views.FACTORS)}[p_partkey % 6 + 1] AS factor, {_list(views.GENOTYPES)}[p_partkey % 3 + 1] AS genotype FROM part),
 sheet AS (SELECT k AS sample_id, '/data/' || concat_ws('_', ['IP', 'in'][k % 2 + 1], nullif(genotype, ''), CASE WHEN k % 4 < 2 THEN concat_ws('_', state, factor) ELSE concat_ws('_', factor, state) END, CASE WHEN k % 7 = 0 THEN 'DMSO' END, 'y' || (k % 9)) || '.sc.bam' AS path FROM parts),
 toks AS (SELECT *, string_split(regexp_replace(regexp_extract(path, '[^/]+$'), '\\.sc\\.bam$', ''), '_') AS t FROM sheet),
 mids AS (SELECT *, t[2:len(t) - 1] AS mid FROM toks),
 rests AS (SELECT *, CASE WHEN mid[1] = 'WT' OR lower(mid[1]) LIKE '%-ko' THEN mid[2:] ELSE mid END AS rest FROM mids),
 found AS (SELECT *, CASE WHEN len(rest) < len(mid) THEN mid[1] ELSE 'N/A' END AS genotype,
   list_filter(rest, lambda x: x IN ('G1', 'G2M', 'log', 'Q')) AS st, list_filter(rest, lambda x: regexp_full_match(x, 'H[1-4][A-Za-z0-9]*|[A-Za-z0-9]+-flag|Hmo1|Hho1')) AS fa FROM rests),
 parsed AS (SELECT sample_id, path, t[1] AS assay, genotype, coalesce(st[1], 'N/A') AS state,
   coalesce(CASE WHEN len(st) > 0 AND len(fa) > 0 THEN list_filter(rest, lambda x: x <> st[1] AND x <> fa[1])[1] ELSE rest[3] END, 'N/A') AS treatment,
   fa[1] AS factor, t[len(t)] AS strain, CASE WHEN len(fa) = 0 THEN 'no factor' END AS error FROM found)"""


@query(f"WITH {SHEET} SELECT * FROM parsed")
def sample_name_parse(spark, sf_dir):
    return matching.parsed(views.sample_sheet(spark, sf_dir))


MEASURES = f"""rows AS (SELECT k AS row_no, CASE WHEN k % 3 = 0 THEN lower(state) ELSE factor END AS factor, CASE WHEN k % 3 = 0 THEN factor ELSE state END AS state, ['WT', 'hho1-KO', 'other'][k % 3 + 1] AS genotype, CASE WHEN k % 11 < 8 THEN ' y' ELSE ' z' END || (k % 9) AS strain FROM parts),
 met AS (SELECT sample_id, row_no, CASE WHEN lower(p.factor) = lower(r.factor) AND (p.state = 'N/A' OR lower(p.state) = lower(r.state)) THEN 1 ELSE 2 END AS match_pass
  FROM parsed p JOIN rows r ON trim(r.strain) = p.strain AND (p.genotype = 'N/A' OR lower(p.genotype) = lower(r.genotype))
   AND ((lower(p.factor) = lower(r.factor) AND (p.state = 'N/A' OR lower(p.state) = lower(r.state))) OR (lower(p.state) = lower(r.factor) AND (p.state = 'N/A' OR lower(p.factor) = lower(r.state)))) WHERE error IS NULL),
 best AS (SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY match_pass, row_no) = 1)"""


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.parsed(views.sample_sheet(spark, sf_dir)).where("error IS NULL")


@query(f"WITH {SHEET}, {MEASURES} SELECT sample_id, match_pass, row_no, p_retailprice AS mass_in, p_size + 1.0 AS mass_ip FROM best JOIN part ON p_partkey = row_no")
def metadata_match(spark, sf_dir):
    out = matching.match_measurements(_sheet(spark, sf_dir), views.measurements(spark, sf_dir), "sample_id")
    return out.select("sample_id", "match_pass", "row_no", "mass_in", "mass_ip")


@query(f"WITH {SHEET}, {MEASURES} SELECT sample_id, path FROM parsed WHERE error IS NULL AND sample_id NOT IN (SELECT sample_id FROM best)")
def metadata_unmatched(spark, sf_dir):
    return matching.unmatched(_sheet(spark, sf_dir), views.measurements(spark, sf_dir), "sample_id").select("sample_id", "path")


@query("""WITH w AS (SELECT p_type AS measure, sum(CASE WHEN p_size < 20 THEN p_size END) AS small, sum(CASE WHEN p_size BETWEEN 20 AND 35 THEN p_size END) AS medium, sum(CASE WHEN p_size > 35 THEN p_size END) AS large FROM part GROUP BY 1)
 SELECT sample, measure, CAST(value AS BIGINT) AS value FROM (SELECT measure, unnest(['small', 'medium', 'large']) AS sample, unnest([small, medium, large]) AS value FROM w)""")
def measurements_unpivot(spark, sf_dir):
    band = lambda a, b: F.sum(F.when(F.col("p_size").between(a, b), F.col("p_size")))
    wide = views.table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("measure")).agg(band(0, 19).alias("small"), band(20, 35).alias("medium"), band(36, 10**6).alias("large"))
    return matching.unpivot_measures(wide, "measure")


@query(f"""WITH {ALN}, {DEPTHS}, {MEASURED}, f AS (SELECT 'IP_' || pair AS sample, {ALPHA['6nd']} AS alpha FROM d JOIN m USING (pair) WHERE pair <> 'N')
 SELECT sample, count(*) AS n, round(any_value(alpha), 9) AS alpha FROM aln LEFT JOIN f USING (sample) GROUP BY sample""")
def factor_lookup(spark, sf_dir):
    table = plans.alpha_table(_aligned(spark, sf_dir), _measured(spark, sf_dir)).where("pair <> 'N'").withColumnRenamed("fil_ip", "sample")
    counts = _aligned(spark, sf_dir).groupBy("sample").agg(F.count("*").alias("n"))
    return matching.lookup(counts, table, "alpha").withColumn("alpha", F.round("alpha", 9))


@query("""WITH m AS (SELECT page_id, page_id + 2 AS line_no, CASE WHEN page_id % 5 = 0 THEN 'SRR_undefined_' || (page_id + 2) ELSE 'SRR' || page_id END AS run_accession, url,
  CASE WHEN page_id % 13 = 0 THEN 3 WHEN page_id % 2 = 0 THEN 2 ELSE 1 END AS n FROM pages)
 SELECT line_no, run_accession, CASE n WHEN 2 THEN url || '_1' ELSE url END AS url_1, CASE n WHEN 3 THEN url WHEN 2 THEN url || '_2' ELSE 'NA' END AS url_2, CASE WHEN n > 2 THEN 'too many URLs' END AS problem FROM m""")
def manifest_parse(spark, sf_dir):
    return matching.parse_manifest(views.manifest(spark, sf_dir)).drop("urls")


@query("""WITH p AS (SELECT p_partkey AS k, 's' || p_partkey AS s, CASE WHEN p_partkey % 3 = 0 THEN '.fq' ELSE '.fastq.gz' END AS e FROM part)
 SELECT CASE WHEN k % 4 = 0 THEN s || e ELSE s END AS stem, CASE k % 4 WHEN 0 THEN s || e WHEN 1 THEN s || '_R1.atria' || e ELSE s || '_R1' || e END AS r1,
  CASE WHEN k % 4 > 1 THEN s || '_R2' || e END AS r2, CASE WHEN k % 4 = 1 THEN 'missing R2' END AS problem FROM p""")
def fastq_pairs(spark, sf_dir):
    return matching.pair_files(views.read_files(spark, sf_dir))


@query(f"WITH {SHEET} SELECT sample_id, path FROM sheet WHERE path LIKE '/data/IP%' AND path NOT LIKE '%Hmo1%'")
def sample_filter(spark, sf_dir):
    return matching.select_samples(views.sample_sheet(spark, sf_dir), ("/data/IP*",), ("*Hmo1*",), "path")


# Genome text.

ORGANISM = """s AS (SELECT s_suppkey AS k, s_suppkey % 2 = 0 AS main, upper(translate(s_name, '0123456789#', 'ACGTACGTACN')) AS seq FROM supplier)"""
HEADERS = f"""{ORGANISM}, named AS (SELECT k * 2 AS line_no, CASE WHEN main THEN 'main' ELSE 'spike' END AS organism,
 CASE WHEN main AND k % 4 = 1 THEN '>Mito' WHEN main THEN '>' || {_list(views.MAIN)}[k % 16 + 1] ELSE '>' || ['SP_II_TG', 'SP_I', 'SP_II', 'SP_III', 'SP_MTR', 'SP_Mito'][k % 6 + 1] END AS line FROM s)"""


@query(f"WITH {HEADERS} SELECT * FROM named UNION ALL SELECT k * 2 + 1, CASE WHEN main THEN 'main' ELSE 'spike' END, seq FROM s")
def fasta_headers(spark, sf_dir):
    line = F.when(F.col("organism") == "main", genome.main_fasta(F.col("line"))).otherwise(genome.spike_fasta(F.col("line")))
    return views.fasta(spark, sf_dir).withColumn("line", line)


FEATURES = f"""f AS (SELECT p_partkey AS k, ['gene', 'ARS', 'CDS', 'tRNA_gene', 'pseudogene', 'mRNA'][p_partkey % 6 + 1] AS type, p_size, p_name FROM part),
 clean AS (SELECT k AS feature_id, {_list((*views.MAIN, 'Mito'))}[k % 17 + 1] AS seqid, 'src' AS source, type, k % 1000 + 1 AS start, k % 1000 + p_size AS "end", '.' AS score, ['+', '-', '.'][k % 3 + 1] AS strand, '.' AS phase,
  CASE WHEN k % 2 = 0 THEN p_name END AS gene, CASE WHEN k % 3 = 1 THEN 'A(' || k || ')' END AS alias FROM f)"""
TAIL = "coalesce(';gene=' || gene, '') || coalesce(';Alias=' || alias, '') || ';Note=5 prime, 3beta , 10 percent'"
FEATURE = 'feature_id, seqid, source, type, start, "end", score, strand, phase'


@query(f"WITH {FEATURES} SELECT {FEATURE}, 'ID=' || feature_id || ';Name=N' || feature_id || {TAIL} AS attributes FROM clean")
def gff_clean(spark, sf_dir):
    return genome.clean_features(views.features(spark, sf_dir))


@query(f"""WITH {FEATURES} SELECT {FEATURE}, 'ID=' || feature_id || ';Name=' || CASE WHEN type IN ('gene', 'tRNA_gene', 'pseudogene') AND gene IS NOT NULL THEN gene
 WHEN type = 'ARS' AND alias IS NOT NULL THEN alias ELSE 'N' || feature_id END || {TAIL} AS attributes FROM clean""")
def gff_names(spark, sf_dir):
    return genome.readable_names(genome.clean_features(views.features(spark, sf_dir)))


@query("""WITH l AS (SELECT p_partkey % 10 AS file, p_partkey AS line_no, CASE WHEN p_partkey % 97 = 50 AND p_partkey % 10 < 7 THEN '### end' ELSE 'chrI' || chr(9) || p_name END AS line FROM part)
 SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM l m WHERE m.file = l.file AND m.line_no <= l.line_no AND m.line LIKE '###%')""")
def gff_before_marker(spark, sf_dir):
    return genome.before_marker(views.feature_lines(spark, sf_dir))


@query(f"WITH {HEADERS}, f AS (SELECT p_partkey AS k FROM part) SELECT 'fasta' AS kind, line AS name FROM named UNION ALL SELECT 'gff3', 'SP_' || ['II_TG', 'I', 'II', 'III', 'MTR', 'Mito'][k % 6 + 1] FROM f")
def genome_concat(spark, sf_dir):
    headers = fasta_headers(spark, sf_dir).where(F.col("line").startswith(">")).select(F.lit("fasta").alias("kind"), F.col("line").alias("name"))
    names = F.element_at(F.array(*[F.lit(old) for old, _ in genome.SPIKE_FASTA]), (F.col("p_partkey") % 6 + 1).cast("int"))
    spike = views.table(spark, sf_dir, "part").select(F.lit("gff3").alias("kind"), genome.spike_contig(names).alias("name"))
    return genome.concatenated(headers, spike)


@query(f"""WITH {_track(30, 'unadj')} SELECT sample, chrom, bin_start, CAST(list_position({_list(views.MAIN)}, chrom) AS INTEGER) AS roman,
 row_number() OVER (PARTITION BY sample ORDER BY coalesce(list_position({_list(views.MAIN)}, chrom), 99), chrom, bin_start) AS place FROM track""")
def genome_sort(spark, sf_dir):
    track = genome.numbered(_track_of(spark, sf_dir, 30, "unadj"))
    return track.select("sample", "chrom", "bin_start", roman_number(F.col("chrom")).alias("roman"), "place")


@query("SELECT s_name, s_nationkey FROM supplier")
def table_sort(spark, sf_dir):
    blank = views.table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    return genome.table_order(blank.unionByName(blank.select(F.lit(" ").alias("s_name"), F.lit(None).cast("int").alias("s_nationkey"))))


@query(f"WITH {_track(30, 'frag')} SELECT sample, chrom, bin_start, bin_end, CAST(round(signal * 1e4) AS BIGINT) AS value FROM track")
def bedgraph_rows(spark, sf_dir):
    rows = genome.in_genome_order(_track_of(spark, sf_dir, 30, "frag"), "sample")
    return rows.select("sample", "chrom", "bin_start", "bin_end", F.round(fixed(F.col("signal"), 18).cast("double") * 1e4).cast("long").alias("value"))


# Files: what a writer has written, read back.


def _written(spark: SparkSession, name: str) -> str:
    return f"{folders.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"WITH {ALN} SELECT sample, qname, flag, chrom, pos, CAST(pos + 50 AS BIGINT) AS ref_end, chrom AS mate_chrom, tlen, aln_len, mapq FROM aln")
def sam_scan(spark, sf_dir):
    writers.write_sam(_aligned(spark, sf_dir), views.contigs(spark), path := _written(spark, "sam"))
    return readers.read_sam(spark, path)


@query(f"WITH {ALN} SELECT chrom, CAST(max(pos) + 50 AS BIGINT) AS chrom_len FROM aln GROUP BY chrom")
def contig_scan(spark, sf_dir):
    """Contigs as long as the alignments reach, through a SAM header."""
    sizes = _aligned(spark, sf_dir).groupBy("chrom").agg(F.max("ref_end").alias("chrom_len"))
    writers.write_sam(_aligned(spark, sf_dir), sizes, path := _written(spark, "sam"))
    return readers.read_contigs(spark, path)


@query(f"WITH {FRAGS} SELECT sample, chrom, frg_start, frg_end, frg_len FROM frags")
def bed_scan(spark, sf_dir):
    writers.write_fragments(_fragments(spark, sf_dir), path := _written(spark, "bed"))
    return readers.read_bed(spark, path)


@query(f"WITH {_track(30, 'unadj')} SELECT sample, chrom || chr(9) || bin_start || chr(9) || bin_end || chr(9) || printf('%.24f', signal / 8) AS line FROM track")
def bedgraph_text(spark, sf_dir):
    track = _track_of(spark, sf_dir, 30, "unadj").withColumn("signal", F.col("signal") / 8)
    writers.write_bedgraph(track, path := _written(spark, "bedgraph"))
    return spark.read.text(path).select("sample", F.col("value").alias("line"))


@query(f"WITH {_track(50, 'unadj')} SELECT {TRACK}, signal FROM track")
def bedgraph_scan(spark, sf_dir):
    writers.write_bedgraph(_track_of(spark, sf_dir, 50, "unadj"), path := _written(spark, "bedgraph"))
    return readers.read_bedgraph(spark, path)


@query(f"""WITH {_track(50, 'unadj')}, {BOTH}, q AS (SELECT *, CASE WHEN control <> 0 THEN ip / control END AS r FROM merged),
 v AS (SELECT *, CASE WHEN r IS NULL THEN 'nan' WHEN r = 0 THEN '-inf' ELSE 'number' END AS kind, CASE WHEN r > 0 THEN round(log2(r), 6) END AS value FROM q)
 SELECT 'all' AS file, pair, chrom, bin_start, bin_end, kind, value FROM v UNION ALL SELECT 'companion', pair, chrom, bin_start, bin_end, kind, value FROM v WHERE r > 0""")
def ratio_companion(spark, sf_dir):
    path = _written(spark, "ratio")
    writers.write_ratio(_ratio_of(spark, sf_dir, 50, "unadj", log2=True), path)
    value = F.col("value")
    kind = F.when(F.isnan(value), "nan").when(value == ratio.NEG_INF, "-inf").otherwise("number")
    number = F.when(ratio.is_finite(value), F.round(value, 6))
    read = lambda name: readers.read_bedgraph(spark, f"{path}/file={name}", "value", "pair").select(F.lit(name).alias("file"), "pair", "chrom", "bin_start", "bin_end", kind.alias("kind"), number.alias("value"))
    return read("all").unionByName(read("companion"))


ALPHA_TEXT = f"""SELECT 'IP_' || pair AS fil_ip, 'in_' || pair AS fil_in, round({ALPHA['6nd']}, 9) AS alpha, '6nd' AS eqn,
 round(mass_ip, 6) AS mass_ip, round(mass_in, 6) AS mass_in, vol_all::DOUBLE AS vol_all, vol_in::DOUBLE AS vol_in, dep_ip, dep_in, round(len_ip, 6) AS len_ip, round(len_in, 6) AS len_in, {FLOORS} FROM d JOIN m USING (pair)"""


def _read_table(spark: SparkSession, path: str, columns: list[str], digits: dict[str, int]) -> DataFrame:
    """A sample table's text with its numbers as numbers, in the header's order."""
    text = spark.read.option("header", True).csv(path, sep="\t")
    assert text.columns == columns
    whole = lambda c: c.startswith(("dep_", "num_"))
    names = {"fil_ip", "fil_in", "eqn", "main_ip", "spike_ip", "main_in", "spike_in"}
    numbers = {c: F.col(c).cast("long") if whole(c) else F.round(F.col(c).cast("double"), digits[c]) if c in digits else F.col(c).cast("double") for c in columns if c not in names}
    return _rounded_floors(text.withColumns(numbers))


@query(f"WITH {ALN}, {DEPTHS}, {MEASURED} {ALPHA_TEXT}")
def sample_table_text(spark, sf_dir):
    """All 26 columns of the alpha table, written and read back."""
    writers.write_sample_table(plans.alpha_table(_aligned(spark, sf_dir), _measured(spark, sf_dir)), path := _written(spark, "table"), "alpha")
    return _read_table(spark, path, factors.ALPHA_COLUMNS, {"alpha": 9} | dict.fromkeys(("mass_ip", "mass_in", "len_ip", "len_in"), 6))


@query(f"""WITH {ALN}, {SPIKED} SELECT 'IP_' || pair || '.sc' AS main_ip, 'IP_' || pair || '.sp' AS spike_ip, 'in_' || pair || '.sc' AS main_in, 'in_' || pair || '.sp' AS spike_in,
 round({SPIKE}, 9) AS spike, num_mp, num_sp, num_mn, num_sn, {FLOORS.replace('dep_in', 'num_mn')} FROM s""")
def spike_table_text(spark, sf_dir):
    """All 23 columns of the spike-in table, written and read back."""
    writers.write_sample_table(plans.spike_table(_aligned(spark, sf_dir)), path := _written(spark, "table"), "spike")
    return _read_table(spark, path, factors.SPIKE_COLUMNS, {"spike": 9})


MEASURES_READ = ", ".join(f"CAST(p_size + {i} AS VARCHAR) AS {name}" for i, name in enumerate(readers.ALIASES))


@query(f"SELECT CAST(p_partkey AS VARCHAR) AS factor, p_brand AS strain, {MEASURES_READ}, row_number() OVER (ORDER BY p_partkey) - 1 AS row_no FROM part")
def measurements_scan(spark, sf_dir):
    """All ten measures, each under another of its names, with the rows' numbers in the file."""
    named = [(F.col("p_size") + i).alias(names[-1 - i % len(names)]) for i, names in enumerate(readers.ALIASES.values())]
    table = views.table(spark, sf_dir, "part").orderBy("p_partkey").select(F.col("p_partkey").alias("factor"), F.col("p_brand").alias("strain"), *named)
    table.write.option("header", True).csv(path := f"{_written(spark, 'measurements')}.csv")  # the files' names are in the order of their rows
    return readers.read_measurements(spark, path)


# Tracks that are kept.


@query(f"WITH {_track(50, 'unadj')}, {BOTH} SELECT {PLACE}, ip, control FROM merged")
def track_merge_stored(spark, sf_dir):
    """Two tracks saved as bucketed tables, merged where they lie."""
    ip, control = ratio.pair_tracks(_track_of(spark, sf_dir, 50, "unadj"))
    path, tag = _written(spark, "bucketed"), f"spantrack_{uuid.uuid4().hex}"
    for name, side in (("ip", ip), ("control", control)):
        tracks.save_bucketed(side, f"{tag}_{name}", f"{path}/{name}")
    return ratio.merge(spark.table(f"{tag}_ip"), spark.table(f"{tag}_control"))


@query(f"WITH {_track(10, 'unadj')}, {REGIONS} SELECT region, sample, max(signal) AS max_signal FROM track JOIN regions r ON track.chrom = r.chrom AND error IS NULL AND bin_start < stop AND bin_end >= start GROUP BY region, sample")
def region_max_stored(spark, sf_dir):
    """Regions of a track that was saved by contig: other contigs' folders aren't read."""
    tracks.save_by_contig(_track_of(spark, sf_dir, 10, "unadj"), path := _written(spark, "contigs"))
    parsed = signal.parse_regions(views.regions(spark), views.contigs(spark)).where("error IS NULL")
    return tracks.stored_region_max(spark, path, parsed)


RUNS = f"""{_track(1, 'unadj')}, e AS (SELECT sample, chrom, bin_start, signal,
  lag(bin_start) OVER o IS DISTINCT FROM bin_start - 1 OR lag(signal) OVER o IS DISTINCT FROM signal AS begins FROM track WINDOW o AS (PARTITION BY sample, chrom ORDER BY bin_start)),
 r AS (SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY sample, chrom ORDER BY bin_start) AS run FROM e)"""


@query(f'WITH {RUNS} SELECT sample, chrom, min(bin_start) AS start, max(bin_start) + 1 AS "end", CAST(min(signal) AS BIGINT) AS depth FROM r GROUP BY sample, chrom, run')
def coverage_runs(spark, sf_dir):
    return signal.coverage_runs(_fragments(spark, sf_dir))


@query(f"WITH {_track(1, 'unadj')} SELECT sample, chrom, count(*) AS bases, CAST(min(signal) AS BIGINT) AS min, CAST(max(signal) AS BIGINT) AS max, round(avg(signal), 6) AS avg, CAST(sum(signal) AS BIGINT) AS sum FROM track GROUP BY sample, chrom")
def coverage_stats(spark, sf_dir):
    """Statistics of coverage base by base, from runs: no base is a row."""
    return signal.run_statistics(signal.coverage_runs(_fragments(spark, sf_dir)), ("sample", "chrom")).withColumn("avg", F.round("avg", 6))


@query(f"WITH {_track(30, 'norm')} SELECT {TRACK}, round(signal * 1e6, 3) AS signal FROM track")
def signal_streamed(spark, sf_dir):
    """A normalised track over alignments that arrive in files, a few a batch, as sums of the batches' bins.

    A task that reads lineitems writes what it read, so that files get more with the
    table, not larger; few tasks cut theirs, so that there are two batches at least.
    """
    path = _written(spark, "stream")
    aligned, rows = _aligned(spark, sf_dir), views.table(spark, sf_dir, "lineitem").count()
    aligned.write.option("maxRecordsPerFile", rows // 4 + 1).parquet(f"{path}/in")
    stream = spark.readStream.schema(aligned.schema).option("maxFilesPerTrigger", 3).parquet(f"{path}/in")
    streamed.start(stream, views.contigs(spark), f"{path}/out", f"{path}/state", 30, until_done=True).awaitTermination()
    return streamed.track(spark, f"{path}/out", normalised=True).withColumn("signal", F.round(F.col("signal") * 1e6, 3))


ROMAN_PLACE = f"coalesce(list_position({_list(views.MAIN)}, chrom), 99), chrom, bin_start"


@query(f"WITH {_track(30, 'unadj')} SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY {ROMAN_PLACE}) AS line_no, chrom || chr(9) || bin_start || chr(9) || bin_end || chr(9) || printf('%.3f', signal) AS line FROM track")
def bedgraph_lines(spark, sf_dir):
    """A written track line by line, each with its number: the order of the text is compared, not its set of lines."""
    writers.write_bedgraph(_track_of(spark, sf_dir, 30, "unadj"), path := _written(spark, "bedgraph"), digits=3)
    return tracks.read_lines(spark, path)


@query(f"WITH {_track(30, 'unadj')} SELECT sample, count(*) AS lines, CAST(0 AS BIGINT) AS overlaps FROM track GROUP BY sample")
def bedgraph_order(spark, sf_dir):
    """Lines of each sample's files, and how many of these begin before the one ahead of them ends."""
    writers.write_bedgraph(_track_of(spark, sf_dir, 30, "unadj"), path := _written(spark, "bedgraph"), digits=3)
    along = Window.partitionBy("sample").orderBy("file")  # a row per file
    ranges = tracks.file_ranges(spark, path).withColumn("late", F.coalesce(F.col("first") <= F.lag("last").over(along), F.lit(False)))
    return ranges.groupBy("sample").agg(F.sum("lines").alias("lines"), F.count_if("late").alias("overlaps"))


@query("""SELECT page_id % 7 AS file, row_number() OVER (PARTITION BY page_id % 7 ORDER BY page_id) + 1 AS line_no, 'SRR' || page_id AS run_accession, url AS urls, 'n' || page_id AS custom_name FROM pages""")
def manifest_scan(spark, sf_dir):
    """Seven manifests, columns in another order than they are read."""
    p = F.col("page_id")
    line = F.concat_ws("\t", F.concat(F.lit("n"), p.cast("string")), "url", F.concat(F.lit("SRR"), p.cast("string")))
    files = views.table(spark, sf_dir, "pages").groupBy((p % 7).alias("file")).agg(F.array_sort(F.collect_list(F.struct(p, line.alias("line")))).alias("rows"))
    text = F.concat(F.lit("custom_name\tfastq_ftp\trun_accession\r\n"), F.array_join(F.transform("rows", lambda x: x["line"]), "\r\n"))
    files.select("file", text.alias("value")).write.partitionBy("file").text(path := _written(spark, "manifests"))
    return readers.read_manifest(spark, path, keep=("file",)).withColumn("file", F.col("file").cast("long"))


@query(f"WITH {ALN} SELECT sample, qname, flag, CAST(row_number() OVER (PARTITION BY sample ORDER BY qname, flag) AS BIGINT) AS place FROM aln")
def queryname_sort(spark, sf_dir):
    return fragments.numbered_by_name(_aligned(spark, sf_dir)).select("sample", "qname", "flag", "place")


@query(f"""WITH {ALN}, r AS (SELECT *, coalesce(list_position({_list(views.MAIN)}, chrom), 99) AS roman FROM aln)
 SELECT sample, chrom, pos, CAST(rank() OVER (PARTITION BY sample ORDER BY roman, chrom, pos) AS BIGINT) AS place FROM r""")
def coordinate_sort(spark, sf_dir):
    places = _aligned(spark, sf_dir).select("sample", "chrom", F.col("pos").alias("bin_start"))
    return genome.numbered(places, ties=True).select("sample", "chrom", F.col("bin_start").alias("pos"), "place")


# Checks.


@query(f"WITH {ALN}, d AS (SELECT grp AS pair, CASE WHEN assay = 'in' AND grp = 'N' THEN 20 ELSE 10 END AS w FROM aln) SELECT pair, CAST(min(w) AS BIGINT) AS min_width, CAST(max(w) AS BIGINT) AS max_width FROM d GROUP BY pair HAVING min(w) <> max(w)")
def dq_bin_width(spark, sf_dir):
    ip, control = ratio.pair_tracks(_track_of(spark, sf_dir, 10, "unadj"))
    wide = control.withColumn("bin_end", F.col("bin_end") + F.when(F.col("pair") == "N", 10).otherwise(0))
    return ratio.width_mismatch(ip, wide)


@query(f"WITH {ALN}, n AS (SELECT DISTINCT CASE WHEN mapq = 3 THEN sample || 'x' WHEN assay = 'in' AND grp = 'R' THEN 'in_Q' ELSE sample END AS sample FROM aln) SELECT sample, CASE WHEN sample LIKE 'IP%' THEN 'in' ELSE 'IP' END AS missing FROM n WHERE NOT EXISTS (SELECT 1 FROM n m WHERE substr(m.sample, 4) = substr(n.sample, 4) AND m.sample <> n.sample)")
def dq_pairs(spark, sf_dir):
    aligned = _aligned(spark, sf_dir)
    name = F.when(F.col("mapq") == 3, F.concat("sample", F.lit("x"))).when(F.col("sample") == "in_R", "in_Q").otherwise(F.col("sample"))
    return ratio.unpaired(aligned.select(name.alias("sample")))


@query("""WITH t AS (SELECT s_suppkey AS sample, CASE WHEN s_suppkey % 5 = 0 THEN '0' WHEN s_suppkey % 7 = 0 THEN '-' || s_suppkey ELSE CAST(s_suppkey AS VARCHAR) END AS dep, CASE WHEN s_suppkey % 3 = 0 THEN 'x' WHEN s_suppkey % 4 = 0 THEN '.5' ELSE s_nationkey || '.0' END AS mass, s_nationkey AS n FROM supplier)
 SELECT sample, 'dep' AS field, dep AS value, 'not a positive integer' AS problem FROM t WHERE NOT regexp_full_match(dep, '[0-9]*[1-9][0-9]*')
 UNION ALL SELECT sample, 'mass', mass, 'not a positive number' FROM t WHERE mass = 'x' OR (mass <> '.5' AND n = 0)""")
def dq_numbers(spark, sf_dir):
    k = F.col("s_suppkey")
    dep = F.when(k % 5 == 0, "0").when(k % 7 == 0, F.concat(F.lit("-"), k.cast("string"))).otherwise(k.cast("string"))
    mass = F.when(k % 3 == 0, "x").when(k % 4 == 0, ".5").otherwise(F.concat(F.col("s_nationkey").cast("string"), F.lit(".0")))
    table = views.table(spark, sf_dir, "supplier").select(k.alias("sample"), dep.alias("dep"), mass.alias("mass"))
    return factors.number_problems(table, "sample", ("dep",), ("mass",))


@query("""SELECT p_partkey AS sample, unnest(list_filter([CASE WHEN p_partkey % 4 = 0 THEN 'mass_ip must be above 0' END, CASE WHEN p_size % 7 = 0 THEN 'dep_in must be above 0' END, CASE WHEN p_size >= 30 THEN 'vol_all must be above vol_in' END], lambda x: x IS NOT NULL)) AS problem FROM part""")
def dq_alpha_inputs(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    ones = [F.lit(1.0).alias(c) for c in ("mass_in", "dep_ip", "len_ip", "len_in")]
    table = views.table(spark, sf_dir, "part").select(k.alias("sample"), F.when(k % 4 == 0, 0.0).otherwise(2.0).alias("mass_ip"), F.lit(30).alias("vol_all"), size.alias("vol_in"), (size % 7).alias("dep_in"), *ones)
    return factors.alpha_errors(table, "6")


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
