"""Samples and their measurements, factors and partners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spantrack.functions.scalars import parse_sample_names


def parsed(samples: DataFrame, path: str = "path") -> DataFrame:
    """``samples`` with the parts of its name and an error column."""
    return parse_sample_names(samples, path)


def match_measurements(samples: DataFrame, measurements: DataFrame, key: str = "sample") -> DataFrame:
    """``samples`` (key, factor, strain, genotype, state) with the first matching row of ``measurements`` (row_no in file order).

    Names are compared trimmed and in lower case. A row matches by strain, by factor
    or its abbreviation, and by genotype and state unless the sample has N/A; a
    second pass swaps factor and state. Samples without a match are left out.

    A row of measurements stands under every full key that can ask for it, with and
    without genotype and state, and only the first row of a key goes on, so that
    matching is a join by equality and costs rows, not pairs.
    """
    norm = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    known = "factor_abbrev" in measurements.columns
    names = F.array_distinct(F.array(norm("factor"), *([F.when(norm("factor_abbrev") != "", norm("factor_abbrev"))] if known else [])))
    shapes = F.array(*[F.struct(F.when(F.lit(g), norm("genotype")).alias("g"), F.when(F.lit(s), norm("state")).alias("s")) for g in (True, False) for s in (True, False)])
    spread = measurements.select("row_no", norm("strain").alias("_strain"), F.explode(F.array_compact(names)).alias("_name"), shapes.alias("shapes")).select("row_no", "_strain", "_name", F.explode("shapes").alias("x"))
    full = [F.col("_strain"), F.col("_name"), F.col("x.g").isNull().alias("_any_g"), F.coalesce("x.g", F.lit("")).alias("_g"), F.col("x.s").isNull().alias("_any_s"), F.coalesce("x.s", F.lit("")).alias("_s")]
    firsts = spread.groupBy(*full).agg(F.min("row_no").alias("row_no"))
    any_g, any_s = norm("genotype") == "n/a", norm("state") == "n/a"
    own = {"_strain": norm("strain"), "_any_g": any_g, "_g": F.when(any_g, "").otherwise(norm("genotype")), "_any_s": any_s}
    ways = {f"_{what}_{i}": x for i, (a, b) in enumerate((("factor", "state"), ("state", "factor")), 1) for what, x in (("name", norm(a)), ("s", F.when(any_s, "").otherwise(norm(b))))}
    met = samples.withColumns(own | ways)
    for i in (1, 2):
        way = firsts.withColumnsRenamed({"_name": f"_name_{i}", "_s": f"_s_{i}", "row_no": f"_row_{i}"})
        met = met.join(way, ["_strain", "_any_g", "_g", "_any_s", f"_name_{i}", f"_s_{i}"], "left")
    match_pass = F.when(F.col("_row_1").isNotNull(), 1).when(F.col("_row_2").isNotNull(), 2)
    first = met.withColumns({"match_pass": match_pass, "row_no": F.coalesce("_row_1", "_row_2")}).where("row_no IS NOT NULL").select(*samples.columns, "match_pass", "row_no")
    taken = [c for c in measurements.columns if c not in samples.columns]
    return first.join(measurements.select(*taken), "row_no")


def unmatched(samples: DataFrame, measurements: DataFrame, key: str = "sample") -> DataFrame:
    return samples.join(match_measurements(samples, measurements, key), key, "left_anti")


def lookup(samples: DataFrame, table: DataFrame, field: str, key: str = "sample", override: float | None = None) -> DataFrame:
    """``samples`` with ``field`` of the sample table by name; null means not applied; ``override`` replaces all."""
    if override is not None:
        return samples.withColumn(field, F.lit(float(override)))
    return samples.join(table.select(key, field), key, "left")


def unpivot_measures(wide: DataFrame, measure: str = "sample") -> DataFrame:
    """(sample, measure, value) of a table with one column per sample."""
    names = [c for c in wide.columns if c != measure]
    return wide.select(F.col(measure).alias("measure"), *names).unpivot("measure", names, "sample", "value").select("sample", "measure", "value")


def pair_files(files: DataFrame, path: str = "path") -> DataFrame:
    """(stem, r1, r2, problem) of read files: mates by name, other files alone; problem for an R1 without R2."""
    pattern = r"^(.*)_R([12])(\.atria)?\.(?:fastq|fq)(?:\.gz)?$"
    mate = F.regexp_extract(path, pattern, 2)
    stem = F.when(mate != "", F.regexp_extract(path, pattern, 1)).otherwise(F.col(path))
    kinds = files.select(stem.alias("stem"), mate.alias("mate"), F.col(path).alias("p"))
    pick = lambda m: F.min(F.when(F.col("mate") == m, F.col("p")))
    grouped = kinds.groupBy("stem").agg(F.coalesce(pick("1"), pick("")).alias("r1"), pick("2").alias("r2"), F.bool_or(F.col("mate") == "1").alias("_one"))
    problem = F.when(F.col("_one") & F.col("r2").isNull(), "missing R2")
    return grouped.select("stem", F.coalesce("r1", "r2").alias("r1"), F.when(F.col("r1").isNotNull(), F.col("r2")).alias("r2"), problem.alias("problem"))


def parse_manifest(manifest: DataFrame, urls: str = "urls") -> DataFrame:
    """``manifest`` (line_no counting the header as 1, run_accession, urls) with missing runs named and one or two URLs.

    More than two URLs give the problem ``too many URLs``.
    """
    run = F.trim("run_accession")
    named = F.when(run.isNull() | run.isin("", "NA"), F.concat(F.lit("SRR_undefined_"), F.col("line_no").cast("string"))).otherwise(run)
    parts = F.split(urls, ";")
    return manifest.withColumns(
        {"run_accession": named, "url_1": F.get(parts, F.lit(0)), "url_2": F.coalesce(F.get(parts, F.lit(1)), F.lit("NA")), "problem": F.when(F.size(parts) > 2, "too many URLs")}
    )


def select_samples(samples: DataFrame, include: tuple[str, ...] = (), exclude: tuple[str, ...] = (), name: str = "sample") -> DataFrame:
    """Samples whose name fits one of the ``include`` patterns (any, if none) and none of ``exclude``; ``*`` is any text."""
    like = lambda p: F.col(name).rlike("^" + ".*".join(_literal(x) for x in p.split("*")) + "$")
    out = samples
    if include:
        keep = F.lit(False)
        for p in include:
            keep = keep | like(p)
        out = out.where(keep)
    for p in exclude:
        out = out.where(~like(p))
    return out


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() or c == "_" else f"\\{c}" for c in text)

