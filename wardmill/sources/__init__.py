"""Readers: vocabularies, configurations, notes, task messages."""

from __future__ import annotations

import glob
import hashlib
import logging
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scheme_columns(lines: DataFrame, scheme: str, keep: Sequence[str] = (), line: str = "line") -> DataFrame:
    """Bar-separated lines as columns named by the scheme, lower-cased whole, without comments; ``keep`` are columns to keep beside.

    A column that the scheme lacks is absent; short lines have nulls at their end. No quoting: see
    ``operators.rejects`` for files that quote.
    """
    parts = F.split(F.lower(F.col(line)), r"\|")
    sound = lines.filter(F.col(line).isNotNull() & (F.col(line) != "") & ~F.col(line).startswith("#") & ~F.col(line).startswith("//"))
    return sound.select(*[F.get(parts, i).alias(n) for i, n in enumerate(x.strip().lower() for x in scheme.split("|"))], *keep)


def bsv_rows(lines: DataFrame, scheme: str, line: str = "line") -> DataFrame:
    """``scheme_columns`` with repeats of (cui, str) once."""
    rows = scheme_columns(lines, scheme, line=line)
    keys = [k for k in ("cui", "str") if k in rows.columns]
    return rows.dropDuplicates(keys) if keys else rows


def read_bsv(spark: SparkSession, path: str, scheme: str) -> DataFrame:
    return bsv_rows(spark.read.text(path), scheme, "value")


def _unterminated(spark: SparkSession, path: str) -> list[str]:
    """The files under a path whose last line has no line break: one byte of each is read."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for s in fs.globStatus(top) or []:
        for f in fs.listStatus(s.getPath()):
            if f.isFile() and f.getLen():
                h = fs.open(f.getPath())
                try:
                    h.seek(f.getLen() - 1)
                    if h.read() != 10:
                        out.append(f.getPath().getName())
                finally:
                    h.close()
    return out


def read_dictionary(spark: SparkSession, folder: str, name: str, drop_unterminated: bool = False) -> DataFrame:
    """dictionary (its name), line, line_no (a struct that keeps the order of a file) of a vocabulary file under ``folder``.

    ``drop_unterminated``: a last line without a line break doesn't count, as in concept dictionaries.
    """
    path = f"{folder}/{name}"
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    rows = spark.read.text(path).select(F.lit(name).alias("dictionary"), F.col("value").alias("line"), at.alias("line_no"), F.col("_metadata.file_name").alias("__file"))
    if drop_unterminated and (open_ := _unterminated(spark, path)):
        ends = rows.filter(F.col("__file").isin(open_)).groupBy("__file").agg(F.max("line_no").alias("__last"))
        rows = rows.join(F.broadcast(ends), "__file", "left").filter(F.col("__last").isNull() | (F.col("line_no") < F.col("__last"))).drop("__last")
    return rows.drop("__file")


def cached_index(spark: SparkSession, lines: DataFrame, scheme: str, folder: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``build(lines)`` as a Parquet table under ``folder``, written once per content of the lines and scheme.

    The name is made of the scheme and an order-free digest of the lines, so an unchanged vocabulary is read
    back and a changed one is built anew. ``folder`` must be shared by all executors.
    """
    digest = lines.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("line").cast("decimal(38,0)")), F.lit(0)).alias("s"), F.coalesce(F.bit_xor(F.xxhash64("line", F.lit(1))), F.lit(0)).alias("x")).first()
    path = f"{folder}/index-{hashlib.sha256(f'{scheme}|{digest.n}|{digest.s}|{digest.x}'.encode()).hexdigest()[:32]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        build(lines).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_notes(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files as (doc_id, text); the id is the file's base name."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1)
    return spark.read.text(path, wholetext=True).select(name.alias("doc_id"), F.col("value").alias("text"))


def result_key(document: Column, chunk: Column) -> Column:
    """The object key of a chunk's result."""
    return F.concat(F.lit("processed/documents/"), document.cast("string"), F.lit("/chunks/"), chunk.cast("string"), F.lit("/"), chunk.cast("string"), F.lit(".fdl_results.json"))


def write_results(results: DataFrame, path: str, batch: int | str = 0) -> None:
    """Rows as JSON lines in a folder of their own per batch; a batch that is written again replaces its own output only."""
    results.write.mode("overwrite").json(f"{path}/batch={batch}")


@dataclass(frozen=True)
class Configuration:
    """A vocabulary configuration."""

    name: str
    pipeline: str = "default_clinical"
    term_dictionary: str = ""
    term_scheme: str = ""
    concept_dictionary: str = ""
    concept_scheme: str = ""
    ignored: tuple[str, ...] = ()
    exclusion_tags: tuple[str, ...] = ()
    precision_mode: bool = False
    features: tuple[str, ...] = ()

    def wants(self, feature: str) -> bool:
        return feature in self.features


PIPELINES = ("default_clinical", "smoking_status")


def parse_configuration(name: str, text: str) -> Configuration | None:
    """A configuration from YAML; None (and a log line) if it can't be read or names no known pipeline."""
    import yaml

    try:
        raw = yaml.safe_load(text) or {}
        p = (raw.get("params") or {}).get("FDL") or {}
        c = Configuration(name, raw.get("pipeline", ""), p.get("term_dictionary", ""), p.get("term_scheme", ""), p.get("concept_dictionary", ""), p.get("concept_scheme", ""), tuple(p.get("concept_params_ignore") or ()), tuple(p.get("exclusion_tags") or ()), bool(p.get("precision_mode")), tuple(raw.get("features") or ()))
    except (yaml.YAMLError, AttributeError, TypeError) as e:
        logging.warning("configuration %s is skipped: %s", name, e)
        return None
    if c.pipeline not in PIPELINES:
        logging.warning("configuration %s is skipped: pipeline %r", name, c.pipeline)
        return None
    return c


def load_configurations(folder: str) -> list[Configuration]:
    """All ``*.yaml`` of a folder, not of its subfolders."""
    out = []
    for p in sorted(glob.glob(os.path.join(folder, "*.yaml"))):
        with open(p, encoding="utf-8") as f:
            c = parse_configuration(os.path.splitext(os.path.basename(p))[0], f.read())
        if c:
            out.append(c)
    return out


def tui_list(tui: Column) -> Column:
    """``t1`` or ``[t1,t2]`` as a list of upper-case ids."""
    return F.filter(F.transform(F.split(F.regexp_replace(tui, r"[\[\]\s]", ""), ","), F.upper), lambda x: x != "")
