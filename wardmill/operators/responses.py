"""Nested results: one JSON response per note and configuration, and the envelope keyed by configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill import resources as R


def mention_name(semantic: Column) -> Column:
    out = F.lit("EntityMention")
    for k, v in R.MENTION.items():
        out = F.when(semantic == k, v).otherwise(out)
    return out


def umls_concept() -> Column:
    """A row of ``lookup.merged_concepts`` as the response has it: codes under their coding schemes."""
    by_sab = F.transform(F.array_distinct(F.transform("codes", lambda c: c["sab"])), lambda s: F.struct(s.alias("codingScheme"), F.transform(F.filter("codes", lambda c: c["sab"] == s), lambda c: F.struct(c["ttys"].alias("tty"), c["code"].alias("code"))).alias("vocabConcepts")))
    return F.struct(F.coalesce("tuis", F.array().cast("array<string>")).alias("tui"), "cui", F.coalesce("pref", F.lit("")).alias("preferredText"), by_sab.alias("sabConcepts"))


def _quoted(text: Column) -> Column:
    """A string as a JSON string."""
    return F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)


def class_tail(semantic: Column, concepts: Column) -> Column:
    """What the items of a class and group have in common, as JSON: their last members."""
    return F.concat(F.lit(',"aspect":'), _quoted(semantic), F.lit(',"name":'), _quoted(mention_name(semantic)), F.lit(',"umlsConcepts":'), F.coalesce(F.to_json(concepts), F.lit("[]")))


def clinical(annotated: DataFrame, tails: DataFrame, key: str) -> DataFrame:
    """key, config, response (JSON), error: the content in the order of ids.

    ``annotated``: key, config, n_chars, error, items (id, sent_begin, sent_end, semantic, term, begin, end,
    text, attributes as JSON), one row per note and configuration; a note without annotations has empty
    content, one with an error no response. ``tails``: config, term, semantic, tail (``class_tail``).
    """
    parts = int(annotated.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = annotated.repartition(parts, key, "config").select(key, "config", "n_chars", "error", F.explode_outer("items").alias("i")).select(key, "config", "n_chars", "error", "i.*")
    a = each.join(tails, ["config", "term", "semantic"], "left")
    two = lambda x, y: F.concat(F.lit("["), x.cast("string"), F.lit(","), y.cast("string"), F.lit("]"))
    members = [
        ("id", F.col("id").cast("string")),
        ("sentence", two(F.col("sent_begin"), F.col("sent_end"))),
        ("sectionOffset", two(F.lit(0), F.col("n_chars"))),
        ("text", F.concat(F.lit("["), _quoted(F.lower("text")), F.lit(","), F.col("begin").cast("string"), F.lit(","), F.col("end").cast("string"), F.lit("]"))),
        ("sectionOid", F.lit('"SIMPLE_SEGMENT"')),
        ("attributes", F.col("attributes")),
    ]
    tail = F.coalesce("tail", class_tail(F.col("semantic"), F.lit(None).cast("array<string>")))
    item = F.concat(F.lit("{"), *[x for i, (k, v) in enumerate(members) for x in (F.lit(("," if i else "") + f'"{k}":'), v)], tail, F.lit("}"))
    listed = F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("id", item.alias("item")))))
    content = a.groupBy(key, "config", "error").agg(F.array_join(F.transform(listed, lambda x: x["item"]), ",").alias("content"))
    head = F.concat(F.lit('{"docId":'), _quoted(F.col(key).cast("string")), F.lit(',"dob":"","gender":"","age":"","content":['), F.col("content"), F.lit("]}"))
    return content.select(key, "config", F.when(F.col("error").isNull(), head).alias("response"), "error")


def smoking(sentences: DataFrame, status: DataFrame, key: str) -> DataFrame:
    """key, response (JSON): the document's status and its sentences in order of their spans.

    ``sentences``: key, begin, end, text, status. The keys of a sentence are capitalised.
    """
    item = F.concat(F.lit('{"Status":'), _quoted(F.col("status")), F.lit(',"Text":['), _quoted(F.lower("text")), F.lit(","), F.col("begin").cast("string"), F.lit(","), F.col("end").cast("string"), F.lit("]}"))
    listed = sentences.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("begin", "end", item.alias("s")))), lambda x: x["s"]), ",").alias("sentences"))
    head = F.concat(F.lit('{"docId":'), _quoted(F.col(key).cast("string")), F.lit(',"dob":"","gender":"","age":"","smokingStatus":'), _quoted(F.col("smoking_status")), F.lit(',"sentences":['), F.coalesce("sentences", F.lit("")), F.lit("]}"))
    return status.join(listed, key, "left").select(key, head.alias("response"))


def envelope(responses: DataFrame, key: str) -> DataFrame:
    """key, envelope: the responses of all configurations of a document as one JSON object, in order of their names; a null response is left out."""
    entries = F.sort_array(F.collect_list(F.when(F.col("response").isNotNull(), F.struct("config", "response"))))
    joined = F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: F.concat(_quoted(e["config"]), F.lit(":"), e["response"])), ","), F.lit("}"))
    return responses.groupBy(key).agg(joined.alias("envelope"))
