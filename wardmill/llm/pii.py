"""Personal information in free text: found by a character-level BiLSTM-CRF, replaced by typed placeholders.

The model (``pii_model``) marks e-mail addresses, phone numbers, identity numbers, postal addresses,
names, stated birth dates and other full dates. Exact checks follow: edges lose white space and stray
punctuation, an address keeps the dot of a closing abbreviation, and a full date that isn't stated as a
birth date counts only if it equals a birth date known for the same request id.

Texts are read where they lie; repeated deliveries of a section are dropped behind the model, so that only
spans are shuffled for it (and, for the redacted texts, each text once). The known birth dates are reduced
to distinct (tid, date) pairs before the join, so a request id that holds a tenth of the rows meets each of
its dates once. Spans that need no match get a join key of their own each, so that they spread evenly.

Defined cases: null and empty texts have no spans and come out as they are; rows that share a section id
are one record, the first received one; offsets are code points; spans don't overlap; a null request id
knows no birth dates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.frames import first_per_key, spread
from wardmill.llm import pii_model
from wardmill.session import checkpoint

KINDS = ("email", "phone", "id", "address", "name", "dob")
_MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
_DATE = [
    (re.compile(r"(\d{4})-(\d{1,2})-(\d{1,2})\Z"), (1, 2, 3)),
    (re.compile(r"(\d{4})(\d{2})(\d{2})\Z"), (1, 2, 3)),
    (re.compile(r"(\d{4})/(\d{1,2})/(\d{1,2})\Z"), (1, 2, 3)),
    (re.compile(r"(\d{1,2})/(\d{1,2})/(\d{4})\Z"), (3, 1, 2)),
    (re.compile(r"(\d{1,2})\.\s*(\d{1,2})\.\s*(\d{4})\Z"), (3, 2, 1)),
    (re.compile(r"(\d{1,2})[-\s.]+([A-Za-z]{3,9})\.?[-\s,]+(\d{4})\Z"), (3, 2, 1)),
    (re.compile(r"([A-Za-z]{3,9})\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})\Z"), (3, 1, 2)),
]
_ABBREVIATED = re.compile(r"\b(?:St|Rd|Ave|Av|Blvd|Ln|Ct|Dr|Pl|Hwy|Sq|Str)\Z", re.I)


def day_of(text: str | None) -> str | None:
    """A full date as yyyy-mm-dd; slashed dates are month first, dotted ones day first."""
    s = (text or "").strip()[:32]
    s = re.split(r"[T ]\d{2}:", s)[0]
    for pattern, (y, m, d) in _DATE:
        if got := pattern.match(s):
            month = got[m]
            month = int(month) if month.isdigit() else _MONTHS.get(month[:3].lower(), 0)
            if 1 <= month <= 12 and 1 <= int(got[d]) <= 31:
                return f"{int(got[y]):04d}-{month:02d}-{int(got[d]):02d}"
    return None


def tidy(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The exact checks on edges."""
    out = []
    for a, b, kind in spans:
        if kind == "name" and "\n" in text[a:b]:  # people on two lines
            at = a
            for part in text[a:b].split("\n"):
                out += tidy(text, [(at, at + len(part), kind)])
                at += len(part) + 1
            continue
        while a < b and (text[a].isspace() or text[a] in ",;:"):
            a += 1
        while a < b and (text[b - 1].isspace() or text[b - 1] in ",;:"):
            b -= 1
        if kind == "address" and text[b : b + 1] == "." and _ABBREVIATED.search(text[a:b]):
            b += 1
        if kind == "name" and text[a:b].endswith(("'s", "’s")):
            b -= 2
        if a < b:
            out.append((a, b, kind))
    return out


_SPANS = "array<struct<begin:int,end:int,kind:string,day:string>>"


def detect(sections: DataFrame, with_text: bool = False) -> DataFrame:
    """section_id, tid[, text], spans (array of begin, end, kind, day): once per section id. ``day`` is the date of a dob or date span."""
    base = sections.select("section_id", "tid", "received_at", "text")
    received = base.schema["received_at"].dataType.simpleString()
    kind_of = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("day", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pii_model.load()
        for b in batches:
            texts = [t or "" for t in b.column(3).to_pylist()]
            found = [
                [{"begin": x, "end": y, "kind": k, "day": day_of(t[x:y]) if k in ("dob", "date") else None} for x, y, k in tidy(t, spans)] if spans else []
                for t, spans in zip(texts, pii_model.decode(model, texts))
            ]
            kept = b.columns if with_text else b.columns[:3]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, kind_of)], names=[*b.schema.names[: len(kept)], "spans"])

    read = spread(base).mapInArrow(run, f"section_id long, tid string, received_at {received}{', text string' * with_text}, spans {_SPANS}")
    return first_per_key(read, "section_id", [F.col("received_at")]).drop("received_at")


def known_days(responses: DataFrame) -> DataFrame:
    """Distinct (tid, day) of the birth dates known for a request."""
    raw = responses.select("tid", "dob").filter("tid IS NOT NULL AND dob <> ''").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([day_of(x) for x in b.column(1).to_pylist()], pa.string())], names=["tid", "day"])

    return raw.mapInArrow(run, "tid string, day string").filter("day IS NOT NULL").distinct()


def _settled(found: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """key, begin, end, kind: the spans of ``found`` (key, tid, spans) that count; a date that equals a known birth date is one."""
    each = found.select(key, "tid", F.explode("spans").alias("s")).select(key, "tid", "s.*")
    date = F.col("kind") == "date"
    # a date is looked up by request id and day, any other span by a key that no other span has
    lookup = F.when(date, F.concat(F.lit("="), F.col("tid"), F.lit("|"), F.col("day"))).otherwise(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("-")), F.col("begin").cast("string")))
    cases = each.select(key, "begin", "end", "kind", lookup.alias("__lookup")).filter("__lookup IS NOT NULL")
    known = known_days(responses).select(F.concat(F.lit("="), F.col("tid"), F.lit("|"), F.col("day")).alias("__lookup"), F.lit(True).alias("__known"))
    joined = cases.join(known, "__lookup", "left").filter("kind <> 'date' OR __known")
    return joined.select(key, "begin", "end", F.when(F.col("kind") == "date", "dob").otherwise(F.col("kind")).alias("kind"))


def spans(sections: DataFrame, responses: DataFrame) -> DataFrame:
    """section_id, span_begin, span_end, kind: the personal information of every section."""
    return _settled(detect(sections), responses, "section_id").select("section_id", F.col("begin").alias("span_begin"), F.col("end").alias("span_end"), "kind")


def redact(sections: DataFrame, responses: DataFrame) -> DataFrame:
    """section_id, text (with placeholders such as [NAME]), n_spans: every section once.

    Texts and spans come from one pass of the model and are checkpointed in the shared folder (a job of its
    own). Only sections that hold a date not stated as a birth date meet the known birth dates.
    """
    one = F.concat_ws(":", F.coalesce(F.col("section_id").cast("string"), F.lit("-")), F.xxhash64("text").cast("string"))
    found = checkpoint(detect(sections, with_text=True).withColumn("__row", one))
    asks = F.exists("spans", lambda s: s["kind"] == "date")
    dates = found.filter(asks)
    born = _settled(dates.select("__row", "tid", F.filter("spans", lambda s: s["kind"] == "date").alias("spans")), responses, "__row").groupBy("__row").agg(F.collect_set("begin").alias("born"))
    met = dates.join(born, "__row", "left").select("section_id", "text", F.filter("spans", lambda s: (s["kind"] != "date") | F.coalesce(F.array_contains("born", s["begin"]), F.lit(False))).alias("m"))
    both = found.filter(~asks).select("section_id", "text", F.col("spans").alias("m")).unionByName(met)
    # the texts between the marks, then a placeholder for each mark; Spark's substring counts code points
    before = lambda i: F.when(i == 0, 0).otherwise(F.get("m", i - 1)["end"])
    label = lambda x: F.upper(F.when(x["kind"] == "date", "dob").otherwise(x["kind"]))
    parts = F.transform("m", lambda x, i: F.concat(F.substring(F.col("text"), before(i) + 1, x["begin"] - before(i)), F.lit("["), label(x), F.lit("]")))
    tail = F.substring(F.col("text"), F.coalesce(F.get("m", F.size("m") - 1)["end"], F.lit(0)) + 1, F.lit(2**31 - 1))
    return both.select("section_id", F.when(F.size("m") == 0, F.col("text")).otherwise(F.concat(F.array_join(parts, ""), tail)).alias("text"), F.size("m").alias("n_spans"))


def found(sections: DataFrame, responses: DataFrame) -> DataFrame:
    return spans(sections, responses)
