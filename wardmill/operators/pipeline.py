"""Notes to responses, as a configuration says: sentences, tokens, tags, lemmas, lookup, attributes, polarity.

One Arrow pass turns notes into sentences with their tokens, which are checkpointed in the shared folder
(as are the vocabulary's tokens and tables), since lookup and attributes read them; so some jobs run while
the frame is built. The lookup of all configurations is one join of the sentences with the term classes.
Its spans are dealt out once, by note, and stay so until they are a list beside the note's sentences; one
more Arrow pass over the notes adds what the configurations' features ask for, with tokens made again from
the sentence, which is less than to move them; the responses are put together by note and configuration.
Models that aren't public are resources with documented fallbacks.

Defined cases: a null or empty note has an empty response; a note that can't be read has a row with its
error and no response of its own, and doesn't harm the others; a configuration without vocabulary rows
finds nothing; a note without annotations has empty content; columns beside key and text are ignored.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardmill import resources as R
from wardmill.frames import shuffled, spread
from wardmill.functions import tokens as tk
from wardmill.functions.tokens import Token
from wardmill.operators import attributes, lookup, responses, smoking, tagging
from wardmill.session import checkpoint
from wardmill.sources import Configuration, bsv_rows, cached_index, read_dictionary, scheme_columns


@dataclass(frozen=True)
class Models:
    """Models and word tables; what is absent is replaced by the fallback of its operator."""

    sentences: dict | None = None
    tags: dict | None = None
    exceptions: dict[str, dict[str, str]] = field(default_factory=dict)
    rules: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    bases: dict[str, frozenset[str]] = field(default_factory=dict)
    abbreviations: dict[str, str] = field(default_factory=dict)
    labs: dict | None = field(default_factory=lambda: R.read_model(R.LAB_CRF))
    smoker: dict | None = None
    units: frozenset[str] = R.LAB_UNITS
    intended: bool = False


_TOKEN = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("lemma", pa.string()), ("tag", pa.string()), ("kind", pa.string()), ("shape", pa.string())])
#: Notes that an Arrow pass works on at once.
_AT_ONCE = 256
SENTENCE = "sent_no int, sent_begin int, sent_end int, sentence string, tokens array<struct<begin:int,end:int,text:string,lemma:string,tag:string,kind:string,shape:string>>, n_chars int, error string"


def read_note(text: str, models: Models) -> list[tuple[int, int, list[dict]]]:
    """(begin, end, tokens) of the sentences of a note; token offsets are those in the note."""
    out = []
    for a, b in tagging.split_model(text, models.sentences):
        tokens = tk.tokenize(text[a:b], a)
        words = [t.text for t in tokens if t.kind != "newline"]
        tags = iter(tagging.tag(words, models.tags))
        made = []
        for t in tokens:
            tag = None if t.kind == "newline" else next(tags)
            lemma = tagging.lemma(t.text, tag, models.exceptions, models.rules, models.bases, models.abbreviations) if tag and t.kind == "word" else None
            made.append({"begin": t.begin, "end": t.end, "text": t.text, "lemma": lemma, "tag": tag, "kind": t.kind, "shape": t.shape})
        out.append((a, b, made))
    return out


def _listed(rows: Sequence[list[dict] | None], struct: pa.StructType) -> pa.Array:
    """Lists of dicts as an Arrow array, column by column."""
    flat = [x for r in rows for x in r or ()]
    inner = pa.StructArray.from_arrays([pa.array([x[f.name] for x in flat], f.type) for f in struct], fields=list(struct))
    ends, at = [0], 0
    for r in rows:
        at += len(r or ())
        ends.append(at)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner, mask=pa.array([r is None for r in rows], pa.bool_()))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in pieces of ``_AT_ONCE`` rows: what Python holds at once is bounded by those."""
    for b in batches:
        for i in range(0, b.num_rows, _AT_ONCE):
            yield b.slice(i, _AT_ONCE)


def with_sentences(notes: DataFrame, key: str, text: str = "text", models: Models = Models()) -> DataFrame:
    """key and ``SENTENCE``: one row per sentence; for a note without any, or with an error, one row with a null sent_no."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            rows: list[tuple] = []
            for k, note in enumerate(b.column(1).to_pylist()):
                error, found = None, []
                try:
                    found = read_note(note or "", models)
                except Exception as e:  # noqa: BLE001 - one bad note mustn't end the batch
                    error = f"{type(e).__name__}: {e}"[:500]
                size = len(note or "")
                rows += [(k, i, x, y, note[x:y], t, size, None) for i, (x, y, t) in enumerate(found)] or [(k, None, None, None, None, None, size, error)]
            at, *columns = zip(*rows) if rows else ((),) * 8
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(_TOKEN), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), *[_listed(c, _TOKEN) if pa.types.is_list(t) else pa.array(c, t) for c, t in zip(columns, kinds)]], names=[key, *[x.split()[0] for x in SENTENCE.split(", ")]])

    return spread(notes.select(key, text), 2).mapInArrow(run, f"`{key}` {notes.schema[key].dataType.simpleString()}, {SENTENCE}")


def term_token_column(text: Column) -> Column:
    """The tokens of vocabulary terms, by the term tokenizer, in Arrow batches."""

    @F.pandas_udf("array<string>")
    def run(column):
        return column.__class__([tk.term_tokens(x) if x else [] for x in column], dtype=object)

    return run(text)


def dictionary_lines(spark: SparkSession, folder: str, configurations: Sequence[Configuration]) -> DataFrame:
    """dictionary, line, line_no of all files that the configurations name, each file once.

    A last line without a line break counts in a term dictionary and doesn't in a concept dictionary; of a
    file that is both, it counts as a term's line.
    """
    terms = {c.term_dictionary for c in configurations if c.term_dictionary}
    concepts = {c.concept_dictionary for c in configurations if c.concept_dictionary} - terms
    parts = [read_dictionary(spark, folder, n, drop_unterminated=n in concepts) for n in sorted(terms | concepts)]
    if not parts:
        raise ValueError("no configuration names a dictionary")
    return functools.reduce(DataFrame.unionByName, parts)


def build_index(spark: SparkSession, lines: DataFrame, configuration: Configuration, folder: str) -> DataFrame:
    """The term classes of a configuration, from the cache under ``folder`` if its lines haven't changed."""
    mine = lines.filter(F.col("dictionary") == configuration.term_dictionary)
    return cached_index(spark, mine, configuration.term_scheme, folder, lambda x: lookup.term_classes(bsv_rows(x, configuration.term_scheme).filter("octet_length(str) >= 1").withColumn("tt", term_token_column(F.col("str"))), F.col("tt")))


def counted(annotated: DataFrame, name: str = "annotations") -> tuple[DataFrame, Observation]:
    """The frame, and the number of its rows (``n``) as a metric that is there once it has run."""
    seen = Observation(name)
    return annotated.observe(seen, F.count(F.lit(1)).alias("n")), seen


def vocabulary(lines: DataFrame, configurations: Sequence[Configuration]) -> tuple[DataFrame, DataFrame]:
    """(terms, rows) of all configurations in one scan of their lines.

    ``lines``: dictionary (the path a configuration names), line, line_no. terms: config, cui, str; each
    (cui, str) once. rows: config and the concept scheme's columns without the ignored ones, line_no.
    """
    terms, rows = None, None
    for c in configurations:
        here = F.lit(c.name).alias("config")
        t = scheme_columns(lines.filter(F.col("dictionary") == c.term_dictionary), c.term_scheme).select(here, "cui", "str").filter("str IS NOT NULL AND octet_length(str) >= 1")
        concept = scheme_columns(lines.filter(F.col("dictionary") == (c.concept_dictionary or c.term_dictionary)), c.concept_scheme or c.term_scheme, ["line_no"])
        keep = [x for x in concept.columns if x.upper() not in {i.upper() for i in c.ignored}]
        want = ("cui", "tui", "tty", "code", "sab", "pref", "line_no")
        r = concept.select(here, *[F.col(x) if x in keep else F.lit(None).cast("string").alias(x) for x in want])
        terms, rows = (t, r) if terms is None else (terms.unionByName(t), rows.unionByName(r))
    if terms is None:
        raise ValueError("no configuration names a vocabulary")
    return terms.dropDuplicates(["config", "cui", "str"]), rows


def _may_anchor(tags: frozenset[str]) -> Column:
    """Which tokens may anchor a term: no punctuation, and none with an excluded tag."""
    free = (lambda t: ~F.coalesce(t["tag"], F.lit("")).isin(sorted(tags))) if tags else (lambda t: F.lit(True))
    return F.transform("tokens", lambda t: (t["kind"] != "punct") & free(t))


def tokenized_terms(terms: DataFrame) -> DataFrame:
    """Terms with ``tt``, their tokens, read once and checkpointed."""
    return checkpoint(terms.withColumn("tt", term_token_column(F.col("str"))))


def annotations(sentences: DataFrame, key: str, tokenized: DataFrame, rows: DataFrame, configurations: Sequence[Configuration]) -> DataFrame:
    """key, sent_no, config, semantic, term, begin, end (characters of the note): one row per annotation and class.

    ``tokenized``: ``tokenized_terms``. One join for all configurations; the exclusion tags of each apply to the anchor only. Configurations
    in precision mode keep the longest spans of a sentence and semantic group. The rows are dealt out by note.
    """
    parts = int(sentences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = lambda df: df.repartition(parts, key)
    index = lookup.sized(lookup.term_classes(tokenized, F.col("tt"), ["config"]))
    excluded = {c.name: frozenset(x.lower() for x in c.exclusion_tags) for c in configurations}
    s = sentences.filter("sent_no IS NOT NULL").withColumn("tokens", F.filter("tokens", lambda t: t["kind"] != "newline"))
    words, lemmas = F.transform("tokens", lambda t: t["text"]), F.transform("tokens", lambda t: F.coalesce(t["lemma"], t["text"]))
    places = F.transform("tokens", lambda t: F.struct(t["begin"].alias("b"), t["end"].alias("e")))
    hits = []
    for tags in set(excluded.values()):  # as a rule all configurations exclude the same tags: one pass
        names = [n for n, x in excluded.items() if x == tags]
        a = lookup.anchors(s, [key, "sent_no"], words, lookup.reach_of(tokenized, F.col("tt")), lemmas, _may_anchor(tags), places)
        mine = index if len(names) == len(excluded) else lookup.sized(index.filter(F.col("config").isin(names)))
        hits.append(lookup.matches(a, mine, [key, "sent_no"], ["config"], deal))
    found = hits[0]
    for h in hits[1:]:
        found = found.unionByName(h)
    groups = lookup.concepts(rows.select(F.concat_ws("\x02", "config", "cui").alias("cui"), "tui"))
    members = lookup.membership(tokenized.withColumn("cui", F.concat_ws("\x02", "config", "cui")), F.col("tt"), ["config", "cui"])
    classes = lookup.class_groups(members.select("cui", F.concat_ws("\x02", "config", "term").alias("term")), groups)
    classes = classes.select(F.split("term", "\x02").alias("p"), "semantic").select(F.get("p", F.lit(0)).alias("config"), F.get("p", F.lit(1)).alias("term"), "semantic")
    each = found.join(lookup.sized(classes), ["config", "term"])
    exact = [c.name for c in configurations if c.precision_mode]
    kept = lookup.longest(each, [key, "sent_no", "config", "semantic"], F.col("config").isin(exact)) if exact else each
    return kept.select(key, "sent_no", "config", "semantic", "term", F.col("first").alias("begin"), F.col("last").alias("end"))


def concept_lists(terms: DataFrame, rows: DataFrame) -> DataFrame:
    """config, term, semantic, tail: the described concepts of each class and group with its names, as JSON, once per class."""
    members = lookup.membership(terms, F.col("tt"), ["config", "cui"])
    groups = rows.select("config", "cui", F.explode(lookup.tui_list(F.col("tui"))).alias("t")).select("config", "cui", lookup.semantic(F.col("t")).alias("semantic")).distinct()
    described = lookup.merged_concepts(rows, ["line_no"], ["config"]).select("config", F.col("cui").alias("upper"), responses.umls_concept().alias("c"))
    each = members.join(groups, ["config", "cui"], "left").withColumns({"semantic": F.coalesce("semantic", F.lit("unknown")), "upper": F.upper("cui")})
    joined = each.join(described, ["config", "upper"], "left").groupBy("config", "term", "semantic")
    listed = joined.agg(F.transform(F.sort_array(F.collect_list(F.struct("upper", "c"))), lambda x: x["c"]).alias("umlsConcepts"))
    return lookup.sized(listed.select("config", "term", "semantic", responses.class_tail(F.col("semantic"), F.col("umlsConcepts")).alias("tail")))


_JSON = json.JSONEncoder(ensure_ascii=False).encode


def _bags(text: str, begin: int, ts: list[Token], spans: list[dict], features: Sequence[str], models: Models) -> list[str]:
    """The attributes of the annotations of one sentence and configuration, as JSON."""
    bags: list[dict] = [{} for _ in spans]
    of = lambda semantic: sorted({(s["begin"], s["end"]) for s in spans if s["semantic"] == semantic})
    at = lambda semantic, place: [k for k, s in enumerate(spans) if s["semantic"] == semantic and (s["begin"], s["end"]) == place]
    if "lab" in features and (labs := of("lab")):
        for r in attributes.link_labs(text, labs, models.labs, units=models.units, tokens=ts, begin=begin):
            for k in at("lab", (r["begin"], r["end"])):
                if r["value"] is not None:
                    bags[k]["labValue"] = [attributes.low(r["value"]), *r["value_at"]]
                if r["unit"] is not None:
                    bags[k]["labValueUnit"] = [attributes.low(r["unit"]), *r["unit_at"]]
    if "drug" in features and (drugs := of("drug")):
        for place, found in zip(drugs, attributes.drug_places(ts, drugs, intended=models.intended)):
            for k in at("drug", place):
                bags[k] |= attributes.drug_bag(text, begin, found)
    if "polarity" in features:
        for k, s in enumerate(spans):
            bags[k]["polarity"] = "negative" if attributes.is_negative(ts, s["begin"], s["end"]) else "positive"
    return [_JSON(b) for b in bags]


_ITEM = pa.struct([("id", pa.int32()), ("sent_begin", pa.int32()), ("sent_end", pa.int32()), ("semantic", pa.string()), ("term", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("attributes", pa.string())])
ITEM = "struct<id:int,sent_begin:int,sent_end:int,semantic:string,term:string,begin:int,end:int,text:string,attributes:string>"


def _items(sentences: list[dict], spans: list[dict], features: dict[str, frozenset[str]], models: Models) -> dict[str, list[dict]]:
    """The annotations of one note by configuration, in order of (begin, end, semantic, term), ids from 0."""
    of = {s["sent_no"]: s for s in sentences}
    out: dict[str, list[dict]] = {c: [] for c in features}
    by: dict[int, dict[str, list[dict]]] = {}
    for s in sorted(spans, key=lambda s: (s["begin"], s["end"], s["semantic"], s["term"])):
        by.setdefault(s["sent_no"], {}).setdefault(s["config"], []).append(s)
    for n, configs in by.items():
        a, b, text = of[n]["sent_begin"], of[n]["sent_end"], of[n]["sentence"]
        tokens = tk.tokenize(text, a)
        for config, ss in configs.items():
            out[config] += [{"sent_begin": a, "sent_end": b, "semantic": s["semantic"], "term": s["term"], "begin": s["begin"], "end": s["end"], "text": text[s["begin"] - a : s["end"] - a], "attributes": bag} for s, bag in zip(ss, _bags(text, a, tokens, ss, features[config], models))]
    for items in out.values():
        items.sort(key=lambda s: (s["begin"], s["end"], s["semantic"], s["term"]))
        for k, item in enumerate(items):
            item["id"] = k
    return out


def with_attributes(found: DataFrame, sentences: DataFrame, key: str, configurations: Sequence[Configuration], models: Models = Models()) -> DataFrame:
    """key, config, n_chars, error, items: a row per note and configuration with its ``annotations``, their text and attributes (JSON)."""
    features = {c.name: c.features for c in configurations}
    # partitions of a given number aren't merged for being small: the pass behind them is bound by CPU time
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = found.groupBy(key).agg(F.collect_list(F.struct("sent_no", "config", "begin", "end", "semantic", "term")).alias("spans"))
    one = F.when(F.col("sent_no").isNotNull(), F.struct("sent_no", "sent_begin", "sent_end", "sentence"))
    notes = sentences.select(key, one.alias("one"), "n_chars", "error").repartition(parts, key).groupBy(key).agg(F.max("n_chars").alias("n_chars"), F.max("error").alias("error"), F.collect_list("one").alias("sentences"))
    joined = notes.join(shuffled(spans), key, "left").select(key, "n_chars", "error", "sentences", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            at, configs, items = [], [], []
            for k, (sentences, spans) in enumerate(zip(b.column(3).to_pylist(), b.column(4).to_pylist())):
                for config, listed in _items(sentences, spans or [], features, models).items():
                    at.append(k)
                    configs.append(config)
                    items.append(listed)
            place = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(place), pa.array(configs, pa.string()), b.column(1).take(place), b.column(2).take(place), _listed(items, _ITEM)], names=[key, "config", "n_chars", "error", "items"])

    return joined.mapInArrow(run, f"`{key}` {found.schema[key].dataType.simpleString()}, config string, n_chars int, error string, items array<{ITEM}>")


def _for_lookup(sentences: DataFrame) -> DataFrame:
    """``with_sentences`` without what is made again later; a lemma that is the token itself is null, as ``annotations`` reads it."""
    t = F.transform("tokens", lambda t: F.struct(t["begin"].alias("begin"), t["end"].alias("end"), t["text"].alias("text"), F.nullif(t["lemma"], t["text"]).alias("lemma"), t["tag"].alias("tag"), t["kind"].alias("kind")))
    return sentences.withColumn("tokens", t)


def clinical(notes: DataFrame, key: str, lines: DataFrame, configurations: Sequence[Configuration], models: Models = Models(), text: str = "text") -> DataFrame:
    """key, config, response (JSON), error: one row per note and configuration."""
    sentences = checkpoint(_for_lookup(with_sentences(notes, key, text, models)))
    terms, rows = vocabulary(lines, configurations)
    terms = tokenized_terms(terms)
    found = with_attributes(annotations(sentences, key, terms, rows, configurations), sentences, key, configurations, models)
    return responses.clinical(found, concept_lists(terms, rows), key)


def smoking_status(notes: DataFrame, key: str, config: str = "smoking", models: Models = Models(), text: str = "text") -> DataFrame:
    """key, config, response (JSON), error: sentences adjusted and classified, and the document's status. One Arrow pass: a note is whole in its row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, errors = [], []
            for k, note in zip(*[c.to_pylist() for c in b.columns]):
                try:
                    out.append(json.dumps({"docId": str(k), "dob": "", "gender": "", "age": "", **smoking.document(note or "", tagging.split_model(note or "", models.sentences), models.smoker)}, ensure_ascii=False))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    out.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:500])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([config] * len(out), pa.string()), pa.array(out, pa.string()), pa.array(errors, pa.string())], names=[key, "config", "response", "error"])

    return spread(notes.select(key, text), 2).mapInArrow(run, f"`{key}` {notes.schema[key].dataType.simpleString()}, config string, response string, error string")


def annotate_notes(notes: DataFrame, key: str, lines: DataFrame | None, configurations: Sequence[Configuration], models: Models = Models(), text: str = "text") -> DataFrame:
    """key, config, response, error of all configurations, each by its pipeline."""
    parts = []
    if looked := [c for c in configurations if c.pipeline == "default_clinical"]:
        if lines is None:
            raise ValueError("a vocabulary is needed for " + ", ".join(c.name for c in looked))
        parts.append(clinical(notes, key, lines, looked, models, text))
    parts += [smoking_status(notes, key, c.name, models, text) for c in configurations if c.pipeline == "smoking_status"]
    if not parts:
        raise ValueError("no configuration")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def annotate(spark: SparkSession, text: str | bytes, lines: DataFrame | None, configurations: Sequence[Configuration], models: Models = Models()) -> str:
    """The envelope of one text, as the HTTP entry gives it: its request id is ``test_api``. A text that isn't UTF-8 raises ValueError."""
    if isinstance(text, bytes):
        text = text.decode("utf-8")
    one = spark.createDataFrame([("test_api", text)], "tid string, text string")
    done = annotate_notes(one, "tid", lines, configurations, models)
    return responses.envelope(done, "tid").collect()[0]["envelope"]
