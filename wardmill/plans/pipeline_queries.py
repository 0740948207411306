"""Catalogue entries of the configuration-driven pipeline, with their SQL.

The notes are built from columns of ``part``; the vocabulary is given here, line by line. So the SQL side
knows every annotation by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.frames import read_table
from wardmill.functions import session as functions
from wardmill.operators import pipeline, responses
from wardmill.sources import parse_configuration

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


VOCABULARY = """
# CUI|TUI|TTY|CODE|SAB|STR|PREF
C0000001|T121|IN|6809|RXNORM|Metformin|metformin
C0000001|[T121,T109]|PT|109081006|SNOMEDCT|metformin|metformin again
C0000002|T184|PT|29857009|SNOMEDCT|chest pain|chest pain
C0000003|T184|PT|22253000|SNOMEDCT|pain|pain
C0000004|T034|PT|2345-7|LNC|glucose|glucose level
C0000005|T023|PT|72696002|SNOMEDCT|knee|knee
C0000006|T058|PT|1234|LOCAL|take|taking
C0000007|T047|PT|E11|ICD10|pain of the left knee after a fall from the stairs|long term
C0000008|T047|PT|icd|ICD10|other|code only
""".strip().split("\n")

_YAML = """
params:
  FDL:
    term_dictionary: inline.bsv
    term_scheme: {term}
    concept_dictionary: inline.bsv
    concept_scheme: CUI|TUI|TTY|CODE|SAB|STR|PREF
    concept_params_ignore: [STR{ignored}]
    exclusion_tags: [{tags}]
    precision_mode: {precision}
pipeline: {pipeline}
features: [{features}]
"""


def _configuration(name: str, features: str = "", precision: bool = True, tags: str = "VB", ignored: str = "", term: str = "CUI|TUI|TTY|CODE|SAB|STR|PREF", kind: str = "default_clinical"):
    return parse_configuration(name, _YAML.format(features=features, precision=precision, tags=tags, ignored=ignored, term=term, pipeline=kind))


def _lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("inline.bsv", x, i) for i, x in enumerate(VOCABULARY)], "dictionary string, line string, line_no int")


_MODELS = pipeline.Models(exceptions={"noun": {"knees": "knee"}})
_TEXT = "concat('Give metformin ', p_size, ' mg tablet twice daily. ', CASE p_partkey % 3 WHEN 0 THEN 'She denies chest pain.' WHEN 1 THEN 'She has chest pain.' ELSE 'No knees were swollen.' END, ' Glucose : ', 80 + p_size, ' mg/dl today.')"


def _notes(spark: SparkSession, d: str, text: str = _TEXT) -> DataFrame:
    return read_table(spark, d, "part").select("p_partkey", F.expr(text).alias("text"))


_CONTENT = "docId string, dob string, content array<struct<id:int,sentence:array<int>,sectionOffset:array<int>,text:array<string>,sectionOid:string,attributes:string,aspect:string,name:string,umlsConcepts:array<struct<tui:array<string>,cui:string,preferredText:string,sabConcepts:array<struct<codingScheme:string,vocabConcepts:array<struct<tty:array<string>,code:string>>>>>>>>"


def _content(done: DataFrame) -> DataFrame:
    return done.select("p_partkey", "config", F.explode(F.from_json("response", _CONTENT)["content"]).alias("c")).select("p_partkey", "config", "c.*")


_T = f"(SELECT *, {_TEXT.replace('concat(', 'concat(')} AS t FROM part)"
_ROWS = f"""SELECT p_partkey, id, w AS "text", strpos(lower(t), w) - 1 AS "begin", strpos(lower(t), w) - 1 + length(w) AS "end", length(t) AS n_chars, aspect, name,
CASE WHEN aspect = 'symptom' AND p_partkey % 3 = 0 OR aspect = 'anatomy' THEN 'negative' ELSE 'positive' END AS polarity,
CASE WHEN aspect = 'drug' THEN p_size || '' END AS strength, CASE WHEN aspect = 'drug' THEN 'mg' END AS unit, CASE WHEN aspect = 'drug' THEN 'tablet' END AS form, CASE WHEN aspect = 'drug' THEN '2.0' END AS frequency,
CASE WHEN aspect = 'lab' THEN (80 + p_size) || '' END AS lab_value, CASE WHEN aspect = 'lab' THEN 'mg/dl' END AS lab_unit,
CASE aspect WHEN 'drug' THEN 'C0000001' WHEN 'symptom' THEN 'C0000002' WHEN 'anatomy' THEN 'C0000005' ELSE 'C0000004' END AS cui
FROM {_T}, (VALUES (0, 'metformin', 'drug', 'MedicationMention', 3), (1, 'chest pain', 'symptom', 'SignSymptomMention', 0), (1, 'chest pain', 'symptom', 'SignSymptomMention', 1), (1, 'knees', 'anatomy', 'AnatomicalSiteMention', 2), (2, 'glucose', 'lab', 'LabMention', 3)) AS v(id, w, aspect, name, k) WHERE k = 3 OR p_partkey % 3 = k"""


@query(_ROWS)
def pipeline_response(spark: SparkSession, d: str) -> DataFrame:
    """The whole pipeline under one configuration with all features; the responses read back."""
    done = pipeline.annotate_notes(_notes(spark, d), "p_partkey", _lines(spark), [_configuration("all", "lab, drug, polarity")], _MODELS)
    c = _content(done).withColumn("a", F.from_json("attributes", "polarity string, medStrengthNum array<string>, medStrengthUnit array<string>, medForm string, medFrequencyNumber array<string>, labValue array<string>, labValueUnit array<string>"))
    at = lambda name: F.get(F.col(f"a.{name}"), F.lit(0))
    return c.select("p_partkey", "id", F.get("text", F.lit(0)).alias("text"), F.get("text", F.lit(1)).cast("long").alias("begin"), F.get("text", F.lit(2)).cast("long").alias("end"), F.get("sectionOffset", F.lit(1)).cast("long").alias("n_chars"), "aspect", "name", "a.polarity", at("medStrengthNum").alias("strength"), at("medStrengthUnit").alias("unit"), F.col("a.medForm").alias("form"), at("medFrequencyNumber").alias("frequency"), at("labValue").alias("lab_value"), at("labValueUnit").alias("lab_unit"), F.get("umlsConcepts", F.lit(0))["cui"].alias("cui"))


@query(f"""SELECT p_partkey, 'sentence ' || n || ' of a note' AS what, b AS "begin", e AS "end" FROM (SELECT p_partkey, 1 AS n, 0 AS b, strpos(t, 'daily.') + 5 AS e FROM {_T} UNION ALL SELECT p_partkey, 2, strpos(t, 'daily.') + 6, strpos(t, ' Glucose') - 1 FROM {_T} UNION ALL SELECT p_partkey, 3, strpos(t, ' Glucose'), length(t) FROM {_T})""")
def pipeline_sentences(spark: SparkSession, d: str) -> DataFrame:
    s = pipeline.with_sentences(_notes(spark, d), "p_partkey")
    return s.select("p_partkey", F.concat(F.lit("sentence "), F.col("sent_no") + 1, F.lit(" of a note")).alias("what"), F.col("sent_begin").cast("long").alias("begin"), F.col("sent_end").cast("long").alias("end"))


@query("""SELECT p_partkey, config, string_agg(w || CASE WHEN config = 'bare' THEN '' WHEN aspect = 'drug' AND config = 'drug' THEN ' +drug' WHEN aspect = 'lab' AND config = 'lab' THEN ' +lab' WHEN config = 'polarity' THEN ' +polarity' ELSE '' END, ',' ORDER BY id) AS found
FROM part, (VALUES ('bare'), ('drug'), ('lab'), ('polarity')) AS c(config), (VALUES (0, 'metformin', 'drug', 3), (1, 'chest pain', 'symptom', 0), (1, 'chest pain', 'symptom', 1), (1, 'knees', 'anatomy', 2), (2, 'glucose', 'lab', 3)) AS v(id, w, aspect, k) WHERE k = 3 OR p_partkey % 3 = k GROUP BY p_partkey, config""")
def pipeline_features(spark: SparkSession, d: str) -> DataFrame:
    """Four configurations over one vocabulary in one lookup; each runs the features that it names."""
    configurations = [_configuration("bare"), *[_configuration(x, x) for x in ("drug", "lab", "polarity")]]
    c = _content(pipeline.annotate_notes(_notes(spark, d), "p_partkey", _lines(spark), configurations, _MODELS))
    mark = F.when(F.col("attributes").contains('"medForm"'), " +drug").when(F.col("attributes").contains('"labValue"'), " +lab").when(F.col("attributes").contains('"polarity"'), " +polarity").otherwise("")
    listed = c.groupBy("p_partkey", "config").agg(F.sort_array(F.collect_list(F.struct("id", F.concat(F.get("text", F.lit(0)), mark).alias("w")))).alias("x"))
    return listed.select("p_partkey", "config", F.array_join(F.transform("x", lambda y: y["w"]), ",").alias("found"))


@query("""SELECT p_partkey, config, CASE config WHEN 'tags' THEN 'chest pain' WHEN 'free' THEN CASE p_partkey % 2 WHEN 0 THEN 'take,chest pain' ELSE 'chest pain' END WHEN 'loose' THEN 'chest pain,pain' ELSE 'icd' END AS found
FROM part, (VALUES ('tags'), ('free'), ('loose'), ('code')) AS c(config) WHERE config <> 'code' OR p_partkey % 2 = 1""")
def pipeline_configurations(spark: SparkSession, d: str) -> DataFrame:
    """Exclusion tags, precision mode and a scheme that looks codes up as text, side by side."""
    text = "CASE p_partkey % 2 WHEN 0 THEN 'Please take rest , chest pain today .' ELSE 'Code icd for chest pain today .' END"
    configurations = [_configuration("tags"), _configuration("free", tags=""), _configuration("loose", precision=False), _configuration("code", term="CUI|TUI|TTY|STR|SAB|TXT|PREF")]
    c = _content(pipeline.annotate_notes(_notes(spark, d, text), "p_partkey", _lines(spark), configurations, _MODELS))
    listed = c.groupBy("p_partkey", "config").agg(F.sort_array(F.collect_list(F.struct("id", F.get("text", F.lit(0)).alias("w")))).alias("x"))
    return listed.select("p_partkey", "config", F.array_join(F.transform("x", lambda y: y["w"]), ",").alias("found"))


@query("SELECT p_partkey, config, 'C0000001: T109,T121 metformin RXNORM 6809' || CASE config WHEN 'all' THEN '(IN)' ELSE '()' END || ' SNOMEDCT 109081006' || CASE config WHEN 'all' THEN '(PT)' ELSE '()' END AS concept FROM part, (VALUES ('all'), ('ignored')) AS c(config)")
def pipeline_concepts(spark: SparkSession, d: str) -> DataFrame:
    """Concepts with their schemes and codes; an ignored column comes out empty."""
    configurations = [_configuration("all"), _configuration("ignored", ignored=", TTY")]
    c = _content(pipeline.annotate_notes(_notes(spark, d), "p_partkey", _lines(spark), configurations, _MODELS)).filter("aspect = 'drug'")
    u = F.get("umlsConcepts", F.lit(0))
    codes = F.transform(u["sabConcepts"], lambda s: F.concat(s["codingScheme"], F.lit(" "), F.array_join(F.transform(s["vocabConcepts"], lambda v: F.concat(v["code"], F.lit("("), F.array_join(v["tty"], ","), F.lit(")"))), ",")))
    return c.select("p_partkey", "config", F.concat(u["cui"], F.lit(": "), F.array_join(u["tui"], ","), F.lit(" "), u["preferredText"], F.lit(" "), F.array_join(codes, " ")).alias("concept"))


@query("""SELECT p_partkey, w AS "text", strpos(t, w) - 1 AS "begin" FROM (SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 'x ' ELSE '' END || 'had pain of the left knee after a fall from the stairs.' AS t FROM part), (VALUES ('pain of the left knee after a fall from the stairs'), ('pain'), ('knee')) AS v(w)""")
def pipeline_long_terms(spark: SparkSession, d: str) -> DataFrame:
    """A term of eleven tokens beside the short ones in it, which belong to other groups."""
    text = "concat(CASE p_partkey % 2 WHEN 0 THEN 'x ' ELSE '' END, 'had pain of the left knee after a fall from the stairs.')"
    c = _content(pipeline.annotate_notes(_notes(spark, d, text), "p_partkey", _lines(spark), [_configuration("all")], _MODELS))
    return c.select("p_partkey", F.get("text", F.lit(0)).alias("text"), F.get("text", F.lit(1)).cast("long").alias("begin"))


_SMOKE = "CASE p_partkey % 4 WHEN 0 THEN concat('Tobacco:\\nnone. Walks ', p_size, ' miles.') WHEN 1 THEN 'He quit smoking. He smokes again.' WHEN 2 THEN 'Chest pain. No tobacco.' ELSE 'Walks.' END"


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN 'CURRENT_SMOKER' WHEN 3 THEN 'UNKNOWN' ELSE 'NON_SMOKER' END AS status, CAST(CASE p_partkey % 4 WHEN 3 THEN 1 ELSE 2 END AS INTEGER) AS n_sentences, CASE p_partkey % 4 WHEN 0 THEN 'NON_SMOKER 0-14,UNKNOWN 15-' || (28 + length(p_size || '')) WHEN 1 THEN 'PAST_SMOKER 0-16,CURRENT_SMOKER 17-33' WHEN 2 THEN 'UNKNOWN 0-11,NON_SMOKER 12-23' ELSE 'UNKNOWN 0-6' END AS sentences FROM part""")
def smoking_response(spark: SparkSession, d: str) -> DataFrame:
    """The smoking pipeline: adjusted sentences with their spans, and the status of the note."""
    done = pipeline.smoking_status(_notes(spark, d, _SMOKE), "p_partkey")
    r = done.select("p_partkey", F.from_json("response", "smokingStatus string, sentences array<struct<Status:string,Text:array<string>>>").alias("r"))
    listed = F.transform("r.sentences", lambda s: F.concat(s["Status"], F.lit(" "), s["Text"][1], F.lit("-"), s["Text"][2]))
    return r.select("p_partkey", F.col("r.smokingStatus").alias("status"), F.size("r.sentences").alias("n_sentences"), F.array_join(listed, ",").alias("sentences"))


@query("SELECT p_partkey, 'clinical,smoking' AS configurations, CAST(p_partkey % 4 = 2 AS INTEGER) AS n_annotations, CASE p_partkey % 4 WHEN 1 THEN 'CURRENT_SMOKER' WHEN 3 THEN 'UNKNOWN' ELSE 'NON_SMOKER' END AS status FROM part")
def pipeline_envelope(spark: SparkSession, d: str) -> DataFrame:
    """Both pipelines, each for its configuration, merged to one object a note."""
    configurations = [_configuration("clinical"), _configuration("smoking", kind="smoking_status")]
    merged = responses.envelope(pipeline.annotate_notes(_notes(spark, d, _SMOKE), "p_partkey", _lines(spark), configurations, _MODELS), "p_partkey")
    e = merged.select("p_partkey", F.json_object_keys("envelope").alias("k"), F.from_json("envelope", "clinical struct<content:array<struct<id:int>>>, smoking struct<smokingStatus:string>").alias("e"))
    return e.select("p_partkey", F.array_join(F.sort_array("k"), ",").alias("configurations"), F.size("e.clinical.content").alias("n_annotations"), F.col("e.smoking.smokingStatus").alias("status"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'she ca n''t take ' || p_size || ' mg .' ELSE 'pre-op visit on 555-1234 , ok ' || p_size END AS tokens, 7 AS n FROM part")
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """The tokenizer as a function of the session."""
    functions.register(spark)
    read_table(spark, d, "part").createOrReplaceTempView("wardmill_part")
    t = spark.sql("SELECT p_partkey, ptb_tokens(CASE WHEN p_partkey % 2 = 0 THEN concat('She can''t take ', p_size, ' mg .') ELSE concat('Pre-op visit on 555-1234, ok ', p_size) END) AS t FROM wardmill_part")
    return t.select("p_partkey", F.array_join(F.transform("t", lambda x: x["text"]), " ").alias("tokens"), F.size("t").alias("n"))


@query("SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 'post-op|5|.5|ml' ELSE 'crohn|''s|disease|(|x|)' END AS tokens, p_partkey % 3 = 0 AS negative, 'walk' AS lemma, p_size || '' AS strength, p_size || '' AS lab FROM part")
def sql_annotators(spark: SparkSession, d: str) -> DataFrame:
    """Term tokens, lemmas, drug attributes, lab links and polarity as functions of the session."""
    functions.register(spark, pipeline.Models(rules={"verb": [("ing", "")]}, bases={"verb": frozenset(["walk"])}))
    read_table(spark, d, "part").createOrReplaceTempView("wardmill_part")
    t = spark.sql(
        "SELECT p_partkey, term_tokens(CASE p_partkey % 2 WHEN 0 THEN 'post-op 5.5 ml' ELSE 'Crohn''s disease (x)' END) AS tt, polarity(CASE p_partkey % 3 WHEN 0 THEN 'She denies any rash .' ELSE 'She has a rash .' END, 'rash') AS p, lemma('walking', 'VBG') AS lemma, "
        "drug_spans(concat('metformin ', p_size, ' mg tablet .')) AS d, lab_links(concat('glucose : ', p_size, ' mg/dl'), 'glucose') AS l FROM wardmill_part"
    )
    strength = F.get(F.filter("d", lambda x: x["kind"] == "strength"), F.lit(0))["text"]
    return t.select("p_partkey", F.array_join("tt", "|").alias("tokens"), (F.col("p") == "negative").alias("negative"), "lemma", strength.alias("strength"), F.get("l", F.lit(0))["value"].alias("lab"))
