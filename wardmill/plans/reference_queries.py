"""Catalogue entries of the annotation operators, with their SQL.

Notes are built from table columns by expressions that both engines read, so that the SQL side knows
the expected attribute by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill import resources
from wardmill.frames import read_table
from wardmill.functions import machines as M
from wardmill.functions import tokens as tk
from wardmill.operators import attributes, lookup, responses, smoking, tagging, tasks
from wardmill.session import fresh_folder
from wardmill.sources import bsv_rows, cached_index
from wardmill.streaming import attempts, deduplicated, process, run_once, start_worker

QUERIES: dict = {}
SQL: dict[str, str] = {}
TERMS = "CUI|TUI|TTY|CODE|SAB|STR|PREF"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- tokens

_TOK = "SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM documents"


@query(f"SELECT count(*) AS n_tokens, count(DISTINCT w) AS n_distinct FROM (SELECT unnest(t) AS w FROM ({_TOK}))")
def token_stats(spark: SparkSession, d: str) -> DataFrame:
    words = read_table(spark, d, "documents").select(F.explode(tk.simple_tokens(F.col("text"))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return words.agg(F.sum("n").alias("n_tokens"), F.count(F.lit(1)).alias("n_distinct"))


@query(f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, CAST(len(t) * (len(t) - 1) / 2 AS BIGINT) AS pos_sum, t[1] AS first_token, t[len(t)] AS last_token FROM ({_TOK}) WHERE len(t) > 0")
def token_positions(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "documents").select("doc_id", tk.simple_tokens(F.col("text")).alias("t")).filter(F.size("t") > 0)
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.expr("aggregate(sequence(0, size(t) - 1), 0L, (a, i) -> a + i)").alias("pos_sum"), F.get("t", F.lit(0)).alias("first_token"), F.element_at("t", -1).alias("last_token"))


@query("SELECT shape, count(*) AS n FROM (SELECT regexp_replace(regexp_replace(regexp_replace(unnest(string_split(p_name, ' ')), '[^A-Z0-9]', 'x', 'g'), '[A-Z]', 'X', 'g'), '[0-9]', 'd', 'g') AS shape FROM part) GROUP BY shape")
def token_shape(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("w")).select(tk.shape_of(F.col("w")).alias("shape")).groupBy("shape").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, 6 AS n_word, 2 AS n_number, 1 AS n_punct, 1 AS n_symbol, CASE WHEN p_size > 9 THEN 'dd' ELSE 'd' END AS size_shape FROM part")
def ptb_token_classes(spark: SparkSession, d: str) -> DataFrame:
    notes = read_table(spark, d, "part").select("p_partkey", F.expr("concat('Patient can''t take ', p_size, ' tabs, call 555-1234 .')").alias("text"))
    t = tk.with_tokens(notes)
    n = lambda k: F.size(F.filter("tokens", lambda x: x["kind"] == k))
    return t.select("p_partkey", n("word").alias("n_word"), n("number").alias("n_number"), n("punct").alias("n_punct"), n("symbol").alias("n_symbol"), F.get("tokens", F.lit(4))["shape"].alias("size_shape"))


@query("SELECT doc_id, CAST(len(list_filter(list_transform(regexp_split_to_array(text, '\\n+'), lambda x: trim(x)), lambda x: x <> '')) AS INTEGER) AS n_lines FROM documents WHERE text IS NOT NULL")
def line_split(spark: SparkSession, d: str) -> DataFrame:
    lines = F.filter(F.transform(F.split("text", "\n+"), lambda x: F.trim(x)), lambda x: x != "")
    return read_table(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", F.size(lines).alias("n_lines"))


@query("SELECT p_partkey, 3 AS n_sentences, length('Seen on ward ' || p_size || '.') AS first_end FROM part")
def sentence_fallback(spark: SparkSession, d: str) -> DataFrame:
    notes = read_table(spark, d, "part").select("p_partkey", F.expr("concat('Seen on ward ', p_size, '. Is it ', p_brand, '? Yes\n')").alias("text"))
    e = tagging.fallback_ends(F.col("text"))
    return notes.select("p_partkey", F.size(e).alias("n_sentences"), F.get(e, F.lit(0)).alias("first_end"))


# ---- vocabulary

_BSV = "SELECT DISTINCT p[1] AS cui, p[6] AS str FROM (SELECT string_split(lower(line), '|') AS p FROM term_lines WHERE line IS NOT NULL AND line <> '' AND NOT starts_with(line, '#') AND NOT starts_with(line, '//'))"
_BSV_ALL = "SELECT p[1] AS cui, p[2] AS tui, p[3] AS tty, p[4] AS code, p[5] AS sab, p[6] AS str, p[7] AS pref, line_id FROM (SELECT line_id, string_split(lower(line), '|') AS p FROM term_lines WHERE line IS NOT NULL AND line <> '' AND NOT starts_with(line, '#') AND NOT starts_with(line, '//'))"


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """Vocabulary rows with every line (concepts keep all of them)."""
    parts = F.split(F.lower("line"), r"\|")
    lines = read_table(spark, d, "term_lines").filter("line <> '' AND NOT startswith(line, '#') AND NOT startswith(line, '//')")
    return lines.select(*[F.get(parts, i).alias(n.lower()) for i, n in enumerate(TERMS.split("|"))], "file_path", "line_id")


@query(_BSV)
def bsv_parse_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return bsv_rows(read_table(spark, d, "term_lines"), TERMS).select("cui", "str")


def _case(column: str) -> str:
    from wardmill import resources as R

    return "CASE " + " ".join(f"WHEN {column} IN ({', '.join(repr(x) for x in ids)}) THEN '{name}'" for name, ids in R.SEMANTIC) + " ELSE 'unknown' END"


_GROUPS = f"SELECT DISTINCT cui, {_case('t')} AS semantic FROM (SELECT cui, upper(unnest(string_split(regexp_replace(tui, '[\\[\\]\\s]', '', 'g'), ','))) AS t FROM ({_BSV_ALL})) WHERE t <> ''"


@query(f"SELECT semantic, count(*) AS n_concepts FROM ({_GROUPS}) GROUP BY semantic")
def tui_semantic(spark: SparkSession, d: str) -> DataFrame:
    return lookup.concepts(_rows(spark, d)).groupBy("semantic").agg(F.count(F.lit(1)).alias("n_concepts"))


def _rare(column: str) -> str:
    from wardmill import resources as R

    return f"strlen({column}) > 1 AND regexp_matches({column}, '[a-zA-Z]') AND {column} NOT IN ({', '.join(repr(x) for x in sorted(R.NOT_RARE))})"


_WORDS = r"[\p{L}\p{M}\p{N}]+"


def _index_sql(config: bool = False) -> str:
    """The term classes, their rarest tokens, and their members; with ``config`` the file of a line is its configuration."""
    c = "file_path" if config else "''"
    return f"""
WITH b AS (SELECT DISTINCT {c} AS config, p[1] AS cui, p[6] AS str FROM (SELECT file_path, string_split(lower(line), '|') AS p FROM term_lines WHERE line IS NOT NULL AND line <> '' AND NOT starts_with(line, '#') AND NOT starts_with(line, '//'))),
b1 AS (SELECT config, cui, regexp_extract_all(str, '{_WORDS}') AS tokens FROM b),
mem AS (SELECT DISTINCT config, cui, array_to_string(tokens, ' ') AS term FROM b1 WHERE len(tokens) > 0),
k1 AS (SELECT config, tokens, count(*) AS weight FROM b1 WHERE len(tokens) > 0 GROUP BY ALL),
e AS (SELECT config, tokens, weight, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos FROM k1),
c AS (SELECT config, token, sum(weight) AS cnt FROM e WHERE {_rare('token')} GROUP BY ALL),
m AS (SELECT config, tokens, min((cnt, pos)) AS x FROM (SELECT e.config, e.tokens, c.cnt, e.pos FROM e JOIN c USING (config, token)) GROUP BY ALL),
i AS (SELECT config, tokens, array_to_string(tokens, ' ') AS term, CAST(len(tokens) AS INTEGER) AS n, CAST(CASE WHEN len(tokens) = 1 THEN 0 ELSE coalesce(x[2], 0) END AS INTEGER) AS rare_idx FROM k1 LEFT JOIN m USING (config, tokens)),
idx AS (SELECT *, tokens[rare_idx + 1] AS rare_word FROM i)"""


_INDEX = _index_sql()


def _terms(spark: SparkSession, d: str) -> DataFrame:
    return bsv_rows(read_table(spark, d, "term_lines"), TERMS)


@query(_INDEX + ", w AS (SELECT term, count(*) AS n_concepts FROM mem GROUP BY term) SELECT term, n, rare_idx, rare_word, n_concepts FROM idx JOIN w USING (term)")
def rare_word_index(spark: SparkSession, d: str) -> DataFrame:
    terms, words = _terms(spark, d), tk.plain_tokens(F.col("str"))
    members = lookup.membership(terms, words, ["cui"]).groupBy("term").agg(F.count(F.lit(1)).alias("n_concepts"))
    return lookup.term_classes(terms, words).join(members, "term").select("term", "n", "rare_idx", "rare_word", "n_concepts")


@query(_INDEX + " SELECT n, count(*) AS n_terms, count(DISTINCT rare_word) AS n_rare_words FROM idx GROUP BY n")
def index_cached(spark: SparkSession, d: str) -> DataFrame:
    """The index read from the cache that the first call for a vocabulary writes."""
    lines = read_table(spark, d, "term_lines").select("line")
    index = cached_index(spark, lines, TERMS, f"{fresh_folder(spark, 'index')}", lambda x: lookup.term_classes(bsv_rows(x, TERMS), tk.plain_tokens(F.col("str"))))
    return index.groupBy("n").agg(F.count(F.lit(1)).alias("n_terms"), F.countDistinct("rare_word").alias("n_rare_words"))


_SENTENCES = f"""
sn AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '[\r\n]+', chr(1), 'g'), '([.!?])[ \t\f]+', '\1' || chr(1), 'g'), chr(1)), lambda x: regexp_extract_all(lower(x), '{_WORDS}')), lambda t: len(t) > 0) AS s FROM documents WHERE text IS NOT NULL),
dt AS (SELECT doc_id, unnest(s) AS t, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS sent_no FROM sn),
a AS (SELECT doc_id, sent_no, t, unnest(t) AS word, generate_subscripts(t, 1) - 1 AS pos FROM dt)"""
_MATCH = """,
h AS (SELECT doc_id, sent_no, config, term, CAST(pos - rare_idx AS INTEGER) AS "begin", CAST(pos - rare_idx + n AS INTEGER) AS "end" FROM a JOIN idx ON word = rare_word
      WHERE n = 1 OR (pos - rare_idx >= 0 AND t[pos - rare_idx + 1 : pos - rare_idx + n] = tokens))"""
_HITS = f"{_INDEX},{_SENTENCES}{_MATCH}"


def _hits(spark: SparkSession, d: str, **more) -> DataFrame:
    return lookup.spans(read_table(spark, d, "documents"), _terms(spark, d), **more)


@query(_HITS + ' SELECT doc_id, sent_no, term, "begin", "end" FROM h')
def vocab_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Spans of all documents by term class; the concepts of the classes are ``vocab_members``."""
    return _hits(spark, d)


@query(_INDEX + " SELECT term, cui FROM mem")
def vocab_members(spark: SparkSession, d: str) -> DataFrame:
    return lookup.membership(_terms(spark, d), tk.plain_tokens(F.col("str")), ["cui"])


_BY_CUI = " SELECT cui, sum(k)::BIGINT AS n_spans FROM (SELECT term, count(*) AS k FROM h GROUP BY term) JOIN mem USING (term) GROUP BY cui"


def _by_cui(spans: DataFrame, members: DataFrame) -> DataFrame:
    """Spans per concept: counted by class first, so that no span is repeated for its concepts."""
    return spans.groupBy("term").agg(F.count(F.lit(1)).alias("k")).join(members, "term").groupBy("cui").agg(F.sum("k").alias("n_spans"))


@query(_HITS + _BY_CUI)
def concept_spans(spark: SparkSession, d: str) -> DataFrame:
    return _by_cui(_hits(spark, d), vocab_members(spark, d))


@query(_HITS.replace("WHERE n = 1 OR", "WHERE word NOT IN ('scalp', 'neck') AND (n = 1 OR").replace("= tokens))", "= tokens)))") + _BY_CUI)
def exclusion_anchor(spark: SparkSession, d: str) -> DataFrame:
    return _by_cui(_hits(spark, d, exclude=["scalp", "neck"]), vocab_members(spark, d))


@query(f"{_index_sql(True)},{_SENTENCES}{_MATCH}" + " SELECT config, count(*) AS n_hits, count(DISTINCT doc_id) AS n_docs FROM h GROUP BY config")
def vocab_lookup_multi(spark: SparkSession, d: str) -> DataFrame:
    """All vocabularies in one join; each has its own rarest tokens."""
    terms = _rows(spark, d).select(F.col("file_path").alias("config"), "cui", "str").dropDuplicates()
    h = lookup.spans(read_table(spark, d, "documents"), terms, group=["config"])
    return h.groupBy("config").agg(F.count(F.lit(1)).alias("n_hits"), F.countDistinct("doc_id").alias("n_docs"))


_ANN = _HITS + f""",
g AS ({_GROUPS}),
cg AS (SELECT term, coalesce(semantic, 'unknown') AS semantic, count(*) AS n_concepts, min(cui) AS first_cui FROM mem LEFT JOIN g USING (cui) GROUP BY ALL),
an AS (SELECT doc_id, sent_no, term, "begin", "end", semantic, n_concepts, first_cui FROM h JOIN cg USING (term))"""


def _annotations(spark: SparkSession, d: str) -> DataFrame:
    return lookup.annotations(_hits(spark, d), lookup.class_groups(vocab_members(spark, d), lookup.concepts(_rows(spark, d))))


@query(_ANN + """ SELECT doc_id, sent_no, semantic, "begin", "end", term, n_concepts, first_cui FROM an""")
def semantic_regroup(spark: SparkSession, d: str) -> DataFrame:
    return _annotations(spark, d).select("doc_id", "sent_no", "semantic", "begin", "end", "term", "n_concepts", "first_cui")


_KEPT = """(SELECT * FROM an x WHERE NOT EXISTS (SELECT 1 FROM an y WHERE y.doc_id = x.doc_id AND y.sent_no = x.sent_no AND y.semantic = x.semantic AND y."begin" <= x."begin" AND y."end" >= x."end" AND y."end" - y."begin" > x."end" - x."begin"))"""


@query(_ANN + f""" SELECT doc_id, sent_no, semantic, "begin", "end", term FROM {_KEPT}""")
def precision_spans(spark: SparkSession, d: str) -> DataFrame:
    return lookup.longest(_annotations(spark, d), ["doc_id", "sent_no", "semantic"]).select("doc_id", "sent_no", "semantic", "begin", "end", "term")


@query(f"""SELECT upper(cui) AS cui, arg_min(pref, (line_id, pref)) AS pref, coalesce(array_to_string(list_sort(list(DISTINCT t)), ','), '') AS tuis, count(DISTINCT CASE WHEN sab <> '' THEN (sab, code) END) AS n_codes
FROM (SELECT *, unnest(CASE WHEN len(x) = 0 THEN [NULL] ELSE x END) AS t FROM (SELECT *, list_filter(string_split(upper(regexp_replace(tui, '[\\[\\]\\s]', '', 'g')), ','), lambda y: y <> '') AS x FROM ({_BSV_ALL}))) WHERE tui IS NOT NULL AND pref IS NOT NULL GROUP BY 1""")
def concept_merge(spark: SparkSession, d: str) -> DataFrame:
    merged = lookup.merged_concepts(_rows(spark, d).filter("tui IS NOT NULL AND pref IS NOT NULL"), ["line_id"])
    return merged.select("cui", "pref", F.array_join("tuis", ",").alias("tuis"), F.size("codes").cast("long").alias("n_codes"))


# ---- polarity

_CUE = "CASE p_partkey % 6 WHEN 0 THEN 'patient denies ' WHEN 1 THEN 'patient has ' WHEN 2 THEN 'no evidence of ' WHEN 3 THEN 'denies fever but reports ' WHEN 4 THEN 'can not rule out ' ELSE 'without ' END"


@query("SELECT p_partkey, (p_partkey % 6 IN (0, 2, 5)) AS negative FROM part")
def polarity_left(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "part").select("p_partkey", F.split(F.expr(f"trim({_CUE})"), " ").alias("cue"))
    tokens = F.concat("cue", F.array(F.lit("rash")))
    return t.select("p_partkey", attributes.negated_words(attributes.side_words(tokens, F.size("cue"), True, 20)).alias("negative"))


@query("SELECT p_partkey, (p_partkey % 4 IN (0, 2)) AS negative FROM part")
def polarity_right(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "part").select("p_partkey", F.split(F.expr("concat('rash ', CASE p_partkey % 4 WHEN 0 THEN 'was negative' WHEN 1 THEN 'was seen' WHEN 2 THEN 'is unlikely' ELSE 'but no fever' END)"), " ").alias("w"))
    return t.select("p_partkey", attributes.negated_words(attributes.side_words(F.col("w"), F.lit(1), False, 10)).alias("negative"))


@query("SELECT p_size, count(*) AS n, count(*) FILTER (WHERE p_partkey % 6 IN (0, 2, 5)) AS n_negative FROM part GROUP BY p_size")
def polarity_by_size(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "part").select("p_size", F.split(F.expr(f"concat({_CUE}, 'rash today .')"), " ").alias("t")).withColumn("at", F.array_position("t", "rash").cast("int") - 1)
    left, right = attributes.side_words(F.col("t"), F.col("at"), True, 20), attributes.side_words(F.col("t"), F.col("at") + 1, False, 10)
    negative = attributes.negated_words(left) | attributes.negated_words(right)
    return t.withColumn("neg", negative).groupBy("p_size").agg(F.count(F.lit(1)).alias("n"), F.count_if("neg").alias("n_negative"))


# ---- medications

_FREQ = "CASE p_partkey % 5 WHEN 0 THEN 'twice daily' WHEN 1 THEN 'tid' WHEN 2 THEN 'qid' WHEN 3 THEN 'prn' ELSE 'three times a day' END"


@query("""SELECT p_partkey, 0 + p_size || '' AS strength, 'mg' AS unit, CASE p_partkey % 3 WHEN 0 THEN 'tablet' WHEN 1 THEN 'capsule' ELSE 'solution' END AS form,
CASE p_partkey % 2 WHEN 0 THEN 'Enteral_Oral' ELSE 'Parenteral_Intravenous' END AS route,
CASE p_partkey % 5 WHEN 0 THEN '2.0' WHEN 1 THEN '3.0' WHEN 2 THEN '4.0' WHEN 4 THEN '3.0' END AS frequency, CAST(NULL AS VARCHAR) AS duration FROM part""")
def drug_attributes(spark: SparkSession, d: str) -> DataFrame:
    note = f"concat('She takes metformin ', p_size, ' mg ', CASE p_partkey % 3 WHEN 0 THEN 'tablet' WHEN 1 THEN 'capsule' ELSE 'solution' END, CASE p_partkey % 2 WHEN 0 THEN ' orally ' ELSE ' iv ' END, {_FREQ}, ' now .')"
    notes = read_table(spark, d, "part").select("p_partkey", F.expr(note).alias("text"), F.lit("metformin").alias("drug"))
    return attributes.with_drug_attributes(notes, "p_partkey", "text", "drug").select("p_partkey", "strength", "unit", "form", "route", "frequency", "duration")


_INTENDED = "CASE p_partkey % 6 WHEN 0 THEN 'started today' WHEN 1 THEN 'was stopped' WHEN 2 THEN 'increased to' WHEN 3 THEN 'no change' WHEN 4 THEN 'then' ELSE 'given' END"


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'start' WHEN 1 THEN 'stop' WHEN 2 THEN 'increase' WHEN 3 THEN 'noChange' WHEN 4 THEN 'change' END AS status, 'for ' || p_size || ' days' AS duration FROM part")
def drug_intended(spark: SparkSession, d: str) -> DataFrame:
    """Changes of status and durations by the word lists as they seem meant."""
    notes = read_table(spark, d, "part").select("p_partkey", F.expr(f"concat('Aspirin ', {_INTENDED}, ' for ', p_size, ' days and more .')").alias("text"), F.lit("aspirin").alias("drug"))
    return attributes.with_drug_attributes(notes, "p_partkey", "text", "drug", intended=True).select("p_partkey", "status", "duration")


_TIMES = "CASE p_partkey % 8 WHEN 0 THEN '12 hrs' WHEN 1 THEN '8 to 10 hours' WHEN 2 THEN 'q six hours' WHEN 3 THEN 'as needed' WHEN 4 THEN 'per week' WHEN 5 THEN '8 am' WHEN 6 THEN '14:30' ELSE 'q4h' END"


@query("SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN '12 hrs' WHEN 1 THEN '8 to 10 hours' WHEN 2 THEN 'q six hours' WHEN 3 THEN 'as needed' WHEN 5 THEN '8 am' WHEN 6 THEN '14:30' WHEN 7 THEN 'q4h' END AS unit, CASE p_partkey % 8 WHEN 0 THEN '2.0' WHEN 1 THEN '3.0' WHEN 2 THEN '4.0' WHEN 7 THEN '5.0' END AS frequency FROM part")
def drug_frequency_units(spark: SparkSession, d: str) -> DataFrame:
    """Times, hours and weeks as units of frequency; of two readings with one span the lesser number comes first."""
    notes = read_table(spark, d, "part").select("p_partkey", F.expr(f"concat('take aspirin ', {_TIMES}, ' if worse .')").alias("text"), F.lit("aspirin").alias("drug"))
    return attributes.with_drug_attributes(notes, "p_partkey", "text", "drug").select("p_partkey", F.col("frequency_unit").alias("unit"), "frequency")


@query("SELECT p_partkey, '0.' || (1 + p_partkey % 9) || '-' AS decimal_like, p_size || '.5-' || (p_size + 1) AS decimal_range FROM part")
def drug_decimals(spark: SparkSession, d: str) -> DataFrame:
    """Decimal ranges read from tokens that stand apart."""
    notes = read_table(spark, d, "part").select("p_partkey", F.expr("concat('give ', p_size, ' . 5 - ', p_size + 1, ' or 0 . ', 1 + p_partkey % 9, ' - now and then')").alias("text"))
    spans = attributes.with_spans(notes, "p_partkey", "text", [*M.RANGE_STRENGTH, M.DECIMAL_STRENGTH])
    whole = lambda kind: F.regexp_replace(F.max_by(F.when(F.col("kind") == kind, F.col("span")), F.when(F.col("kind") == kind, F.length("span"))), " ", "")
    return spans.groupBy("p_partkey").agg(F.concat(whole("decimal"), F.lit("-")).alias("decimal_like"), whole("range").alias("decimal_range"))


@query("SELECT p_partkey, k AS nth, CASE k WHEN 1 THEN p_size || '' WHEN 2 THEN '5' END AS strength, CASE k WHEN 1 THEN 'tablet' END AS form FROM part, (SELECT unnest([1, 2]) AS k)")
def drug_window(spark: SparkSession, d: str) -> DataFrame:
    note = "concat('start aspirin ', p_size, ' mg tablet then aspirin 5 mg and later on the ward also some other things were seen capsule .')"
    notes = read_table(spark, d, "part").select("p_partkey", F.expr(note).alias("text"), F.lit("aspirin").alias("drug"))
    rows = attributes.with_drug_attributes(notes, "p_partkey", "text", "drug")
    return rows.select("p_partkey", F.when(F.col("begin") < 10, 1).otherwise(2).alias("nth"), "strength", "form")


@query("SELECT p_partkey, p_size || '-' || (p_size + 5) AS range_span, '1/' || (2 + p_partkey % 3) AS fraction_span FROM part")
def drug_range_fraction(spark: SparkSession, d: str) -> DataFrame:
    notes = read_table(spark, d, "part").select("p_partkey", F.expr("concat('give ', p_size, '-', p_size + 5, ' mg or 1/', 2 + p_partkey % 3, ' tablet now')").alias("text"))
    spans = attributes.with_spans(notes, "p_partkey", "text", [*M.RANGE_STRENGTH, *M.FRACTION_STRENGTH])
    pick = lambda kind, like: F.max(F.when((F.col("kind") == kind) & F.col("span").contains(like), F.col("span")))
    return spans.groupBy("p_partkey").agg(pick("range", "-").alias("range_span"), pick("fraction", "/").alias("fraction_span"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Topical' WHEN 1 THEN 'Enteral_Oral' WHEN 2 THEN 'Enteral_Rectal' ELSE 'Parenteral_Transdermal' END AS route FROM part")
def drug_route(spark: SparkSession, d: str) -> DataFrame:
    notes = read_table(spark, d, "part").select("p_partkey", F.expr("concat('apply ', CASE p_partkey % 4 WHEN 0 THEN 'topically' WHEN 1 THEN 'by mouth' WHEN 2 THEN 'rectally' ELSE 'transdermal' END, ' each day .')").alias("text"))
    return attributes.with_spans(notes, "p_partkey", "text", M.ROUTES).groupBy("p_partkey").agg(F.max("value").alias("route"))


@query("SELECT p_partkey, p_size || ' tablets' AS dosage_note, p_size || '' AS dosage FROM part WHERE p_size > 0")
def drug_dosage(spark: SparkSession, d: str) -> DataFrame:
    notes = read_table(spark, d, "part").filter("p_size > 0").select("p_partkey", F.expr("concat('aspirin take ', p_size, ' tablets daily .')").alias("text"), F.lit("aspirin").alias("drug"))
    rows = attributes.with_drug_attributes(notes, "p_partkey", "text", "drug")
    return rows.select("p_partkey", F.concat("dosage", F.lit(" tablets")).alias("dosage_note"), "dosage")


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'change' END AS status FROM part")
def drug_status(spark: SparkSession, d: str) -> DataFrame:
    notes = read_table(spark, d, "part").select("p_partkey", F.expr("concat('aspirin ', CASE WHEN p_partkey % 2 = 0 THEN 'followed by' ELSE 'along with' END, ' more rest .')").alias("text"), F.lit("aspirin").alias("drug"))
    return attributes.with_drug_attributes(notes, "p_partkey", "text", "drug").select("p_partkey", "status")


# ---- laboratory


_DATE_TEXT = """CASE o_orderkey % 3 WHEN 0 THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) WHEN 1 THEN month(o_orderdate) || '-' || day(o_orderdate) ELSE 'Oct. ' || day(o_orderdate) || ', ' || year(o_orderdate) END"""


@query(f"SELECT o_orderkey, {_DATE_TEXT} AS span FROM orders")
def lab_dates(spark: SparkSession, d: str) -> DataFrame:
    """Long dates swallow the short ones in them."""
    notes = read_table(spark, d, "orders").select("o_orderkey", F.expr(f"concat('drawn on ', {_DATE_TEXT}, ' at noon')").alias("text"))
    return attributes.with_spans(notes, "o_orderkey", "text", M.date_spans).select("o_orderkey", "span")


_LAB_TEXT = "CASE c_custkey % 4 WHEN 0 THEN concat('serum glucose ', 20 + c_custkey % 300, ' mg/dl today') WHEN 1 THEN concat('glucose : ', 20 + c_custkey % 300, ' mg/dl') WHEN 2 THEN concat('on 10/15/94 glucose : ', 20 + c_custkey % 300, '-', c_custkey % 300 + 29, ' mg/dl') ELSE concat('glucose normal , sodium ', 20 + c_custkey % 300, ' mmol/l') END"


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 1 THEN 20 + c_custkey % 300 || '' WHEN 2 THEN 20 + c_custkey % 300 || '-' || (c_custkey % 300 + 29) END AS value, CASE WHEN c_custkey % 4 IN (1, 2) THEN 'mg/dl' END AS unit FROM customer")
def lab_link(spark: SparkSession, d: str) -> DataFrame:
    """Values linked by the published CRF, which starts unlinked and doesn't link a lone value right behind its mention."""
    notes = read_table(spark, d, "customer").select("c_custkey", F.expr(_LAB_TEXT).alias("text"), F.lit("glucose").alias("lab"))
    return attributes.with_lab_values(notes, "c_custkey", "text", "lab", resources.read_model(resources.LAB_CRF)).select("c_custkey", "value", "unit")


@query("SELECT c_custkey, (c_custkey % 300) || '' AS value, 'mg/dl' AS unit FROM customer")
def lab_nearest(spark: SparkSession, d: str) -> DataFrame:
    """Values linked by the fallback: the nearest to the right."""
    notes = read_table(spark, d, "customer").select("c_custkey", F.expr("concat('serum glucose was ', c_custkey % 300, ' mg/dl today , pulse 80')").alias("text"), F.lit("glucose").alias("lab"))
    return attributes.with_lab_values(notes, "c_custkey", "text", "lab").select("c_custkey", "value", "unit")


@query("SELECT c_custkey, 100 + c_custkey % 50 || '-' || (200 + c_custkey % 50) AS range_span, '1/' || (2 + c_custkey % 7) AS fraction_span FROM customer")
def lab_range_fraction(spark: SparkSession, d: str) -> DataFrame:
    notes = read_table(spark, d, "customer").select("c_custkey", F.expr("concat('goal ', 100 + c_custkey % 50, '-', 200 + c_custkey % 50, ' titer 1/', 2 + c_custkey % 7, ' noted')").alias("text"))
    spans = attributes.with_spans(notes, "c_custkey", "text", [M.LAB_RANGE, M.LAB_FRACTION])
    return spans.groupBy("c_custkey").agg(F.max(F.when(F.col("kind") == "range", F.col("span"))).alias("range_span"), F.max(F.when(F.col("kind") == "fraction", F.col("span"))).alias("fraction_span"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'mg/dl' WHEN 1 THEN 'mmol/l' WHEN 2 THEN '%' END AS unit FROM customer")
def lab_units(spark: SparkSession, d: str) -> DataFrame:
    notes = read_table(spark, d, "customer").select("c_custkey", F.expr("concat('sodium 140', CASE c_custkey % 4 WHEN 0 THEN ' mg/dl ' WHEN 1 THEN ' mmol/l ' WHEN 2 THEN '% ' ELSE ' mmx ' END, 'seen')").alias("text"))

    return notes.select("c_custkey", attributes.unit_column(F.substring_index("text", "140", -1)).alias("unit"))


# ---- smoking

_SMOKE = "CASE l_linenumber % 5 WHEN 0 THEN 'he smokes a pack a day' WHEN 1 THEN 'patient denies smoking' WHEN 2 THEN 'she quit smoking last year' WHEN 3 THEN 'walks each day' ELSE 'there is tobacco use' END"
_SMOKE_STATUS = "CASE l_linenumber % 5 WHEN 0 THEN 'CURRENT_SMOKER' WHEN 1 THEN 'NON_SMOKER' WHEN 2 THEN 'PAST_SMOKER' WHEN 3 THEN 'UNKNOWN' ELSE 'SMOKER' END"


def _smoking(spark: SparkSession, d: str) -> DataFrame:
    return smoking.with_status(read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_SMOKE).alias("text")), ["l_orderkey", "l_linenumber"], "text")


@query(f"SELECT {_SMOKE_STATUS} AS status, count(*) AS n FROM lineitem GROUP BY 1")
def smoking_sentence(spark: SparkSession, d: str) -> DataFrame:
    return _smoking(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT l_orderkey, arg_max(s, CASE s WHEN 'CURRENT_SMOKER' THEN 5 WHEN 'PAST_SMOKER' THEN 4 WHEN 'SMOKER' THEN 3 WHEN 'NON_SMOKER' THEN 2 ELSE 1 END) AS smoking_status FROM (SELECT l_orderkey, {_SMOKE_STATUS} AS s FROM lineitem) GROUP BY l_orderkey")
def smoking_document(spark: SparkSession, d: str) -> DataFrame:
    return smoking.document_status(_smoking(spark, d), "l_orderkey")


@query("SELECT c_custkey, CASE WHEN 0.5 * (c_custkey % 7) - 0.25 * (c_custkey % 5) - 1.0 > 0 THEN 1 ELSE 2 END AS label FROM customer")
def svm_predict(spark: SparkSession, d: str) -> DataFrame:
    model = {"kernel": "linear", "labels": [1, 2], "counts": [1, 1], "vectors": [[1.0, 0.0], [0.0, 1.0]], "coefficients": [[0.5, -0.25]], "rho": [1.0]}

    x = read_table(spark, d, "customer").select("c_custkey", F.array(F.expr("double(c_custkey % 7)"), F.expr("double(c_custkey % 5)")).alias("x"))
    return x.select("c_custkey", smoking.svm_column(F.col("x"), model).alias("label"))


_PCS = "CASE c_custkey % 3 WHEN 0 THEN 'currently smokes a cigar' WHEN 1 THEN 'smoked until 1999' ELSE 'tobacco was discussed' END"


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'CURRENT_SMOKER' WHEN 1 THEN 'PAST_SMOKER' ELSE 'SMOKER' END AS status FROM customer")
def smoking_svm(spark: SparkSession, d: str) -> DataFrame:
    """Smokers told apart by a support vector machine over go-words and a date; its weights are given here."""
    words = resources.SMOKING_GO_WORDS
    unit = lambda *have: [float(w in have) for w in words] + [float("date" in have)]
    model = {"labels": [1, 2, 3], "counts": [1, 1, 1], "vectors": [unit("smokes", "currently"), unit("smoked", "date"), unit("tobacco", "discussed")], "coefficients": [[1.0, -1.0, -1.0], [1.0, 1.0, -1.0]], "rho": [0.0, 0.0, 0.0]}
    notes = read_table(spark, d, "customer").select("c_custkey", F.expr(_PCS).alias("text"))
    return smoking.with_status(notes, ["c_custkey"], "text", model)


# ---- lemmas, tags, results


_FORM = "CASE line_id % 4 WHEN 0 THEN 'feet' WHEN 1 THEN 'Teeth' WHEN 2 THEN 'knee' ELSE 'lice' END"


@query(f"SELECT DISTINCT line_id, form, CASE lower(form) WHEN 'feet' THEN 'foot' WHEN 'teeth' THEN 'tooth' WHEN 'lice' THEN 'louse' ELSE lower(form) END AS lemma FROM (SELECT line_id, {_FORM} AS form FROM rule_lines)")
def lemma_exceptions(spark: SparkSession, d: str) -> DataFrame:
    table = spark.createDataFrame([("feet", "foot"), ("teeth", "tooth"), ("lice", "louse")], "form string, base string")
    return tagging.with_exceptions(read_table(spark, d, "rule_lines").select("line_id", F.expr(_FORM).alias("form")).distinct(), "form", table)


_WORD_TAG = "CASE p_partkey % 6 WHEN 0 THEN 'studies/VBZ' WHEN 1 THEN 'walking/VBG' WHEN 2 THEN 'seven/CD' WHEN 3 THEN 'boxes/NNS' WHEN 4 THEN '3rd/JJ' ELSE 'ran/VBD' END"


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'study' WHEN 1 THEN 'walk' WHEN 2 THEN '#crd#' WHEN 3 THEN 'box' WHEN 4 THEN '#ord#' ELSE 'run' END AS lemma FROM part")
def lemma_rules(spark: SparkSession, d: str) -> DataFrame:
    rules = {"verb": [("s", ""), ("ies", "y"), ("ing", "")], "noun": [("s", ""), ("xes", "x")]}
    bases = {"verb": frozenset(["study", "walk"]), "noun": frozenset(["box"]), "cardinal": frozenset(["seven"])}
    words = read_table(spark, d, "part").select("p_partkey", F.split(F.expr(_WORD_TAG), "/").alias("w"))
    return words.select("p_partkey", tagging.lemma_column(F.get("w", F.lit(0)), F.get("w", F.lit(1)), {"verb": {"ran": "run"}}, rules, bases).alias("lemma"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'dt nn vbz cd' WHEN 1 THEN 'prp vbz dt nn' ELSE 'dt nn vbz cd' END AS tags FROM part")
def pos_beam(spark: SparkSession, d: str) -> DataFrame:
    """Tags by a beam search over a maximum-entropy model, in which "run" is a noun behind an article and a verb elsewhere."""
    model = {"outcomes": ["nn", "vbz", "dt", "prp", "cd"], "weights": {"w=the": {"dt": 5.0}, "w=a": {"dt": 5.0}, "w=she": {"prp": 5.0}, "d": {"cd": 6.0}, "w=run": {"nn": 1.0, "vbz": 1.5}, "t=dt": {"nn": 3.0}, "t=nn": {"vbz": 2.0}, "t=prp": {"vbz": 2.0}}}
    text = F.expr("CASE p_partkey % 3 WHEN 0 THEN concat('the run run ', p_size) WHEN 1 THEN 'she run a run' ELSE concat('a run run ', p_size) END")
    return read_table(spark, d, "part").select("p_partkey", tagging.tag_column(F.split(text, " "), model).alias("t")).select("p_partkey", F.array_join("t", " ").alias("tags"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'dt nn vbz vbg cd' WHEN 1 THEN 'prp vbz dt nn' ELSE 'nns vbd in nn' END AS tags FROM part")
def pos_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tags by the fallback, without a model."""
    text = F.expr("CASE p_partkey % 3 WHEN 0 THEN concat('the ward is testing ', p_size) WHEN 1 THEN 'she takes a pill' ELSE 'nurses walked to town' END")
    return read_table(spark, d, "part").select("p_partkey", tagging.tag_column(F.split(text, " ")).alias("t")).select("p_partkey", F.array_join("t", " ").alias("tags"))


@query(f"SELECT l_orderkey, '{{\"smoking\":{{\"docId\":\"' || l_orderkey || '\",\"smokingStatus\":\"' || arg_max(s, CASE s WHEN 'CURRENT_SMOKER' THEN 5 WHEN 'PAST_SMOKER' THEN 4 WHEN 'SMOKER' THEN 3 WHEN 'NON_SMOKER' THEN 2 ELSE 1 END) || '\"}}}}' AS envelope FROM (SELECT l_orderkey, {_SMOKE_STATUS} AS s FROM lineitem) GROUP BY l_orderkey")
def envelope_merge(spark: SparkSession, d: str) -> DataFrame:
    one = smoking.document_status(_smoking(spark, d), "l_orderkey").select("l_orderkey", F.lit("smoking").alias("config"), F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("docId"), F.col("smoking_status").alias("smokingStatus"))).alias("response"))
    return responses.envelope(one, "l_orderkey")


# ---- tasks and streams


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'skip' WHEN user_id % 7 = 0 THEN 'canceled' WHEN user_id % 3 = 0 AND event_id % 4 = 1 THEN 'canceled: document failed' WHEN event_id % 6 >= 3 THEN 'completed - failure' ELSE 'run' END AS decision FROM events""")
def task_decision(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    messages = e.select("event_id", F.col("event_id").alias("chunk_id"))
    chunks = e.select(F.col("event_id").alias("chunk_id"), F.col("event_id").alias("document_id"), F.col("user_id").alias("job_id"), F.expr("CASE WHEN event_id % 5 = 0 THEN 'completed - success' ELSE 'started' END").alias("status"), F.expr("event_id % 6").alias("attempts"))
    documents = e.select(F.col("event_id").alias("document_id"), F.expr("event_id % 4 = 1").alias("document_failed"))
    jobs = e.select("user_id").distinct().select(F.col("user_id").alias("job_id"), F.expr("user_id % 7 = 0").alias("user_canceled"), F.expr("user_id % 3 = 0").alias("stop_documents_on_failure"))
    return tasks.decide(messages, chunks, documents, jobs).select("event_id", "decision")


_KIND = "CASE event_id % 4 WHEN 0 THEN 'start' WHEN 1 THEN 'fail' WHEN 2 THEN 'complete' ELSE 'other' END"


@query(f"""SELECT event_id, CAST(sum(CASE WHEN k IN ('start', 'cancel') THEN 1 ELSE 0 END) OVER w AS BIGINT) AS attempts,
coalesce(last_value(CASE k WHEN 'start' THEN 'started' WHEN 'fail' THEN 'failed' WHEN 'complete' THEN 'completed - success' END IGNORE NULLS) OVER w, 'submitted') AS status_after
FROM (SELECT *, {_KIND} AS k FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def task_transitions(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events").withColumn("k", F.expr(_KIND))
    return tasks.transitions(e, "user_id", ["ts", "event_id"], "k").select("event_id", "attempts", "status_after")


def _stream(spark: SparkSession, d: str) -> DataFrame:
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{d}/events.parquet*")


@query("SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY event_type")
def stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    once = deduplicated(_stream(spark, d), "event_id", "ts", "400 days").select("event_id", "event_type")
    at = fresh_folder(spark, "stream")
    return run_once(once, f"{at}/out", f"{at}/state").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT user_id, CAST(count(*) FILTER (WHERE {_KIND} = 'start') AS INTEGER) AS attempts FROM events GROUP BY user_id")
def stream_attempts(spark: SparkSession, d: str) -> DataFrame:
    e = _stream(spark, d).select("user_id", F.expr(_KIND).alias("k"))
    at = fresh_folder(spark, "stream")
    return run_once(attempts(e, "user_id", "k"), f"{at}/out", f"{at}/state", "update").groupBy("user_id").agg(F.max("attempts").alias("attempts"))


@query("SELECT event_id, '{\"event_type\":\"' || event_type || '\",\"extra\":true,\"n\":' || event_id % 10 || ',\"user_id\":' || user_id || '}' AS raw, event_type AS kind, user_id AS owner FROM events")
def partial_document(spark: SparkSession, d: str) -> DataFrame:
    """An update of a partly known document: what isn't known keeps its place and type."""
    raw = read_table(spark, d, "events").select("event_id", F.to_json(F.struct("event_type", "user_id", F.expr("string(event_id % 10)").alias("n"))).alias("raw"), F.expr("concat('{\"n\":', event_id % 10, ',\"extra\":true}')").alias("new"))
    laid = tasks.partial(raw.withColumn("raw", tasks.updated(F.col("raw"), F.col("new"))), "raw", "event_type string, user_id long")
    ordered = F.to_json(F.from_json("raw", "event_type string, extra boolean, n int, user_id long"))
    return laid.select("event_id", ordered.alias("raw"), F.col("typed.event_type").alias("kind"), F.col("typed.user_id").alias("owner"))


@query("SELECT event_id, '{\"document_info\":{\"a\":[1,2]},\"failed_tasks\":[],\"job_id\":' || user_id || '}' AS cached FROM events")
def cached_projection(spark: SparkSession, d: str) -> DataFrame:
    raw = read_table(spark, d, "events").select("event_id", F.expr("concat('{\"x\":1,\"document_info\":{\"a\":[1,2]},\"failed_tasks\":[],\"job_id\":', user_id, '}')").alias("raw"))
    back = tasks.with_projection(raw, "raw").withColumn("c", F.from_json("cached", "document_info struct<a:array<int>>, failed_tasks array<string>, job_id long"))
    return back.select("event_id", F.to_json("c").alias("cached"))


def _worker(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    e = read_table(spark, d, "events")
    chunks = e.filter("event_id % 11 <> 0").select(F.col("event_id").alias("chunk_id"), F.expr("event_id DIV 10").alias("document_id"), F.col("user_id").alias("job_id"), F.expr("CASE WHEN event_id % 5 = 0 THEN 'completed - success' ELSE 'started' END").alias("status"), F.expr("event_id % 6").alias("attempts"), F.array().cast("array<string>").alias("error_messages"))
    documents = e.select(F.expr("event_id DIV 10").alias("document_id")).distinct().withColumn("document_failed", F.expr("document_id % 4 = 1"))
    jobs = e.select("user_id").distinct().select(F.col("user_id").alias("job_id"), F.expr("user_id % 7 = 0").alias("user_canceled"), F.expr("user_id % 3 = 0").alias("stop_documents_on_failure"))
    messages = e.select(F.col("event_id").alias("message_id"), F.col("event_id").alias("chunk_id"), F.expr("event_id % 2 = 0").alias("redelivered"))
    annotate = lambda df: df.select("message_id", F.expr("CASE WHEN message_id % 13 <> 0 THEN '{}' END").alias("response"), F.expr("CASE WHEN message_id % 13 = 0 THEN 'ValueError: bad note' END").alias("error"))
    return process(messages, (chunks, documents, jobs), annotate)


_DECIDED = """WITH m AS (SELECT event_id, event_id // 10 AS document_id, CASE WHEN event_id % 11 = 0 THEN 'none' WHEN event_id % 5 = 0 THEN 'skip' WHEN user_id % 7 = 0 THEN 'canceled' WHEN user_id % 3 = 0 AND event_id // 10 % 4 = 1 THEN 'canceled: document failed' WHEN event_id % 6 >= 3 THEN 'completed - failure' ELSE 'run' END AS d FROM events)"""


@query(_DECIDED + " SELECT event_id AS chunk_id, CASE WHEN starts_with(d, 'canceled') THEN 'canceled' WHEN d = 'run' THEN CASE WHEN event_id % 13 = 0 THEN 'failed' ELSE 'completed - success' END ELSE d END AS status, CAST(event_id % 6 + 1 AS BIGINT) AS attempts, CAST(d IN ('canceled: document failed', 'completed - failure') OR d = 'run' AND event_id % 13 = 0 AS INTEGER) AS n_errors, CASE WHEN d = 'run' AND event_id % 13 <> 0 THEN 'processed/documents/' || document_id || '/chunks/' || event_id || '/' || event_id || '.fdl_results.json' END AS results_key FROM m WHERE d NOT IN ('skip', 'none')")
def worker_states(spark: SparkSession, d: str) -> DataFrame:
    return _worker(spark, d)[1].select("chunk_id", "status", F.col("attempts").cast("long").alias("attempts"), F.size("error_messages").alias("n_errors"), "results_key")


@query(_DECIDED + " SELECT document_id, CAST(count(*) AS INTEGER) AS n_failed, string_agg(event_id || '', ',' ORDER BY event_id || '') AS chunks FROM m WHERE d = 'completed - failure' GROUP BY document_id")
def worker_documents(spark: SparkSession, d: str) -> DataFrame:
    return _worker(spark, d)[2].select("document_id", F.size("failed_tasks").alias("n_failed"), F.array_join(F.sort_array(F.map_keys("failed_chunks")), ",").alias("chunks"))


@query(_DECIDED + " SELECT CASE WHEN d <> 'none' THEN 'ack' WHEN event_id % 2 = 0 THEN 'drop' ELSE 'requeue' END AS action, CASE WHEN d <> 'none' THEN 'fdl' END AS sender, count(*) AS n FROM m GROUP BY ALL")
def worker_deliveries(spark: SparkSession, d: str) -> DataFrame:
    return _worker(spark, d)[3].groupBy("action", "sender").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) FILTER (WHERE event_id % 3 = 0) AS n_results, count(*) AS n_pings FROM events")
def stream_worker(spark: SparkSession, d: str) -> DataFrame:
    """The worker over a stream of messages: what it wrote."""
    e = read_table(spark, d, "events")
    tables = (e.select(F.col("event_id").alias("chunk_id"), F.col("event_id").alias("document_id"), F.col("user_id").alias("job_id"), F.expr("CASE WHEN event_id % 3 = 0 THEN 'started' ELSE 'completed - success' END").alias("status"), F.lit(0).alias("attempts"), F.array().cast("array<string>").alias("error_messages")),
              e.select(F.col("event_id").alias("document_id"), F.lit(False).alias("document_failed")), e.select("user_id").distinct().select(F.col("user_id").alias("job_id"), F.lit(False).alias("user_canceled"), F.lit(False).alias("stop_documents_on_failure")))
    messages = _stream(spark, d).select(F.col("event_id").alias("message_id"), F.col("event_id").alias("chunk_id"), F.lit(False).alias("redelivered"), "ts")
    at = fresh_folder(spark, "worker")
    start_worker(messages, lambda: tables, lambda df: df.select("message_id", F.lit("{}").alias("response"), F.lit(None).cast("string").alias("error")), f"{at}/out", f"{at}/state").awaitTermination()
    count = lambda name: spark.read.schema("message_id long").json(f"{at}/out/{name}").agg(F.count(F.lit(1)).alias(f"n_{name}"))
    return count("results").withColumn("n_pings", count("pings").scalar())
